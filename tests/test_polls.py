"""A primary that fails for one poll, and recovers."""

import pytest
from pyspark.sql import functions as F

from tidewright.operators.buckets import BucketTable
from tidewright.operators.store import look_up_dated, write_map
from tidewright.streaming import polls

FORM = "doc string, at string, title string"


def test_a_failing_primary_is_bridged_and_catches_up(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), ["doc"], 4)
    second_rows, marks, broken = [], [], [False]

    def arrive(*rows):
        spark.createDataFrame(rows, FORM).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def primary():
        if broken[0]:
            return spark.readStream.schema(FORM).parquet(str(tmp_path / "gone" / "away"))
        return spark.readStream.schema(FORM).parquet(str(tmp_path / "in"))

    def second(mark):
        marks.append(mark)
        rows = spark.createDataFrame(second_rows, FORM)
        return rows if mark is None else rows.filter(F.col("at") > mark)

    run = lambda: polls.poll(table, primary, second, "at", str(tmp_path / "c"))
    now = lambda: {r.doc: (r.title, r.origin) for r in table.read().collect()}
    arrive(("a", "01", "A"), ("b", "02", "B"))
    second_rows += [("b", "02", "b2"), ("c", "03", "c2")]
    assert run() == "primary" and now() == {"a": ("A", "primary"), "b": ("B", "primary"), "c": ("c2", "second")}
    broken[0] = True
    second_rows += [("a", "04", "a2"), ("d", "05", "d2")]
    assert run() == "second" and now() == {"a": ("A", "primary"), "b": ("B", "primary"), "c": ("c2", "second"), "d": ("d2", "second")}
    broken[0] = False
    arrive(("d", "05", "D"), ("e", "06", "E"))
    assert run() == "primary" and now()["d"] == ("D", "primary") and now()["e"] == ("E", "primary") and len(now()) == 5
    assert marks == [None, "03", "05"]


def test_entries_of_other_days_are_not_read(spark, tmp_path):
    path = str(tmp_path / "map")
    write_map(spark.createDataFrame([("2024-01-01", "k", "old"), ("2024-01-02", "k", "new"), ("2024-01-03", "x", "other")], "event_date string, k string, v string"), path)
    write_map(spark.createDataFrame([("2024-01-03", "k", "again")], "event_date string, k string, v string"), path)
    entries = spark.read.schema("k string, v string, event_date string").parquet(path)
    rows = spark.createDataFrame([("2024-01-02", "k", 1), ("2024-01-02", "x", 2), ("2024-01-09", "k", 3), (None, "k", 4)], "day string, k string, n int").filter("n < 9")
    out = look_up_dated(rows, entries, "day", "k", "v")
    assert {r.n: r.v for r in out.collect()} == {1: "new", 2: None, 3: None, 4: None}
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()
    assert {r.n: r.v for r in look_up_dated(rows.withColumn("day", F.lit("2024-01-03")), entries, "day", "k", "v").collect()}[1] == "again"


@pytest.mark.parametrize("broken", ["flipped", "encrypted"])
def test_members_that_cannot_be_read_are_skipped(broken):
    import io
    import zipfile

    from tidewright.sources.tidy import csv_zip_facts

    out, head = io.BytesIO(), "要素ID\tコンテキストID\t値\n"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", head + "e\tc\t" + "long " * 60_000)
        z.writestr("b.csv", head + "".join(f"e{k}\tc\tv{k * 7919}\n" for k in range(400)))
    data = bytearray(out.getvalue())
    at = data.index(b"b.csv") + 60
    if broken == "flipped":
        data[at : at + 200] = bytes(255 - x for x in data[at : at + 200])
    else:
        data[data.index(b"PK\x03\x04", 10) + 6] |= 1
        data[data.rindex(b"PK\x01\x02") + 8] |= 1
    (fact,) = csv_zip_facts(bytes(data))
    assert len(fact["value"]) == 300_000
