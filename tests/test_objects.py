"""Objects before their index, and streams into several stores."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidewright.functions.codes import raw_key
from tidewright.operators.objects import RawStore, derived
from tidewright.streaming import fanout

FORM = "content binary, source string, datatype string, scope string, data_date date, ext string, doc_id string, fetched_at timestamp, n int"
DAY = datetime.date(2024, 5, 1)


def raw(spark, *rows):
    """rows: content, doc_id, hour of fetching, n."""
    return spark.createDataFrame([(c.encode(), "S", "list", "1301", DAY, "zip", d, datetime.datetime(2024, 5, 1, h), n) for c, d, h, n in rows], FORM)


def test_objects_are_put_once_and_first_fetch_stays(spark, tmp_path):
    store = RawStore(spark, str(tmp_path), 4)
    store.put(raw(spark, ("a", "D1", 1, 1), ("a", "D1", 2, 2), ("b", None, 1, 3)), [F.col("n")])
    before = store.objects.manifest()
    got = {r.doc_id: (r.first_fetched_at.hour, r.fetched_at.hour) for r in store.put(raw(spark, ("a", "D1", 5, 4)), [F.col("n")]).collect()}
    assert got == {"D1": (1, 5)} and store.objects.manifest() == before and store.index.read().count() == 2
    assert all(r.key.startswith("raw/s/list/2024/2024-05-01/1301/") for r in store.index.read().collect())
    assert derived(store.index.read(), ["csv"]).filter("derived_keys[0] LIKE 'derived/%.csv'").count() == 2


def test_an_object_under_its_old_key_is_not_put_again(spark, tmp_path):
    store = RawStore(spark, str(tmp_path), 4)
    one = raw(spark, ("a", "D1", 1, 1))
    old = one.withColumn("sha256", F.sha2("content", 256)).select(raw_key(*[F.col(c) for c in ("source", "datatype", "scope", "data_date", "sha256", "ext")]).alias("key"), "content")
    store.objects.upsert(old, [F.col("key")])
    (row,) = store.put(one, [F.col("n")]).collect()
    assert row.key == old.first().key and row.doc_id == "D1" and store.objects.read().count() == 1


def test_a_crash_between_object_and_index(spark, tmp_path, monkeypatch):
    store = RawStore(spark, str(tmp_path), 4)

    def dies(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(RawStore, "link", dies)
        store.put(raw(spark, ("a", "D1", 1, 1)), [F.col("n")])
    assert store.repair().count() == 1 and store.index.versions() == []
    first = store.objects.manifest()
    store.put(raw(spark, ("a", "D1", 1, 1)), [F.col("n")])
    assert store.objects.manifest() == first and store.repair().count() == 0 and store.index.read().count() == 1
    with pytest.raises(ValueError, match="no object"):
        store.link(store.index.read().withColumn("key", F.lit("raw/none")), [F.col("n")])


def test_a_store_that_fails_once_has_every_batch_once(spark, tmp_path):
    form, source, calls, told = "k int", str(tmp_path / "in"), [], {}

    def into(name, fails=()):
        def write(df, number):
            calls.append((name, number))
            if number in fails and calls.count((name, number)) == 1:
                raise OSError("busy")
            df.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(str(tmp_path / name / f"batch={number}"))

        return write

    stores = {"one": into("one"), "two": into("two", fails=(1,))}

    def arrive(k):
        spark.createDataFrame([(k,)], form).coalesce(1).write.mode("append").parquet(source)
        fanout.write_to_all(spark.readStream.schema(form).parquet(source), stores, str(tmp_path / "ledger"), str(tmp_path / "c"), told.__setitem__).awaitTermination()

    for k in range(4):
        arrive(k)
    for name in stores:
        got = [r.k for r in spark.read.parquet(*[str(p) for p in (tmp_path / name).glob("batch=*")]).collect()]
        assert sorted(got) == [0, 1, 2, 3]
    assert told[1] == {"one": None, "two": "batch 1: OSError: busy"} and not any(told[2].values())
    assert calls.count(("one", 1)) == 1 and [n for s, n in calls if s == "two"] == [0, 1, 1, 2, 3]
    assert fanout.Ledger(spark, str(tmp_path / "ledger")).kept() == []


def test_a_batch_that_no_store_takes_stops_the_stream(spark, tmp_path):
    taken, down = [], [True]

    def write(df, number):
        if down[0]:
            raise OSError("down")
        taken.append((number, df.count()))

    spark.createDataFrame([(1,)], "k int").write.parquet(str(tmp_path / "in"))
    run = lambda: fanout.write_to_all(spark.readStream.schema("k int").parquet(str(tmp_path / "in")), {"one": write}, str(tmp_path / "l"), str(tmp_path / "c")).awaitTermination()
    with pytest.raises(Exception, match="no store"):
        run()
    down[0] = False
    run()
    assert taken == [(0, 1)]
