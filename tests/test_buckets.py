"""Tables at rest that are rewritten bucket by bucket."""

import pytest
from pyspark.sql import functions as F

from tidewright.operators import keyed
from tidewright.operators.buckets import BucketTable, Conflict

FORM = "k string, n int, v int"


def rows(spark, *some):
    return spark.createDataFrame(some, FORM)


def content(table, version=None):
    return sorted((tuple(r) for r in table.read(version).collect()), key=str)


def test_a_merge_reads_and_writes_its_buckets_alone(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], 16)
    table.upsert(spark.range(400).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(0).alias("n"), F.col("id").cast("int").alias("v")), [F.col("n")])
    first = table.manifest()["standing"]
    few = rows(spark, ("k7", 1, None), ("k7", 2, 70), ("k8", 1, 80))
    table.upsert(few, [F.col("n")], {"v": keyed.MERGE})
    told = table.manifest()
    assert len(first) == 16 and len(told["touched"]) <= 2
    assert {b for b in first if told["standing"][b] != first[b]} == {str(b) for b in told["touched"]}
    got = {r.k: r.v for r in table.read().collect()}
    assert len(got) == 400 and (got["k7"], got["k8"], got["k9"]) == (70, 80, 9)
    # what is read for a merge of these keys: the files of their buckets
    files = table.read(buckets=told["touched"]).inputFiles()
    assert files and all(any(f"_bucket={b}/" in f for b in told["touched"]) for f in files)


def test_null_keys_versions_and_batches_run_again(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], 4)
    assert table.upsert(rows(spark, (None, 1, 1), ("a", 1, 1)), [F.col("n")], number=3) == 3
    assert table.upsert(rows(spark, (None, 2, 2)), [F.col("n")], number=3) is None
    assert table.upsert(rows(spark, (None, 2, 2)), [F.col("n")], number=4) == 4
    assert content(table) == [("a", 1, 1), (None, 2, 2)] and content(table, 3) == [("a", 1, 1), (None, 1, 1)]
    assert table.upsert(rows(spark), [F.col("n")]) is None
    table.delete(rows(spark, (None, 0, 0), ("zz", 0, 0)))
    assert content(table) == [("a", 1, 1)]
    table.delete(rows(spark, ("a", 0, 0)))
    assert content(table) == [] and table.versions() == [3, 4, 5, 6]
    table.upsert(rows(spark, ("b", 1, 1)), [F.col("n")])
    assert content(table) == [("b", 1, 1)]
    assert table.expire(1) and table.versions() == [7] and content(table) == [("b", 1, 1)]


def test_of_two_writers_one_fails_and_a_dead_one_leaves_nothing(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], 4)
    table.upsert(rows(spark, ("a", 1, 1)), [F.col("n")])

    def meanwhile(old, new):
        BucketTable(spark, str(tmp_path / "t"), ["k"]).upsert(rows(spark, ("a", 2, 2)), [F.col("n")])
        return keyed.apply_in_order(old, new, ["k"], [F.col("n")])

    with pytest.raises(Conflict):
        table.merge(rows(spark, ("a", 3, 3)), meanwhile)
    assert content(table) == [("a", 2, 2)]

    def refused(before, after):
        raise RuntimeError("refused")

    with pytest.raises(RuntimeError, match="refused"):
        table.merge(rows(spark, ("a", 9, 9)), lambda old, new: new, check=refused)
    assert content(table) == [("a", 2, 2)] and table.versions() == [0, 1]


def test_other_keys_are_refused_and_columns_may_come(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], 4)
    table.upsert(rows(spark, ("a", 1, 1), ("b", 1, 1), ("c", 1, 1)), [F.col("n")])
    table.upsert(spark.createDataFrame([("a", 2, 5, "x")], "k string, n int, v int, w string"), [F.col("n")])
    assert content(table) == [("a", 2, 5, "x"), ("b", 1, 1, None), ("c", 1, 1, None)]
    with pytest.raises(ValueError, match="key"):
        BucketTable(spark, str(tmp_path / "t"), ["v"])
    with pytest.raises(ValueError, match="no version"):
        BucketTable(spark, str(tmp_path / "none"), ["v"]).read()
