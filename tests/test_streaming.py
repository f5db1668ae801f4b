"""Corrections merged batch by batch."""

from pyspark.sql import functions as F

from tidewright.operators.buckets import BucketTable
from tidewright.streaming import upserts


def test_later_batches_merge_under_the_guard_and_half_versions_are_not_read(spark, tmp_path):
    form, source, table = "k int, at int, v string", str(tmp_path / "in"), str(tmp_path / "table")

    def arrive(*rows):
        spark.createDataFrame(rows, form).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(form).parquet(source)
        upserts.merge_into(stream, table, str(tmp_path / "checkpoint"), ["k"], [F.col("at")], ["v"], guard="at").awaitTermination()

    arrive((1, 2, "a"), (1, 1, "z"), (2, 5, "b"))
    arrive((1, 3, None), (2, 4, "old"), (3, 1, "c"))
    (tmp_path / "table" / "data" / "9-half" / "_bucket=0").mkdir(parents=True)
    assert sorted(map(tuple, upserts.latest(spark, table, ["k"]).collect())) == [(1, 3, "a"), (2, 5, "b"), (3, 1, "c")]


def test_stale_rows_of_a_batch_and_nulls(spark, tmp_path):
    """Rows of one batch are applied one after another: the second is stale, the third has no time of its own."""
    form, source, table = "k int, at int, n int, v string", str(tmp_path / "in"), str(tmp_path / "table")
    spark.createDataFrame([(1, 5, 1, "a"), (1, 4, 2, "b"), (1, None, 3, "c"), (2, None, 4, "d"), (2, 1, 5, None)], form).coalesce(1).write.parquet(source)
    upserts.merge_into(spark.readStream.schema(form).parquet(source), table, str(tmp_path / "c"), ["k"], [F.col("n")], ["v"], guard="at").awaitTermination()
    assert sorted(map(tuple, upserts.latest(spark, table, ["k"]).collect())) == [(1, 5, 1, "a"), (2, 1, 5, "d")]


def test_series_never_shrink(spark, tmp_path):
    form, source, table = "s string, d int, ex string, v int", str(tmp_path / "in"), str(tmp_path / "table")

    def arrive(*rows):
        spark.createDataFrame(rows, form).coalesce(1).write.mode("append").parquet(source)
        upserts.merge_series_into(spark.readStream.schema(form).parquet(source), table, str(tmp_path / "checkpoint"), ["s", "d", "ex"], ["s"]).awaitTermination()

    now = lambda: BucketTable(spark, table, ["s", "d", "ex"], deal=["s"])
    arrive(("a", 1, None, 1), ("a", 2, "T", 2), ("c", 1, None, 7))
    before = now().manifest()["standing"]
    arrive(("a", 1, None, 5), ("b", 1, "T", 1), ("a", 2, "T", 3), ("a", 2, "T", 4))
    assert sorted(map(tuple, now().read().collect()), key=str) == sorted([("a", 1, None, 5), ("a", 2, "T", 4), ("b", 1, "T", 1), ("c", 1, None, 7)], key=str)
    (own,) = spark.createDataFrame([("c",)], "s string").select(now().bucket_of()).first()
    assert now().manifest()["standing"][str(own)] == before[str(own)] and own not in now().manifest()["touched"]
    arrive(("c", 2, None, 8))
    assert now().versions() == [1, 2]


def test_hourly_polls_bring_each_document_once(spark, tmp_path):
    form, source = "doc_id int, at timestamp", str(tmp_path / "in")
    spark.createDataFrame([(1, "2024-01-01 01:00:00"), (1, "2024-01-01 02:00:00"), (2, "2024-01-01 02:00:00")], "doc_id int, at string").withColumn("at", F.col("at").cast("timestamp")).write.parquet(source)
    found = upserts.attributed(upserts.first_seen(spark.readStream.schema(form).parquet(source), ["doc_id"], "at"), "at")
    found.writeStream.format("memory").queryName("polled").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    assert sorted((r.doc_id, str(r.target_date)) for r in spark.table("polled").collect()) == [(1, "2023-12-31"), (2, "2023-12-31")]


def test_fallback_when_the_primary_fails(spark):
    rows = spark.createDataFrame([(1, "d"), (2, "d")], "doc_id int, data_date string")
    assert upserts.with_fallback(lambda: spark.read.parquet("/nowhere/at/all"), lambda: rows, 5).count() == 2
    assert upserts.with_fallback(lambda: rows.limit(1), lambda: rows, 5).count() == 1
    assert upserts.with_fallback(lambda: rows.filter("doc_id = 1"), lambda: rows, 1).count() == 2
