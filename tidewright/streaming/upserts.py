"""Streams of corrections merged into a table, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewright.functions.values import default_target_date
from tidewright.operators.buckets import BucketTable
from tidewright.operators.keyed import MERGE, merge_series, regressions
from tidewright.sources.disclosures import with_unseen


def first_seen(stream: DataFrame, keys: list[str], event_time: str, delay: str = "1 day") -> DataFrame:
    """Each key once within the delay: hourly polls of one day bring it again and again."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def merge_into(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[Column], merge: list[str], guard: str | None = None, publish: Callable[[str, int], None] | None = None, buckets: int = 8, keep: int = 2
) -> StreamingQuery:
    """Merge every micro-batch into the table under path, its rows one after another under the guard. A batch rewrites the buckets
    alone that it has keys of, in one job, and is committed under its number, so a batch that is run again changes nothing and
    readers never see half of one. The newest `keep` versions stay."""

    def apply(batch: DataFrame, number: int) -> None:
        table = BucketTable(batch.sparkSession, path, keys, buckets)
        policy = dict.fromkeys([*merge, *([guard] if guard else [])], MERGE)
        table.upsert(batch, order, policy, guard, number=number)
        table.expire(keep)
        if publish:
            publish(path, number)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark, path: str, keys: list[str]) -> DataFrame:
    """The newest whole version."""
    return BucketTable(spark, path, keys).read()


def merge_series_into(stream: DataFrame, path: str, checkpoint: str, keys: list[str], series: list[str], order: list[Column] | None = None, buckets: int = 64, keep: int = 2) -> StreamingQuery:
    """Append-only series in a table of buckets: every micro-batch's points replace those with the same keys, null for null; of
    points of one batch with one key the last in the order stays (by all columns where none is given). A series lies in one bucket.
    What was written is held against the buckets that it replaces before it is committed, and a series that would lack an old
    key or get shorter stops the stream."""

    def apply(batch: DataFrame, number: int) -> None:
        table = BucketTable(batch.sparkSession, path, keys, buckets, deal=series)

        def whole(old: DataFrame, written: DataFrame) -> None:
            lost = regressions(old, written, series, [k for k in keys if k not in series]).first()
            if lost is not None:
                raise RuntimeError(f"batch {number} would shrink a series: {lost.asDict()}")

        last = order or [F.struct(*batch.columns)]
        table.merge(batch, lambda old, points: merge_series(old, points, keys, last), number, whole)
        table.expire(keep)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def attributed(stream: DataFrame, at: str) -> DataFrame:
    """The stream with the day that each late run belongs to."""
    return stream.withColumn("target_date", default_target_date(F.col(at)))


def with_fallback(primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame], limit: int) -> DataFrame:
    """The primary list, filled up from the fallback where it is full; the fallback alone if the primary can't be read."""
    try:
        rows = primary()
        rows.schema  # noqa: B018  an unreadable source fails here
        first = rows.limit(1).count()
    except (AnalysisException, PySparkException):
        return fallback()
    return with_unseen(rows, fallback(), limit) if first else fallback()
