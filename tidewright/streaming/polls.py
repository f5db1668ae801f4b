"""Polls of a list from a primary source, completed from a second one.

The primary is a stream that reads what has come since the last poll; the second source is read from where it was last read to. Rows and the
second source's mark are committed together to a table of buckets, the primary's offsets by its checkpoint, so after a failure at any
point the next poll goes on from both, and a batch that is run again changes nothing. A row of the primary takes the place of one
that the second source had brought while the primary was down.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.buckets import BucketTable

PRIMARY, SECOND = "primary", "second"


def _merged(keys: list[str], at: str):
    def merged(old: DataFrame, new: DataFrame) -> DataFrame:
        rows = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
        rest = [c for c in rows.columns if c not in (*keys, "_new")]
        # the primary's row before the second's; of the primary's the latest, of the second's the first
        rank = F.struct(F.col("origin") == PRIMARY, F.when(F.col("origin") == PRIMARY, F.col("_new")).otherwise(-F.col("_new")), F.col(at))
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row")).select(*keys, "_row.*")

    return merged


def poll(table: BucketTable, primary: Callable[[], DataFrame], second: Callable[[object], DataFrame], at: str, checkpoint: str, limit: int | None = None) -> str:
    """One poll: `primary` where its stream ran, `second` where it failed and the second source alone was read. primary gives the stream; second
    the rows since a mark, null at first; a mark is the highest `at` read. The second source completes a batch of the primary that has
    reached the list's limit (any batch, without one). Rows in the table get a column `origin`."""
    keys = table.keys

    def note() -> dict:
        found = table.manifest()
        return (found and found["note"]) or {"batch": -1, "mark": None}

    def commit(rows: DataFrame | None, number: int) -> None:
        had = note()
        if rows is not None and number <= had["batch"]:
            return
        full = rows is None or limit is None or rows.limit(limit).count() >= limit
        mark, parts = had["mark"], [] if rows is None else [rows.withColumn("origin", F.lit(PRIMARY))]
        if full:
            more = second(mark).persist()
            (read,) = more.agg(F.max(F.col(at).cast("string"))).first()
            mark = read or mark
            known = more if rows is None else more.join(rows.select(*keys), keys, "left_anti")
            parts.append(known.withColumn("origin", F.lit(SECOND)))
        new = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        table.merge(new, _merged(keys, at), note={"batch": max(number, had["batch"]), "mark": mark})

    try:
        stream = primary()
        stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return PRIMARY
    except PySparkException:
        commit(None, -1)
        return SECOND
