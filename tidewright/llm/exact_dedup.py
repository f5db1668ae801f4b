"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 of the text. New rows are digested, brought down to one
entry for each digest with a map-side combine, held against the index by a sort-merge anti-join that shuffles only
the new side, and appended. Everything here is a DataFrame operation.

Defined cases: a null text counts as the empty text; texts are equal when their UTF-8 bytes are; of equal texts in
one batch the row with the largest id stays (null ids count as smallest, and stay only where a text has no other);
a text that an earlier batch brought keeps that batch's row; rows that share both id and text are one row repeated:
the report marks each of them as kept, deduplicate() returns one. Empty tables give empty results. Other columns pass
through deduplicate() untouched, whatever their names. A text of any length is digested whole.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.common import drop_staged, join_by_key, new_path, numbered, stage, without_rows


def digest_of(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))


class DigestIndex:
    """The entries (digest, keep_id, group_size), in a table bucketed and sorted by digest.

    With a path the table outlives the session and is attached again under its name; the bucket count must then stay
    the same. Without one it lives in the shared folder until the driver ends."""

    def __init__(self, spark: SparkSession, name: str | None = None, path: str | None = None, buckets: int | None = None, id_type: str = "bigint"):
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = path or new_path(spark, self.name)
        if not spark.catalog.tableExists(self.name):
            if path is None:
                atexit.register(_forget, spark, self.name)
            spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id {id_type}, group_size BIGINT) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, rows: DataFrame) -> None:
        """Append the texts of rows (id, digest) that the index doesn't have."""
        batch = rows.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        new = batch.hint("merge").join(self.entries().select("digest"), "digest", "left_anti")
        new.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def look_up(self, rows: DataFrame) -> DataFrame:
        """rows (id, digest) with their entries; hot digests meet a broadcast, the rest is shuffled to the buckets."""
        return join_by_key(rows, self.entries(), ["digest"])


def _forget(spark: SparkSession, name: str) -> None:
    if spark.sparkContext._jsc is not None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), digest_of(text_col).alias("digest"))


def exact_groups(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size (rows of the batch that brought the text), kept,
    text_sha256. Texts that the index lacks are appended to it."""
    rows = stage(_digested(docs, id_col, text_col), "digests")
    index = index or DigestIndex(docs.sparkSession, id_type=dict(rows.dtypes)["id"])
    index.add(rows)
    return index.look_up(rows).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one for each text that the index lacks, with all their columns: that with the largest id, of
    several the first by a hash of the other columns. The digests are appended to the index. What a digest's rows come down to
    is found before the shuffle, and texts are not shuffled up to a checked number of rows that go."""
    rows, row = numbered(docs, "numbered")
    others = [F.col(c) for c, kind in docs.dtypes if c not in (id_col, text_col) and not kind.startswith(("map", "variant"))]
    tie = F.xxhash64(*others) if others else F.lit(0).cast("long")
    told = stage(rows.select(F.col(row).alias("row"), F.col(id_col).alias("id"), digest_of(text_col).alias("digest"), tie.alias("tie")), "digests")
    index = index or DigestIndex(docs.sparkSession, id_type=dict(told.dtypes)["id"])
    best = F.max(F.struct(F.col("id"), (-F.col("tie")).alias("tie"), (-F.col("row")).alias("row")))
    kept = told.groupBy("digest").agg(best.alias("best")).hint("merge").join(index.entries().select("digest"), "digest", "left_anti")
    kept = stage(kept.select((-F.col("best.row")).alias("row")), "kept")
    index.add(told.select("id", "digest"))
    gone = told.select("row").join(kept, "row", "left_anti")
    out = without_rows(rows, row, gone).select(*docs.columns)
    drop_staged(told)
    return out
