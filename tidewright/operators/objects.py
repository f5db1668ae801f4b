"""Raw objects and their index: the object first, then the row that names it.

Objects lie in a table of buckets by key, the index in one by digest. Both are committed with a manifest, in this order: a writer that dies
in between leaves objects without a row, never a row without its object, and the next run finds the objects and only writes their rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.codes import derived_key, raw_key
from tidewright.operators.buckets import BucketTable
from tidewright.operators.keyed import KEEP

#: Fixed value: until this day objects may still lie under the key that names no document.
LEGACY_UNTIL = "2026-12-31"


def with_keys(rows: DataFrame) -> DataFrame:
    """rows (content, source, datatype, scope, data_date, ext, doc_id, fetched_at, ...) with sha256, size_bytes and keys: where their object
    may lie, the first being where a new one goes. A row without a date of its own has that of its fetching."""
    dated = rows.withColumns({"sha256": F.sha2("content", 256), "size_bytes": F.octet_length("content").cast("long"), "data_date": F.coalesce(F.col("data_date"), F.to_date("fetched_at"))})
    parts = [F.col(c) for c in ("source", "datatype", "scope", "data_date", "sha256", "ext")]
    own = raw_key(*parts, F.col("doc_id"))
    legacy = F.when((F.coalesce("doc_id", F.lit("")) != "") & (F.col("data_date") <= F.lit(LEGACY_UNTIL).cast("date")), raw_key(*parts))
    return dated.withColumn("keys", F.array_compact(F.array(own, legacy)))


def place(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """rows (sha256, keys, ...) with key and is_there: the first of its keys that a stored object has, else the first of all. One join of the
    keys with those of the objects, no contents."""
    tried = rows.select("sha256", F.posexplode("keys").alias("step", "key"))
    found = tried.join(stored.select("key"), "key").groupBy("sha256").agg(F.min_by("key", "step").alias("_found"))
    told = rows.join(found, "sha256", "left")
    return told.withColumns({"key": F.coalesce("_found", F.col("keys")[0]), "is_there": F.col("_found").isNotNull()}).drop("_found", "keys")


@dataclass
class RawStore:
    spark: SparkSession
    path: str
    buckets: int = 64

    def __post_init__(self):
        self.objects = BucketTable(self.spark, f"{self.path}/objects", ["key"], self.buckets)
        self.index = BucketTable(self.spark, f"{self.path}/index", ["sha256"], self.buckets)

    def keys(self) -> DataFrame:
        """The keys of all objects: a scan of one column."""
        return self.objects.read(schema="key string, content binary").select("key")

    def put(self, rows: DataFrame, order: list[Column]) -> DataFrame:
        """Store objects that aren't there and then index all rows: the index's rows for what was put. Rows with one content are one object,
        the first of the order telling where it lies; when a file was first fetched stays, all else is the last row's."""
        each = with_keys(rows)
        once = each.groupBy("sha256").agg(F.min_by(F.struct("keys", "content"), F.struct(*order)).alias("x")).select("sha256", "x.keys", "x.content")
        placed = place(once.drop("content"), self.keys()).persist()
        try:
            new = once.join(placed.filter("NOT is_there").select("sha256", "key"), "sha256").select("key", "content")
            self.objects.upsert(new, [F.col("key")])
            self.link(each.drop("content", "keys").join(placed.select("sha256", "key"), "sha256"), order)
        finally:
            placed.unpersist()
        return self.index.read().join(each.select("sha256").distinct(), "sha256", "left_semi")

    def link(self, rows: DataFrame, order: list[Column]) -> None:
        """Index rows (sha256, key, ...) whose object is there; a row without one is an error, and nothing is indexed."""
        gone = rows.select("key").distinct().join(self.keys(), "key", "left_anti").limit(1).collect()
        if gone:
            raise ValueError(f"no object {gone[0][0]}")
        self.index.upsert(rows.withColumn("first_fetched_at", F.col("fetched_at")), order, {"first_fetched_at": KEEP})

    def repair(self) -> DataFrame:
        """Keys of objects that no row of the index names: what a writer that died left for the next run."""
        named = self.index.read(schema="sha256 string, key string").select("key")
        return self.keys().join(named, "key", "left_anti")


def derived(rows: DataFrame, suffixes: list[str]) -> DataFrame:
    """rows (key, ...) with derived_keys, one for each kind of file made from an object, beside wherever the object itself lies."""
    return rows.withColumn("derived_keys", F.array(*[derived_key(F.col("key"), F.lit(s)) for s in suffixes]))
