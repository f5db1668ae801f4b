"""Keyed tables at rest that are rewritten bucket by bucket.

A table is cut into a fixed number of buckets by the hash of its key. A commit writes the buckets that it touches to a folder of its
own in one job, and then a manifest: a small file that names the folder in which each bucket stands. A manifest appears under its number
at once or not at all, and only if that number is free, so readers see whole commits, a writer that dies leaves nothing but a folder that
no manifest names, and of two writers with one number one fails. A merge reads, shuffles and writes the touched buckets alone.

Keys are compared null for null. Each manifest holds the table's schema and number of buckets; columns may be added by a commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators.files import Folder
from tidewright.operators.keyed import apply_in_order

BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer has committed under the same number."""


class BucketTable:
    """deal: the columns of the key that rows are dealt out by, all of them if none are named."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64, deal: list[str] | None = None):
        self.spark, self.path, self.keys, self.deal = spark, path.rstrip("/"), keys, deal or keys
        self.folder = Folder(spark, self.path)
        newest = self.manifest()
        if newest and (newest["keys"], newest["deal"]) != (keys, self.deal):
            raise ValueError(f"the table's key is {newest['keys']}, dealt out by {newest['deal']}")
        self.buckets = newest["buckets"] if newest else buckets

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.folder.names("manifests") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of a version, or the newest; null if there is none."""
        numbers = self.versions()
        if version is None and not numbers:
            return None
        return json.loads(self.folder.read(f"manifests/{numbers[-1] if version is None else version}.json"))

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.deal), F.lit(self.buckets)).cast("int")

    def read(self, version: int | None = None, buckets: list[int] | None = None, schema: T.StructType | str | None = None) -> DataFrame:
        """The table, or some of its buckets; without a version yet, an empty table of the given schema."""
        found = self.manifest(version)
        if found is None:
            if schema is None:
                raise ValueError(f"no version of {self.path}")
            return self.spark.createDataFrame([], schema)
        kind = T.StructType.fromJson(found["schema"])
        paths = [f"{self.path}/{d}/{BUCKET}={b}" for b, d in found["standing"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)

    def merge(self, new: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame], number: int | None = None, check: Callable[[DataFrame, DataFrame], None] | None = None, note: dict | None = None) -> int | None:
        """Commit merged(old, new) for the buckets that new has keys of, old being these buckets alone: the commit's number, or null for
        nothing to do. A number that is committed already is left alone, so a batch that is run again changes nothing. check gets the
        touched buckets before and after, as written, and stops the commit by raising. A note, such as how far a source was read, is
        committed with the rows, even where there are none."""
        found = self.manifest()
        at = found["number"] if found else -1
        if number is not None and number <= at:
            return None
        number = at + 1 if number is None else number
        new = new.withColumn(BUCKET, self.bucket_of()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # at most as many as buckets
            if not touched and note is None:
                return None
            if not touched and found is None:
                raise ValueError("a table begins with rows")
            old = self.read(buckets=touched, schema=T.StructType([f for f in new.schema.fields if f.name != BUCKET]))
            out = (merged(old, new.drop(BUCKET)) if touched else old).withColumn(BUCKET, self.bucket_of())
            place = f"data/{number}-{uuid.uuid4().hex}"
            out.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{place}")
            kind = T.StructType([f for f in out.schema.fields if f.name != BUCKET])
            if check:
                written = self.spark.read.schema(kind).parquet(*[f"{self.path}/{place}/{n}" for n in self.folder.names(place) if n.startswith(BUCKET)])
                check(old, written)
            # a bucket whose rows are all gone has no folder
            made = {int(n.partition("=")[2]) for n in self.folder.names(place) if n.startswith(BUCKET)}
            standing = {b: d for b, d in (found["standing"] if found else {}).items() if int(b) not in touched} | {str(b): place for b in sorted(made)}
            told = {"number": number, "keys": self.keys, "deal": self.deal, "buckets": self.buckets, "touched": touched, "standing": standing, "schema": kind.jsonValue(), "note": note if note is not None else found and found["note"]}
            if not self.folder.create(f"manifests/{number}.json", json.dumps(told)):
                raise Conflict(f"version {number} of {self.path} is taken")
            return number
        finally:
            new.unpersist()

    def upsert(self, new: DataFrame, order: list[Column], policy: dict[str, str] | None = None, guard: str | None = None, scope: str | None = None, number: int | None = None) -> int | None:
        """Merge rows in, one after another in their order, each column under its policy (see keyed.apply_in_order)."""
        return self.merge(new, lambda old, rows: apply_in_order(old, rows, self.keys, order, policy, guard, scope), number)

    def delete(self, keys: DataFrame, number: int | None = None) -> int | None:
        """Remove the rows of some keys."""

        def without(old, gone):
            marked = old.withColumn("_gone", F.lit(0)).unionByName(gone.select(*self.keys).distinct().withColumn("_gone", F.lit(1)), allowMissingColumns=True)
            kept = marked.groupBy(*self.keys).agg(F.max("_gone").alias("_any"), F.max(F.when(F.col("_gone") == 0, F.struct(*[c for c in old.columns if c not in self.keys]))).alias("_row"))
            return kept.filter("_any = 0").select(*self.keys, "_row.*").select(*old.columns)

        return self.merge(keys.select(*self.keys), without, number)

    def expire(self, keep: int = 2) -> list[str]:
        """Remove all but the newest `keep` versions, and the folders that these don't name and no writer can still be at: the names of
        the folders that went."""
        numbers = self.versions()
        kept = [self.manifest(n) for n in numbers[-keep:]]
        for n in numbers[:-keep]:
            self.folder.remove(f"manifests/{n}.json")
        named = {d for m in kept for d in m["standing"].values()}
        gone = [f"data/{n}" for n in self.folder.names("data") if f"data/{n}" not in named and int(n.partition("-")[0]) <= max(numbers, default=-1)]
        for d in gone:
            self.folder.remove(d)
        return gone
