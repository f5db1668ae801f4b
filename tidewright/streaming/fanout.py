"""A stream that is written to several stores, each on its own.

Every batch is kept in a folder until all stores have it, and a ledger holds a small file for each store and batch that went well. A store that
fails is tried again with the next batch or run, its batches in their order, while the others go on; a batch that no store takes stops
the stream, and is tried again when that is started anew. A batch is handed to a store again only if the store, or the driver, failed before
the ledger had it, so a store that writes under the batch's number has every batch once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewright.operators.files import Folder

Writer = Callable[[DataFrame, int], None]


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.folder = spark, path.rstrip("/"), Folder(spark, path)

    def kept(self) -> list[int]:
        """Batches that are kept, in their order."""
        names = self.folder.names("batches")
        return sorted(int(n) for n in names if n.isdigit() and self.folder.exists(f"batches/{n}/_SUCCESS"))

    def has(self, store: str, number: int) -> bool:
        return self.folder.exists(f"done/{store}/{number}")

    def keep(self, batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batches/{number}")

    def read(self, number: int, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/batches/{number}")

    def note(self, store: str, number: int) -> None:
        self.folder.create(f"done/{store}/{number}", "")

    def forget(self, number: int) -> None:
        self.folder.remove(f"batches/{number}")


def deliver(ledger: Ledger, stores: dict[str, Writer], schema) -> dict[str, str | None]:
    """Hand every store the kept batches that it lacks, in order, up to its first failure: the error of each store, null where it has
    all. Batches that every store has are let go."""
    errors: dict[str, str | None] = {}
    kept = ledger.kept()
    for name, write in stores.items():
        errors[name] = None
        for number in kept:
            if ledger.has(name, number):
                continue
            try:
                write(ledger.read(number, schema), number)
            except Exception as e:
                errors[name] = f"batch {number}: {type(e).__name__}: {e}"
                break
            ledger.note(name, number)
    for number in kept:
        if all(ledger.has(name, number) for name in stores):
            ledger.forget(number)
    return errors


def write_to_all(stream: DataFrame, stores: dict[str, Writer], path: str, checkpoint: str, told: Callable[[int, dict[str, str | None]], None] | None = None) -> StreamingQuery:
    """Write each micro-batch to all stores. told gets the errors of each batch by store."""

    def apply(batch: DataFrame, number: int) -> None:
        ledger = Ledger(batch.sparkSession, path)
        if not any(ledger.has(name, number) for name in stores):
            ledger.keep(batch, number)
        errors = deliver(ledger, stores, batch.schema)
        if told:
            told(number, errors)
        if not any(ledger.has(name, number) for name in stores):
            raise RuntimeError(f"batch {number} was written to no store: {errors}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
