"""How queries are registered: a function of the tables, beside SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewright.operators.files import shared_folder


def scratch(df: DataFrame, label: str) -> str:
    """A new path for a query's own tables in the shared folder, which is set beside the warehouse where a session names none."""
    spark = df.sparkSession
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", spark.conf.get("spark.sql.warehouse.dir"))
    return shared_folder(spark, label)


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None):
        def register(f):
            self.queries[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
            if sql:
                self.sql[f.__name__] = sql
            return f

        return register
