"""Every registered query that has SQL, against DuckDB."""

import math

import duckdb
import pandas as pd
import pytest

from tidewright.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def rows_of(frame):
    def plain(v):
        if v is pd.NA or v is pd.NaT or v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return f"{v:.9g}" if isinstance(v, float) else v.isoformat()[:19] if hasattr(v, "isoformat") else str(v)

    columns = sorted(frame.columns)
    return columns, sorted((tuple(plain(v) for v in r) for r in frame[columns].astype(object).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    assert rows_of(registry.queries()[name](spark, SF).toPandas()) == rows_of(duck.sql(registry.oracle_sql()[name]).df())
