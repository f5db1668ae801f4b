"""Queries whose SQL shows the first digits of a key, on keys that are longer and share them."""

import duckdb
import pytest
from test_queries import SF, rows_of

from tidewright.plans import registry

KEYS = {"supplier": ["s_suppkey"], "customer": ["c_custkey"], "orders": ["o_orderkey", "o_custkey"]}


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    """Three copies of each table with shifted keys, of whose customers less than a half have orders."""
    path = tmp_path_factory.mktemp("long")
    con = duckdb.connect()
    for table, keys in KEYS.items():
        shifted = ", ".join(f"{k} + i * 1000000 AS {k}" for k in keys)
        con.sql(f"COPY (SELECT * REPLACE ({shifted}) FROM '{SF}/{table}.parquet', range(3) r(i) {'WHERE i = 0 OR i = 1 AND o_custkey % 3 = 1' if table == 'orders' else ''}) TO '{path}/{table}.parquet' (FORMAT parquet)")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
    con.sql(f"COPY (SELECT * FROM '{SF}/nation.parquet') TO '{path}/nation.parquet' (FORMAT parquet)")
    con.sql(f"CREATE VIEW nation AS SELECT * FROM '{path}/nation.parquet'")
    return path, con


@pytest.mark.parametrize("name", ["q43_balance_points", "q44_supply_latest", "q45_series_documents", "q55_master_writes", "q56_lifecycle", "q57_sector_changes", "q58_issuer_codes"])
def test_long_keys(spark, copies, name):
    path, con = copies
    assert rows_of(registry.queries()[name](spark, str(path)).toPandas()) == rows_of(con.sql(registry.oracle_sql()[name]).df())


def test_customers_that_come_again(spark, tmp_path):
    con = duckdb.connect()
    con.sql(f"COPY (SELECT c.* FROM '{SF}/customer.parquet' c, range(3)) TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    con.sql(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet'")
    name = "q57_sector_changes"
    assert rows_of(registry.queries()[name](spark, str(tmp_path)).toPandas()) == rows_of(con.sql(registry.oracle_sql()[name]).df())
