"""Queries over tables that are kept and rewritten in parts, and over the text index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators import keyed, master, store
from tidewright.operators.buckets import BucketTable
from tidewright.operators.textindex import TextIndex
from tidewright.plans.base import Registry, scratch

QUERIES = Registry()
query = QUERIES.query

#: LIKE patterns of one stretch, several, a short one and one that nothing holds.
_PATTERNS = ("%LICENSE%", "%the%of_the%", "%qz%", "%password%=%", "%no text holds this%")


@query("SELECT p AS pattern, doc_id, length(text) AS length FROM documents JOIN (VALUES " + ", ".join(f"('{p}')" for p in _PATTERNS) + ") v(p) ON text ILIKE p")
def q127_indexed_search(t):
    """Texts found through a trigram index that was appended to twice."""
    docs = t("documents").select("doc_id", "text")
    index = TextIndex(docs.sparkSession, scratch(docs, "text-index"), "doc_id", "text", 16)
    index.append(docs.filter("doc_id % 3 = 0"))
    index.append(docs.filter("doc_id % 3 <> 0 OR doc_id IS NULL"))
    found = [index.search(p).select(F.lit(p).alias("pattern"), "doc_id", F.length("text").alias("length")) for p in _PATTERNS]
    return reduce(DataFrame.unionByName, found)


@query("""WITH o AS (SELECT *, o_custkey % 40 AS shard FROM orders),
    a AS (SELECT o_orderkey, shard, o_totalprice AS price, o_orderstatus AS status, o_orderdate AS told FROM o WHERE o_orderkey % 4 > 0),
    b AS (SELECT o_orderkey, shard, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice + 1 END AS price, 'X' AS status, o_orderdate + INTERVAL (CAST(o_orderkey % 3 - 1 AS INT)) DAY AS told FROM o WHERE shard < 6)
    SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.shard, b.shard) AS shard, CASE WHEN b.told >= a.told OR a.told IS NULL THEN coalesce(b.price, a.price) ELSE a.price END AS price,
        CASE WHEN b.told >= a.told OR a.told IS NULL THEN b.status ELSE a.status END AS status FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey AND a.shard = b.shard WHERE coalesce(a.shard, b.shard) <> 7""")
def q128_bucket_merges(t):
    """A stored table, corrections of a few shards under a guard, and a shard that goes: each commit rewrites its own buckets alone."""
    o = t("orders").withColumn("shard", F.col("o_custkey") % 40)
    first = o.filter("o_orderkey % 4 > 0").selectExpr("o_orderkey", "shard", "o_totalprice AS price", "o_orderstatus AS status", "o_orderdate AS told")
    few = o.filter("shard < 6").selectExpr("o_orderkey", "shard", "CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice + 1 END AS price", "'X' AS status", "o_orderdate + make_dt_interval(CAST(o_orderkey % 3 - 1 AS INT)) AS told")
    table = BucketTable(o.sparkSession, scratch(o, "orders"), ["shard", "o_orderkey"], 64, deal=["shard"])
    order = [F.col("told")]
    table.upsert(first, order, guard="told")
    table.upsert(few, order, {"price": keyed.MERGE}, "told")
    table.delete(o.filter("shard = 7").select("shard", "o_orderkey"))
    table.expire(1)
    return table.read().select("o_orderkey", "shard", "price", "status")


@query("""WITH p AS (SELECT user_id, CAST(ts AS DATE) AS d, CASE WHEN event_type <> 'error' THEN event_type END AS ex, value, event_id FROM events)
    SELECT user_id, strftime(d, '%Y-%m-%d') AS d, coalesce(ex, 'none') AS ex, arg_max(value, (event_id % 2, event_id)) AS value FROM p GROUP BY user_id, d, ex""")
def q129_series_at_rest(t):
    """Points of series that come in two batches: those of the second replace the first's with the same keys, a null exchange being a key."""
    points = t("events").select("user_id", F.col("ts").cast("date").alias("d"), F.expr("CASE WHEN event_type <> 'error' THEN event_type END AS ex"), "value", "event_id")
    keys = ["user_id", "d", "ex"]
    table = BucketTable(points.sparkSession, scratch(points, "series"), keys, 16, deal=["user_id"])
    for k in (0, 1):
        table.merge(points.filter(f"event_id % 2 = {k}"), lambda old, new: keyed.merge_series(old, new, keys, [F.col("event_id")]))
    return table.read().select("user_id", F.date_format("d", "yyyy-MM-dd").alias("d"), F.coalesce("ex", F.lit("none")).alias("ex"), "value")


@query("""SELECT coalesce(o.c_custkey, n.c_custkey) AS code, coalesce(n.c_name || ' KK', o.c_name) AS name, CASE WHEN o.c_custkey IS NOT NULL THEN 'listed' END AS status, CASE WHEN o.c_custkey IS NOT NULL THEN '2000-01-01' END AS listing_date
    FROM (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') o FULL JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') n ON o.c_custkey = n.c_custkey""")
def q131_master_upsert(t):
    """A list merged into the master, which leaves states and dates to disclosures."""
    row = lambda df, name, status, day: df.select(F.col("c_custkey").alias("code"), name.alias("name"), F.lit(status).alias("status"), F.lit(day).alias("listing_date"), F.lit(None).cast("string").alias("delisting_date"))
    old = row(t("customer").filter("c_mktsegment <> 'BUILDING'"), F.col("c_name"), "listed", "2000-01-01")
    new = row(t("customer").filter("c_mktsegment <> 'MACHINERY'"), F.concat("c_name", F.lit(" KK")), "unknown", "2024-01-01")
    return master.upsert(old, new).select("code", "name", "status", "listing_date")


@query("""SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(o_orderkey % 3 AS INTEGER) AS rest FROM orders""")
def q132_typed_sidecar(t):
    """A table written beside its raw file with its own types, and read back."""
    rows = t("orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"), (F.col("o_orderkey") % 3).cast("int").alias("rest"))
    out = rows.sparkSession.read.parquet(store.write_typed(rows, scratch(rows, "sidecar"), "orders.json"))
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
