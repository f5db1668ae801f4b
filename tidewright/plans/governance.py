"""Queries over freshness, guards, drift and licence coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.functions import values
from tidewright.operators import quality
from tidewright.plans.base import Registry

QUERIES = Registry()
query = QUERIES.query

_NOW = "2024-02-05 03:00:00"  # Monday noon in the market's zone


def _now():
    return F.lit(_NOW).cast("timestamp")


def _observed(t):
    """An observation for each event type, named as datasets are."""
    named = F.when(F.col("event_type") == "click", "tdnet_disclosures").when(F.col("event_type") == "view", "jsf_supply").when(F.col("event_type") == "error", "core_stocks").when(F.col("event_type") == "purchase", "yutai_benefits").otherwise("other")
    rows = t("events").groupBy(named.alias("dataset")).agg(F.max("ts").alias("at"), F.count(F.lit(1)).alias("n"))
    day = F.when(F.col("dataset").isin("tdnet_disclosures", "jsf_supply"), F.date_format(F.date_add("at", 3), "yyyy-MM-dd"))
    return rows.select("dataset", day.alias("latest_data_date"), F.unix_seconds(F.col("at").cast("timestamp")).alias("updated_at"), F.col("n").alias("row_count"))


@query("""WITH o AS (SELECT CASE event_type WHEN 'click' THEN 'tdnet_disclosures' WHEN 'view' THEN 'jsf_supply' WHEN 'error' THEN 'core_stocks' WHEN 'purchase' THEN 'yutai_benefits' ELSE 'other' END AS dataset, max(ts) AS tt FROM events GROUP BY 1),
    a AS (SELECT dataset, tt, CASE WHEN dataset IN ('tdnet_disclosures', 'jsf_supply') THEN CAST(tt AS DATE) + 3 END AS d FROM o),
    b AS (SELECT *, CASE WHEN dataset = 'jsf_supply' THEN CASE isodow(d) WHEN 5 THEN d + 3 WHEN 6 THEN d + 2 ELSE d + 1 END ELSE d END AS due FROM a),
    g AS (SELECT dataset, greatest(0, (epoch(TIMESTAMP '2024-02-05 12:00:00') - epoch(due::TIMESTAMP)) / 3600.0 - 24 * coalesce(len(list_filter(range(due + 1, DATE '2024-02-06', INTERVAL 1 DAY), lambda x: isodow(x) >= 6)), 0)) AS age FROM b WHERE due IS NOT NULL)
    SELECT dataset, verdict, CASE WHEN dataset = 'jsf_supply' AND verdict <> 'unknown' THEN 'warning' WHEN verdict IN ('green', 'not_refreshed') THEN 'info' ELSE 'problem' END AS level FROM (
        SELECT dataset, CASE WHEN age <= 30 THEN 'green' WHEN age <= 48 THEN 'yellow' ELSE 'red' END AS verdict FROM g UNION ALL SELECT 'core_stocks', 'green' UNION ALL SELECT 'yutai_benefits', 'not_refreshed' UNION ALL SELECT 'other', 'unknown')
    UNION ALL SELECT * FROM (VALUES ('d1_core_stock_financials', 'missing', 'problem'), ('edinet_documents', 'missing', 'problem'), ('financials', 'missing', 'problem'))""")
def q96_freshness_report(t):
    """The verdict on every observation, and what of it is a problem."""
    spark = t("nation").sparkSession
    declared, exempt = quality.thresholds(spark), spark.createDataFrame([(x, "kept as it is") for x in quality.NOT_REFRESHED], "dataset string, reason string")
    accepted = spark.createDataFrame([("jsf_supply", "late for now")], "dataset string, reason string")
    return quality.freshness_report(quality.verdicts(_observed(t), declared, exempt, _now()), declared, accepted, exempt)


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 4 AND n_nationkey % 3 > 0 THEN 'unknown' WHEN n_nationkey % 4 = 0 THEN 'red' WHEN n_nationkey % 4 = 1 THEN 'unknown' WHEN n_nationkey % 3 = 0 THEN 'not_refreshed' WHEN n_nationkey % 5 = 3 THEN 'unknown' WHEN n_nationkey <= 10 THEN 'green' WHEN n_nationkey <= 15 THEN 'yellow' ELSE 'red' END AS verdict FROM nation""")
def q97_verdict_order(t):
    """The order in which a verdict is found: undeclared, empty, uncounted, exempt, then age."""
    k = F.col("n_nationkey")
    rows = F.when(k % 4 == 0, 0).when(k % 4 > 1, 7)
    verdict = values.judge(F.when(k % 5 != 3, k.cast("double")), rows, F.when(k % 5 != 4, 10.0), F.when(k % 5 != 4, 15.0), k % 3 == 0)
    return t("nation").select("n_nationkey", verdict.alias("verdict"))


@query("""WITH d AS (SELECT * FROM nation WHERE n_nationkey % 2 = 0), a AS (SELECT n_name, CASE WHEN n_regionkey > 0 THEN n_name ELSE ' ' END AS reason FROM nation WHERE n_nationkey % 3 = 0), e AS (SELECT n_name, CASE WHEN n_regionkey < 4 THEN n_name END AS reason FROM nation WHERE n_nationkey % 5 = 1)
    SELECT n_name AS dataset, 'accepted and exempt' AS problem FROM a WHERE n_name IN (SELECT n_name FROM e) UNION ALL SELECT n_name, 'judged and exempt' FROM e WHERE n_name IN (SELECT n_name FROM d)
    UNION ALL SELECT n_name, 'accepted without a threshold' FROM a WHERE n_name NOT IN (SELECT n_name FROM d) UNION ALL SELECT n_name, 'no reason' FROM (FROM a UNION ALL FROM e) WHERE trim(coalesce(reason, '')) = ''""")
def q98_declarations(t):
    """Declarations that contradict each other: the sets of what is accepted and what is exempt must not meet."""
    said = lambda where, reason: t("nation").filter(where).select(F.col("n_name").alias("dataset"), F.expr(reason).alias("reason"))
    accepted, exempt = said("n_nationkey % 3 = 0", "CASE WHEN n_regionkey > 0 THEN n_name ELSE ' ' END"), said("n_nationkey % 5 = 1", "CASE WHEN n_regionkey < 4 THEN n_name END")
    return quality.declaration_conflicts(said("n_nationkey % 2 = 0", "n_name"), accepted, exempt)


@query("""SELECT user_id, CASE WHEN last IS NULL THEN 'never' WHEN last < epoch(TIMESTAMP '2024-01-30 00:00:00') - 48 * 3600 THEN 'silent' END AS problem FROM (SELECT user_id, max(CAST(floor(epoch(ts)) AS BIGINT)) FILTER (event_type = 'signup') AS last FROM events GROUP BY user_id)""")
def q99_probe_silence(t):
    """Whether observing jobs still succeed: failures don't count."""
    runs = t("events").select(F.col("user_id").alias("job_name"), F.when(F.col("event_type") == "signup", quality.SUCCESS).otherwise(quality.FAILURE).alias("status"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("finished_at"))
    return quality.silences(runs, F.lit("2024-01-30 00:00:00").cast("timestamp")).select(F.col("job_name").alias("user_id"), "problem")


@query("""SELECT job_name, count(*) AS idle FROM (SELECT 'j' || CAST(user_id AS VARCHAR) AS job_name, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:00:00' AND user_id % 7 > 0) WHERE rn <= 5 AND value < 50 AND event_type <> 'error' GROUP BY job_name HAVING count(*) >= 3""")
def q100_idle_jobs(t):
    """Collecting jobs whose recent successes processed nothing; diagnostic jobs and old runs don't count."""
    name = F.when(F.col("user_id") % 7 == 0, "ops_check").otherwise(F.concat(F.lit("j"), "user_id"))
    runs = t("events").select(name.alias("job_name"), F.unix_micros(F.col("ts").cast("timestamp")).alias("finished_at"), F.when(F.col("value") < 50, 0).otherwise(1).alias("processed"), F.when(F.col("event_type") == "error", quality.FAILURE).otherwise(quality.SUCCESS).alias("status"), "ts")
    recent = runs.filter(F.col("ts") >= F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")).withColumn("finished_at", F.col("finished_at") / 1e6)
    return quality.idle_jobs(recent, F.lit("2024-02-01 00:00:00").cast("timestamp"))


@query("""SELECT c_custkey, '$' AS path, 'updated' AS missing FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'bars', 'bars' FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'bars[]', 'o' FROM customer WHERE c_custkey % 3 = 1""")
def q101_contract(t):
    """Keys that payloads must have at their top and in each element of an array."""
    k = F.col("c_custkey")
    bars = F.when(k % 3 == 0, "").when(k % 3 == 1, ',"bars":[{"d":1},{"d":1,"o":null}]').otherwise(',"bars":[{"d":1,"o":2}]')
    payload = F.concat(F.lit('{"code":1'), F.when(k % 2 == 1, ',"updated":null').otherwise(""), bars, F.lit("}"))
    return quality.contract_breaks(t("customer").select("c_custkey", payload.alias("payload")), "c_custkey", ["code", "updated"], {"bars": ["d", "o"]})


@query("""SELECT c_custkey, problem FROM (SELECT c_custkey, unnest(['another writer now', 'another writer before', 'first_date moved on', 'series.a gone', 'series.a shorter', 'series.a elements lost']) AS problem, unnest(range(6)) AS k FROM customer) WHERE c_custkey % 7 = k""")
def q102_guard(t):
    """Why a payload may not replace the one before it."""
    k = F.col("c_custkey") % 7
    text = lambda writer, first, items: F.concat(F.lit('{"writer":"'), writer, F.lit('","first_date":"'), first, F.lit('","series":{'), items, F.lit("}}"))
    old = t("customer").select("c_custkey", text(F.when(k == 1, "other").otherwise("me"), F.lit("2024-01-01"), F.lit('"a":[{"d":1,"v":2},{"d":2}]')).alias("payload"))
    items = F.when(k == 3, '"b":[]').when(k == 4, '"a":[{"d":2}]').when(k == 5, '"a":[{"d":2},{"d":3},{"d":4}]').otherwise('"a":[{"d":2},{"v":2,"d":1},{"d":3}]')
    new = t("customer").select("c_custkey", text(F.when(k == 0, "other").otherwise("me"), F.when(k == 2, "2024-01-02").otherwise("2023-01-01"), items).alias("payload"))
    return quality.guard_problems(old, new, "c_custkey", ["series.a"], "me")


@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 2 WHEN c_mktsegment = 'MACHINERY' THEN 3 ELSE 2 END AS size FROM customer""")
def q103_guarded_write(t):
    """What is stored after a guarded replacement: payloads that would shrink a series don't come through."""
    text = lambda items: F.concat(F.lit('{"writer":"me","a":['), items, F.lit("]}")).alias("payload")
    old = t("customer").select("c_custkey", text(F.lit("1,2")))
    new = t("customer").select("c_custkey", text(F.when(F.col("c_mktsegment") == "BUILDING", "1").when(F.col("c_mktsegment") == "MACHINERY", "2,3,1").otherwise("2,1")))
    out = quality.guarded(old, new, "c_custkey", ["a"], "me")
    return out.select("c_custkey", F.size(F.from_json(F.get_json_object("payload", "$.a"), "array<int>")).alias("size"))


_TABLES = ("customer", "documents", "events", "labels", "lineitem", "nation", "orders", "part")
_KINDS = "CASE data_type WHEN 'VARCHAR' THEN 'STRING' WHEN 'INTEGER' THEN 'INT' WHEN 'TIMESTAMP' THEN 'TIMESTAMP_NTZ' ELSE data_type END"


def _declared(spark):
    """What is declared of two tables: of orders a wrong type, a nullability that doesn't hold, a column that is gone and one left out."""
    rows = [
        ("orders", "o_orderkey", "BIGINT", True), ("orders", "o_custkey", "bigint", False), ("orders", "o_orderstatus", "STRING", True), ("orders", "o_totalprice", "DECIMAL(12,2)", True), ("orders", "o_clerk", "STRING", True),
        ("orders", "o_orderpriority", "STRING", True), ("nation", "n_nationkey", "INT", True), ("nation", "n_name", "STRING", True), ("nation", "n_regionkey", "INT", True), ("returns", "r_orderkey", "BIGINT", True),
    ]
    return spark.createDataFrame(rows, "table string, column string, kind string, nullable boolean")


_DECLARED_SQL = """(VALUES ('orders', 'o_orderkey', 'BIGINT', 'YES'), ('orders', 'o_custkey', 'BIGINT', 'NO'), ('orders', 'o_orderstatus', 'STRING', 'YES'), ('orders', 'o_totalprice', 'DECIMAL(12,2)', 'YES'), ('orders', 'o_clerk', 'STRING', 'YES'),
    ('orders', 'o_orderpriority', 'STRING', 'YES'), ('nation', 'n_nationkey', 'INT', 'YES'), ('nation', 'n_name', 'STRING', 'YES'), ('nation', 'n_regionkey', 'INT', 'YES'), ('returns', 'r_orderkey', 'BIGINT', 'YES')) d(t, c, kind, nullable)"""


@query(f"""WITH o AS (SELECT table_name AS t, column_name AS c, {_KINDS} AS kind, is_nullable AS nullable FROM information_schema.columns WHERE table_name IN ('orders', 'nation'))
    SELECT coalesce(o.t, d.t) AS "table", coalesce(o.c, d.c) AS "column", CASE WHEN o.t IS NULL THEN 'missing' WHEN d.t IS NULL THEN 'undeclared' WHEN o.kind <> d.kind THEN 'type' ELSE 'nullability' END AS problem
    FROM o FULL JOIN {_DECLARED_SQL} ON o.t = d.t AND o.c = d.c WHERE o.t IS NULL OR d.t IS NULL OR o.kind <> d.kind OR o.nullable <> d.nullable""")
def q104_drift(t):
    """The schemas of stored tables against what is declared, both ways."""
    tables = {n: t(n) for n in ("orders", "nation")}
    return quality.schema_drift(quality.schema_of(tables), _declared(tables["nation"].sparkSession))


@query("""WITH o AS (SELECT table_name AS t, column_name AS c FROM information_schema.columns WHERE table_name IN ('customer', 'documents', 'events', 'labels', 'lineitem', 'nation', 'orders', 'part')),
    d AS (SELECT * FROM (VALUES ('customer', 'row-tag'), ('documents', 'row-tag'), ('events', 'unclassified'), ('labels', 'uniform'), ('returns', 'uniform'), ('orders', 'column-map'), ('gone', 'column-map')) v(t, kind)),
    m AS (SELECT * FROM (VALUES ('orders', 'o_orderkey'), ('orders', 'o_clerk'), ('gone', 'x')) v(t, c))
    SELECT DISTINCT t AS "table", NULL::VARCHAR AS "column", 'warning' AS level, 'table not declared' AS problem FROM o WHERE t NOT IN (SELECT t FROM d) UNION ALL SELECT t, NULL, 'failure', 'table vanished' FROM d WHERE t NOT IN (SELECT t FROM o)
    UNION ALL SELECT t, NULL, 'warning', 'table unclassified' FROM d WHERE kind = 'unclassified' AND t IN (SELECT t FROM o) UNION ALL SELECT t, NULL, 'failure', 'no row tag' FROM d WHERE kind = 'row-tag' AND t NOT IN (SELECT t FROM o WHERE c = 'source')
    UNION ALL SELECT t, c, 'failure', 'column vanished' FROM m WHERE t IN (SELECT t FROM o) AND (t, c) NOT IN (SELECT (t, c) FROM o) UNION ALL SELECT t, c, 'warning', 'column without a licence' FROM o WHERE t = 'orders' AND c NOT IN (SELECT c FROM m WHERE t = 'orders')""")
def q105_licence_coverage(t):
    """Licences of the tables that are there, a row's source being its tag."""
    observed = quality.schema_of({n: t(n) for n in _TABLES})
    spark = observed.sparkSession
    tables = spark.createDataFrame([("customer", "row-tag"), ("documents", "row-tag"), ("events", "unclassified"), ("labels", "uniform"), ("returns", "uniform"), ("orders", "column-map"), ("gone", "column-map")], "table string, kind string")
    return quality.licence_coverage(observed, tables, spark.createDataFrame([("orders", "o_orderkey"), ("orders", "o_clerk"), ("gone", "x")], "table string, column string"), "source")


@query("""SELECT n_name AS dataset, 'all' AS column_group, CASE WHEN n_nationkey < 5 THEN 'missing' WHEN n_nationkey < 10 THEN 'mismatched' ELSE 'orphan' END AS status FROM nation WHERE n_nationkey < 10 OR n_nationkey > 20""")
def q106_writer_claims(t):
    rows = t("nation").select(F.col("n_name").alias("dataset"), F.lit("all").alias("column_group"), "n_nationkey")
    declared = rows.filter("n_nationkey <= 20").select("dataset", "column_group", F.lit("a").alias("writer"))
    return quality.writer_claims(declared, rows.filter("n_nationkey >= 5").select("dataset", "column_group", F.when(F.col("n_nationkey") < 10, "b").otherwise("a").alias("writer")))


@query("""SELECT n_name AS "column", n_nationkey < 5 AS publishable FROM nation""")
def q107_publishable_columns(t):
    columns = t("nation").select(F.lit("t").alias("table"), F.col("n_name").alias("column"), "n_nationkey")
    licences = columns.filter("n_nationkey < 10").select("table", "column", F.when(F.col("n_nationkey") < 5, "commercial-ok").otherwise("factual-cite").alias("tag"))
    return quality.is_publishable_column(columns, licences).select("column", "publishable")


@query("""SELECT 'orders' AS dataset, strftime(max(o_orderdate), '%Y-%m-%d') AS latest, count(*) AS row_count, 1 AS has_date, max(o_orderkey) AS fetched FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'nation', NULL, count(*), 0, NULL FROM nation""")
def q108_freshness_where(t):
    return quality.freshness({"orders": (t("orders"), "o_orderdate", "o_orderstatus = 'F'", "o_orderkey"), "nation": (t("nation"), None)})


@query("""SELECT 'orders' AS name, (SELECT count(*) FROM orders) AS processed, 0 AS failed UNION ALL SELECT 'none', 0, 1""")
def q109_empty_lists(t):
    told = lambda df, name: quality.empty_is_failure(df, name).select(F.lit(name).alias("name"), "processed", "failed")
    return told(t("orders"), "orders").unionByName(told(t("orders").filter("o_totalprice < 0"), "none"))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'commercial-ok' WHEN 1 THEN 'factual-cite' ELSE 'personal-only' END AS tag FROM documents""")
def q110_source_licence(t):
    """The tag that a row has from its source."""
    source = F.element_at(F.array(*[F.lit(x) for x in ("EDINET", "TDnet", "JPX", "日証金")]), (F.col("doc_id") % 4 + 1).cast("int"))
    return t("documents").select("doc_id", values.source_licence(source).alias("tag"))


@query("""SELECT c_custkey, problem FROM (SELECT c_custkey, unnest(['empty gone', 'deep.er.a gone', 'deep.er.a shorter', 'deep.er.a elements lost', 'top elements lost']) AS problem, unnest(range(5)) AS k FROM customer) WHERE c_custkey % 7 = k""")
def q130_arrays_found(t):
    """A guarded replacement whose arrays are found wherever they stand; an array that was empty may not vanish either."""
    k = F.col("c_custkey") % 7
    text = lambda empty, deep, top: F.concat(F.lit('{"writer":"me",'), empty, F.lit('"deep":{"n":1,"er":{'), deep, F.lit('}},"top":['), top, F.lit("]}"))
    old = t("customer").select("c_custkey", text(F.lit('"empty":[],'), F.lit('"a":[{"d":1,"v":2},[3]]'), F.lit("1")).alias("payload"))
    deep = F.when(k == 1, '"b":[]').when(k == 2, '"a":[[3]]').when(k == 3, '"a":[[3],[4],{"d":1}]').otherwise('"a":[[3],{"v":2,"d":1},5]')
    new = t("customer").select("c_custkey", text(F.when(k == 0, "").otherwise('"empty":[],'), deep, F.when(k == 4, "2,3").otherwise("2,1")).alias("payload"))
    return quality.guard_problems(old, new, "c_custkey", None, "me")
