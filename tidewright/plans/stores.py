"""Queries over merges, stores and what is served from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.operators import documents, indicators, keyed, serving, store, supply
from tidewright.plans.base import Registry
from tidewright.sources import disclosures
from tidewright.sources.tidy import TIDY, body_problem, looks_like, tidy_table

QUERIES = Registry()
query = QUERIES.query


def _records(t, status: str):
    """Financial records made from orders of a status: one for each customer, month and kind."""
    return t("orders").filter(F.col("o_orderstatus") == status).select(
        F.col("o_custkey").alias("code"), F.trunc("o_orderdate", "year").alias("fiscal_period_end"), F.col("o_orderpriority").alias("disclosure_type"), F.when(F.col("o_custkey") % 2 == 0, "連結").alias("consolidated"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("net_sales"), F.lit(status).alias("source"), F.when(F.col("o_orderkey") % 2 == 0, "personal-only").otherwise("commercial-ok").alias("license_tag"),
        F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderdate")).alias("disclosed_at"), F.col("o_orderkey").alias("k"),
    )


@query("""WITH RECURSIVE r AS (SELECT o_custkey AS code, date_trunc('year', o_orderdate)::DATE AS e, o_orderpriority AS kind, CASE WHEN o_custkey % 2 = 0 THEN '連結' ELSE '不明' END AS scope, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS v,
        CASE WHEN o_orderkey % 2 = 0 THEN 'personal-only' ELSE 'commercial-ok' END AS tag, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate END AS tt, o_orderkey AS k, o_orderstatus AS s FROM orders),
    f AS (SELECT code, e, kind, scope, arg_max(v, k) FILTER (v IS NOT NULL) AS v, arg_max(tag, k) AS tag, arg_max(tt, k) FILTER (tt IS NOT NULL) AS tt FROM r WHERE s = 'F' GROUP BY ALL),
    n AS (SELECT code, e, kind, scope, v, tag, tt, row_number() OVER (PARTITION BY code, e, kind, scope ORDER BY k) AS i FROM r WHERE s = 'O'),
    state AS (
        SELECT code, e, kind, scope, 0 AS i, v, 'F' AS source, tag, tt FROM f
        UNION ALL SELECT code, e, kind, scope, 1, v, 'O', tag, tt FROM n WHERE i = 1 AND NOT EXISTS (SELECT 1 FROM f WHERE f.code = n.code AND f.e = n.e AND f.kind = n.kind AND f.scope = n.scope)
        UNION ALL SELECT code, e, kind, scope, i, CASE WHEN ok THEN coalesce(v, had_v) ELSE had_v END, CASE WHEN ok THEN 'O' ELSE had_source END, CASE WHEN ok THEN greatest(tag, had_tag) ELSE had_tag END, CASE WHEN ok THEN coalesce(tt, had_tt) ELSE had_tt END
            FROM (SELECT n.*, state.v AS had_v, state.source AS had_source, state.tag AS had_tag, state.tt AS had_tt, coalesce(n.tt >= state.tt OR state.tt IS NULL, false) AS ok
                FROM state JOIN n ON n.code = state.code AND n.e = state.e AND n.kind = state.kind AND n.scope = state.scope AND n.i = state.i + 1))
    SELECT code, CAST(e AS VARCHAR) AS fiscal_period_end, kind AS disclosure_type, scope AS consolidated, v AS net_sales, source, tag AS license_tag
    FROM state QUALIFY i = max(i) OVER (PARTITION BY code, e, kind, scope)""")
def q62_merge_financials(t):
    """Later disclosures of a financial record: values they don't carry stay, the stricter licence stays, older ones change nothing."""
    rank = [F.col("k")]
    old = keyed.fold_batch(_records(t, "F").withColumn("consolidated", F.coalesce("consolidated", F.lit(keyed.UNKNOWN_SCOPE))), keyed.FINANCIAL_KEY, rank, ["net_sales", "disclosed_at"]).drop("k")
    out = keyed.merge_financials(old, _records(t, "O"), rank)
    return out.select("code", F.date_format("fiscal_period_end", "yyyy-MM-dd").alias("fiscal_period_end"), "disclosure_type", "consolidated", "net_sales", "source", "license_tag")


_CORRECTIONS = "l_partkey AS k, CASE WHEN l_quantity < 42 THEN l_shipdate END AS told_at, CASE WHEN l_quantity > 12 THEN l_tax END AS v, l_suppkey AS source, CASE WHEN l_quantity > 40 THEN 'personal-only' WHEN l_quantity > 20 THEN 'factual-cite' ELSE 'commercial-ok' END AS tag, CASE WHEN l_linenumber < 4 THEN l_linestatus END AS scope, l_discount AS first_seen"


@query(f"""WITH RECURSIVE r AS (SELECT {_CORRECTIONS}, l_returnflag = 'A' AS is_old, row_number() OVER (PARTITION BY l_partkey, l_returnflag = 'A' ORDER BY l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS i FROM lineitem),
    o AS (SELECT k, told_at, v, source, tag, scope, first_seen FROM r WHERE is_old AND i = 1), n AS (SELECT * FROM r WHERE NOT is_old),
    state AS (
        SELECT 0 AS i, * FROM o UNION ALL SELECT 1, k, told_at, v, source, tag, scope, first_seen FROM n WHERE i = 1 AND k NOT IN (SELECT k FROM o)
        UNION ALL SELECT i, k, CASE WHEN ok THEN coalesce(told_at, had.told_at) ELSE had.told_at END, CASE WHEN NOT ok THEN had.v WHEN scope IS NOT DISTINCT FROM had.scope THEN coalesce(v, had.v) ELSE v END, CASE WHEN ok THEN source ELSE had.source END,
            CASE WHEN ok AND list_position(['commercial-ok', 'factual-cite', 'personal-only'], tag) >= list_position(['commercial-ok', 'factual-cite', 'personal-only'], had.tag) THEN tag ELSE had.tag END, CASE WHEN ok THEN scope ELSE had.scope END, had.first_seen
            FROM (SELECT n.*, state AS had, coalesce(n.told_at >= state.told_at OR state.told_at IS NULL, false) AS ok FROM state JOIN n ON n.k = state.k AND n.i = state.i + 1))
    SELECT k, strftime(told_at, '%Y-%m-%d') AS told_at, v, source, tag, scope, first_seen FROM state QUALIFY i = max(i) OVER (PARTITION BY k)""")
def q126_applied_in_order(t):
    """Many corrections of one key in a batch, applied one after another: stale ones change nothing, values merge within a scope, the
    strictest licence stays. The SQL applies them by recursion."""
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = t("lineitem").select("l_returnflag", *order, F.expr(f"struct({_CORRECTIONS}) AS x")).select("*", "x.*").drop("x")
    old = keyed.pick_first(rows.filter("l_returnflag = 'A'"), ["k"], [F.col(c) for c in order]).drop("l_returnflag", *order)
    # the guard itself stays where a correction without one is taken
    policy = {"told_at": keyed.MERGE, "v": keyed.MERGE, "tag": keyed.STRICTER, "first_seen": keyed.KEEP}
    new = rows.filter("l_returnflag <> 'A'")
    out = keyed.apply_in_order(old, new.drop("l_returnflag"), ["k"], [F.col(c) for c in order], policy, "told_at", "scope")
    return out.select("k", F.date_format("told_at", "yyyy-MM-dd").alias("told_at"), "v", "source", "tag", "scope", "first_seen")


@query("""SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN n.c_custkey IS NULL THEN o.v WHEN o.s IS NOT DISTINCT FROM n.s THEN coalesce(n.v, o.v) ELSE n.v END AS v, CASE WHEN n.c_custkey IS NULL THEN o.s ELSE n.s END AS s
    FROM (SELECT c_custkey, c_acctbal AS v, CASE WHEN c_nationkey > 5 THEN c_nationkey % 2 ELSE -1 END AS s FROM customer WHERE c_mktsegment <> 'BUILDING') o FULL JOIN (SELECT c_custkey, CASE WHEN c_acctbal > 3000 THEN c_acctbal + 1 END AS v, CASE WHEN c_nationkey > 5 THEN 0 ELSE -1 END AS s FROM customer WHERE c_mktsegment <> 'MACHINERY') n
    ON o.c_custkey = n.c_custkey""")
def q63_scoped_merge(t):
    """Values merge only where the scope of both is one, unknown scopes being one."""
    scope = F.when(F.col("c_nationkey") > 5, F.col("c_nationkey") % 2)
    old = t("customer").filter("c_mktsegment <> 'BUILDING'").select("c_custkey", F.col("c_acctbal").alias("v"), scope.alias("s"))
    new = t("customer").filter("c_mktsegment <> 'MACHINERY'").select("c_custkey", F.when(F.col("c_acctbal") > 3000, F.col("c_acctbal") + 1).alias("v"), F.when(F.col("c_nationkey") > 5, F.lit(0)).alias("s"))
    return keyed.merge_upsert(old, new, ["c_custkey"], {"v": keyed.MERGE}, scope="s").withColumn("s", F.coalesce("s", F.lit(-1)))


@query("""WITH n AS (SELECT l_partkey AS code, l_shipdate, arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_suppkey, l_quantity, l_tax, l_discount)) AS close FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2), o AS (SELECT l_partkey AS code, l_shipdate, min(l_extendedprice) AS close, min(l_orderkey) AS first_fetched_at FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
    SELECT coalesce(o.code, n.code) AS code, strftime(coalesce(o.l_shipdate, n.l_shipdate), '%Y-%m-%d') AS data_date, coalesce(n.close, o.close) AS close, coalesce(first_fetched_at, -1) AS first_fetched_at FROM o FULL JOIN n ON o.code = n.code AND o.l_shipdate = n.l_shipdate""")
def q64_replace_prices(t):
    """Prices by code and day: the last of a batch replaces what is stored, when it was first fetched stays, days unknown are skipped."""
    rows = t("lineitem").select(F.col("l_partkey").alias("code"), F.col("l_shipdate").alias("data_date"), F.col("l_extendedprice").alias("close"), "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_tax", "l_discount", "l_returnflag")
    old = rows.filter("l_returnflag = 'R'").groupBy("code", "data_date").agg(F.min("close").alias("close"), F.min("l_orderkey").alias("first_fetched_at"))
    new = rows.filter("l_returnflag <> 'R'").withColumn("first_fetched_at", F.lit(None).cast("long"))
    unknown = new.limit(5).withColumn("data_date", F.lit(None).cast("timestamp_ntz"))
    out = keyed.replace_by(old, new.unionByName(unknown), ["code", "data_date"], [F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_tax", "l_discount")], ("first_fetched_at",))
    return out.select("code", F.date_format("data_date", "yyyy-MM-dd").alias("data_date"), "close", F.coalesce("first_fetched_at", F.lit(-1)).alias("first_fetched_at"))


@query("""WITH r AS (SELECT DISTINCT 'f' || CAST(length(text) % 50 AS VARCHAR) || '.txt' AS filename, sha256(text) AS sha FROM documents WHERE text IS NOT NULL), s AS (SELECT filename, min(sha) AS held FROM r WHERE sha < '8' GROUP BY 1), f AS (SELECT filename, min(sha) AS first FROM r GROUP BY 1)
    SELECT filename, sha AS sha256, CASE WHEN coalesce(held, first) = sha THEN filename ELSE replace(filename, '.txt', '') || '_' || substr(sha, 1, 8) || '.txt' END AS name FROM r LEFT JOIN s USING (filename) JOIN f USING (filename)""")
def q65_raw_names(t):
    """Names under which raw bytes are kept: nothing stored under a name is overwritten by other bytes."""
    rows = t("documents").filter("text is not null").select(F.concat(F.lit("f"), F.length("text") % 50, F.lit(".txt")).alias("filename"), F.sha2("text", 256).alias("sha256"))
    return store.raw_names(rows.filter("sha256 < '8'").groupBy("filename").agg(F.min("sha256").alias("sha256")), rows)


@query("""WITH d AS (SELECT sha256(text) AS sha256, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1), h AS (SELECT DISTINCT sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL AND source IS NOT NULL AND lang = 'en')
    SELECT sha256 FROM d WHERE sha256 NOT IN (SELECT sha256 FROM h)""")
def q66_unseen_content(t):
    rows = t("documents").filter("text is not null").select(F.sha2("text", 256).alias("sha256"), "lang", "source")
    return store.unseen(rows.select("sha256"), rows.filter("source is not null and lang = 'en'").select("sha256"))


@query("""SELECT 'raw/edinet/xbrl/2024/2024-05-01/' || CAST(doc_id AS VARCHAR) || '/_/' || substr(sha256(coalesce(text, '')), 1, 16) || '.txt' AS key, 'edinet_xbrl_' || CAST(doc_id AS VARCHAR) || '_20240501.txt' AS filename, octet_length(encode(coalesce(text, '')))::BIGINT AS size_bytes FROM documents""")
def q67_raw_files(t):
    fetched = t("documents").select(F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("content"), F.lit("EDINET").alias("source"), F.lit("xbrl").alias("datatype"), F.col("doc_id").cast("string").alias("scope"), F.lit("2024-05-01").cast("date").alias("data_date"), F.lit(".TXT").alias("ext"), F.lit(None).cast("string").alias("doc_id"))
    return store.raw_files(fetched).select("key", F.lower("filename").alias("filename"), "size_bytes")


@query("""SELECT event_id, CAST(value AS VARCHAR) IS NOT NULL AS has_value, CASE WHEN event_id % 2 = 0 THEN '["a","b"]' END AS tags, '{"t":"' || event_type || '"}' AS place FROM events""")
def q68_as_text(t):
    """Tables as all text, nested values as JSON, unknown ones staying unknown."""
    rows = t("events").select("event_id", "value", F.when(F.col("event_id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).alias("tags"), F.struct(F.col("event_type").alias("t")).alias("place"))
    return store.as_text(rows).select(F.col("event_id").cast("long").alias("event_id"), F.col("value").isNotNull().alias("has_value"), "tags", "place")


_NOW = 1706745600  # 2024-02-01 in UTC


@query(f"""SELECT event_id, CAST(NULL AS VARCHAR) AS failed_codes FROM events WHERE epoch(ts) >= {_NOW} - 20 * 86400 UNION ALL SELECT 1000000 + user_id, CASE WHEN count(*) > 50 THEN '50' WHEN user_id % 2 = 0 THEN CAST(count(*) AS VARCHAR) END FROM events GROUP BY user_id""")
def q69_run_log(t):
    """A run log with old rows gone and runs appended, each with a bounded list of failed codes."""
    log = t("events").select("event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("finished_at"), F.lit(None).cast("string").alias("failed_codes"))
    log = store.within_retention(log, F.timestamp_seconds(F.lit(_NOW)), 20)
    counts = t("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    runs = counts.select((F.col("user_id") + 1000000).alias("event_id"), F.lit(_NOW).cast("long").alias("finished_at"), F.when((F.col("user_id") % 2 == 0) | (F.col("n") > 50), F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("failed_codes"))
    out = store.log_runs(log, runs, F.timestamp_seconds(F.lit(_NOW)))
    return out.select("event_id", F.size(F.from_json("failed_codes", "array<bigint>")).cast("string").alias("failed_codes")).withColumn("failed_codes", F.when(F.col("failed_codes") != "-1", F.col("failed_codes")))


@query("SELECT user_id, count(*) AS runs, max(CASE WHEN event_type = 'error' THEN 'x,y' END) AS codes FROM events GROUP BY user_id")
def q70_append_log(t):
    rows = t("events").select("user_id", F.when(F.col("event_type") == "error", F.array(F.lit("x"), F.lit("y"))).otherwise(F.array().cast("array<string>")).alias("failed_codes"))
    log = store.append_log(rows.filter("event_id % 2 = 0").withColumn("failed_codes", F.when(F.size("failed_codes") > 0, F.array_join("failed_codes", ","))), rows.filter("event_id % 2 = 1"))
    return log.groupBy("user_id").agg(F.count(F.lit(1)).alias("runs"), F.max("failed_codes").alias("codes"))


@query("""SELECT coalesce(n.s, o.s) AS dataset, CASE WHEN n.s IS NOT NULL THEN n.c ELSE o.c END AS row_count, CASE WHEN n.s IS NOT NULL THEN 2 ELSE 1 END AS updated_at FROM (SELECT o_orderstatus AS s, count(*) AS c FROM orders GROUP BY 1) o
    FULL JOIN (SELECT o_orderstatus AS s, count(*) AS c FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 100000 GROUP BY 1) n ON o.s = n.s""")
def q71_record_freshness(t):
    counted = lambda df, at: df.groupBy(F.col("o_orderstatus").alias("dataset")).agg(F.count(F.lit(1)).alias("row_count")).withColumn("updated_at", F.lit(at))
    return store.record_freshness(counted(t("orders"), 1), counted(t("orders").filter("o_orderstatus <> 'P' and o_totalprice > 100000"), 2))


@query("""SELECT code, data_type, d, ex, arg_max(v, (new, k)) AS v FROM (SELECT user_id AS code, event_type AS data_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS d, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'x' END AS ex, value AS v, CASE WHEN event_type = 'error' OR value > 60 THEN 1 ELSE 0 END AS new, event_id AS k FROM events) GROUP BY code, data_type, d, ex""")
def q72_series_merge(t):
    """Points of every series: new ones replace old ones of the same day and exchange, unknown exchanges being one; none is lost."""
    rows = t("events").select(F.col("user_id").alias("code"), F.col("event_type").alias("data_type"), F.date_format("ts", "yyyy-MM-dd").alias("d"), F.when(F.col("event_id") % 3 > 0, "x").alias("ex"), F.col("value").alias("v"), F.col("event_id").alias("ord"))
    new = (F.col("data_type") == "error") | (F.col("v") > 60)
    return supply.merge_series(rows.filter(~new), rows.filter(new))


@query("""SELECT 'P' || CAST(o_orderkey AS VARCHAR) AS id, 'P' || CAST(first_value(o_orderkey) OVER w AS VARCHAR) AS keep, o_orderkey = first_value(o_orderkey) OVER w AS stays FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def q73_converge(t):
    """Rows of one key converge onto the one created first."""
    pages = t("orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_time"), F.lpad("o_orderkey", 12, "0").alias("id"))
    out = documents.converge(pages, ["o_custkey"])
    plain = lambda c: F.concat(F.lit("P"), F.col(c).cast("long")).alias(c)
    return out.select(plain("id"), plain("keep"), "stays")


@query("""WITH p AS (SELECT o_custkey AS code, year(o_orderdate) AS y, CASE o_orderkey % 3 WHEN 0 THEN '中間' WHEN 1 THEN '2Q' ELSE '3Q' END AS kind, CASE WHEN o_orderkey % 2 = 0 THEN '連結' END AS scope, o_orderkey AS id FROM orders),
    r AS (SELECT DISTINCT o_custkey AS code, year(o_orderdate) AS y FROM orders)
    SELECT r.code, r.y, (SELECT arg_min(id, ((scope IS DISTINCT FROM '連結')::INT, (kind <> '中間')::INT, id)) FROM p WHERE p.code = r.code AND p.y = r.y AND kind IN ('中間', '2Q')) AS page FROM r""")
def q74_write_targets(t):
    """Which stored row a record is written to: the exact key's, then the earlier name's, then one without a scope."""
    pages = t("orders").select(F.col("o_custkey").alias("code"), F.year("o_orderdate").alias("fiscal_period_end"), F.when(F.col("o_orderkey") % 3 == 0, "中間").when(F.col("o_orderkey") % 3 == 1, "2Q").otherwise("3Q").alias("disclosure_type"), F.when(F.col("o_orderkey") % 2 == 0, "連結").otherwise("").alias("consolidated"), F.lpad("o_orderkey", 12, "0").alias("created_time"), F.lpad("o_orderkey", 12, "0").alias("id"))
    records = pages.select("code", "fiscal_period_end").distinct().withColumns({"disclosure_type": F.lit("中間"), "consolidated": F.lit("連結")})
    return documents.write_targets(records, pages).select("code", F.col("fiscal_period_end").cast("long").alias("y"), F.col("page").cast("long").alias("page"))


@query("""SELECT o_orderkey, NOT coalesce(CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END > CASE WHEN o_orderkey % 5 > 0 THEN TIMESTAMP '1998-01-01' END, false) AS allowed FROM orders""")
def q75_may_overwrite(t):
    stored, incoming = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderdate")), F.when(F.col("o_orderkey") % 5 > 0, F.lit("1998-01-01").cast("timestamp_ntz"))
    return t("orders").select("o_orderkey", documents.may_overwrite(stored, incoming).alias("allowed"))


@query("""SELECT o_orderkey AS doc_id FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 5 = 1 OR o_orderkey % 11 = 3""")
def q76_disclosure_writes(t):
    """Disclosures worth a write: new ones and those that differ; another offset, an empty text for none and a clipped title don't."""
    k = F.col("o_orderkey")
    none = lambda kind: F.lit(None).cast(kind)
    base = t("orders").select(k.alias("doc_id"), F.repeat(F.lit("x"), 2500).alias("title"), F.lit("2024-05-01T09:00:00+09:00").alias("disclosed_at"), F.col("o_orderstatus").alias("doc_type"), F.lit(True).alias("has_xbrl"), none("string").alias("code"), none("string").alias("source_url"), none("string").alias("split_ratio"), none("double").alias("split_factor"), none("date").alias("effective_date"))
    stored = base.filter("doc_id % 7 > 0").withColumns({"title": F.concat(F.repeat(F.lit("x"), 1990), F.lit("…(省略)")), "code": F.lit(""), "disclosed_at": F.when(F.col("doc_id") % 5 == 1, "2024-05-01T09:00:00Z").otherwise("2024-05-01T00:00:00Z"), "split_factor": F.when(F.col("doc_id") % 11 == 3, 2.0)})
    return documents.disclosures_to_write(stored, base).select("doc_id")


@query("""SELECT 'rows' AS part, n_nationkey AS k, n_regionkey AS v FROM nation WHERE n_nationkey < 20 UNION ALL SELECT 'rows', n_nationkey, n_regionkey + 10 FROM nation WHERE n_nationkey >= 20 UNION ALL SELECT 'differ', n_nationkey, 0 FROM nation WHERE n_nationkey >= 15 AND n_nationkey < 20 OR n_nationkey < 15 AND n_nationkey % 2 = 0 OR n_nationkey >= 20""")
def q77_seed(t):
    """Declared rows written where missing or different; others stay and are only told."""
    nation = t("nation").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("v"))
    stored = nation.filter("k < 15 or k >= 20").withColumn("v", F.when((F.col("k") % 2 == 0) | (F.col("k") >= 20), F.col("v") + 10).otherwise(F.col("v")))
    rows, differ = store.seed(stored, nation.filter("k < 20"), ["k"], "v", prune=False)
    return rows.select(F.lit("rows").alias("part"), "k", "v").unionByName(differ.select(F.lit("differ").alias("part"), "k", F.lit(0).alias("v")))


@query("""SELECT 'customer' AS "table", operation, count(*) AS rows FROM (SELECT CASE WHEN c_nationkey < 5 THEN 'insert' WHEN c_nationkey < 10 THEN 'delete' WHEN c_acctbal > 5000 THEN 'update' ELSE 'keep' END AS operation FROM customer) GROUP BY operation""")
def q78_plan(t):
    """What a write would do, without doing it."""
    rows = t("customer").select("c_custkey", "c_acctbal", "c_nationkey")
    old = rows.filter("c_nationkey >= 5").select("c_custkey", "c_acctbal")
    new = rows.filter("not (c_nationkey between 5 and 9)").select("c_custkey", F.when(F.col("c_acctbal") > 5000, -1.0).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    return store.plan("customer", old, new, ["c_custkey"])


@query("SELECT doc_id FROM documents WHERE doc_id % 2 = 0 AND doc_id % 3 > 0 AND source IS NOT NULL")
def q79_exportable(t):
    content = F.concat(F.unhex(F.lit("504B0304")), F.encode(F.coalesce("text", F.lit("")), "utf-8"))
    files = t("documents").select("doc_id", F.when(F.col("source").isNotNull(), F.lit("https://x.invalid")).alias("url"), content.alias("content"), F.when(F.col("doc_id") % 3 > 0, F.sha2(content, 256)).otherwise("x").alias("sha256"), F.when(F.col("doc_id") % 2 == 0, "commercial-ok").otherwise("factual-cite").alias("license_tag"))
    return store.exportable(files).select("doc_id")


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(epoch(o_orderdate) AS BIGINT) AS at, 'EDINET' AS source, '正常' AS quality FROM orders""")
def q80_stored_form(t):
    """Provenance as columns of its own, dates as text and times as epochs."""
    day = F.to_date("o_orderdate")
    provenance = F.struct(F.lit("EDINET").alias("source"), F.lit("commercial-ok").alias("license_tag"), day.alias("data_date"), F.col("o_orderdate").cast("timestamp").alias("fetched_at"), F.lit("正常").alias("quality"))
    rows = keyed.stored_form(keyed.with_provenance(t("orders").select("o_orderkey", day.alias("day"), provenance.alias("provenance"))))
    return rows.select("o_orderkey", "day", F.col("fetched_at").alias("at"), "source", "quality")


@query("""SELECT o_orderkey, CASE WHEN c_nationkey < 20 THEN c_name END AS name FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def q81_look_up(t):
    """Few keys looked up for many rows; a miss is null."""
    rows = t("orders").select("o_orderkey", F.col("o_custkey").alias("code"))
    return keyed.look_up(rows, "code", t("customer").filter("c_nationkey < 20"), "c_custkey", "c_name", "name").select("o_orderkey", "name")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def q82_lineage(t):
    rows = t("lineitem").select(F.col("l_orderkey").alias("sha256"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")
    return keyed.lineage(rows, t("orders").select(F.col("o_orderkey").alias("sha256"), "o_totalprice"), "sha256").withColumnsRenamed({"sha256": "l_orderkey", "raw_o_totalprice": "o_totalprice"})


@query("""SELECT n_name AS name, 'declared' AS side FROM nation WHERE n_nationkey < 3 UNION ALL SELECT n_name, 'observed' FROM nation WHERE n_nationkey > 20""")
def q83_same_sets(t):
    names = t("nation").select(F.col("n_name").alias("name"), "n_nationkey")
    return keyed.same_sets(names.filter("n_nationkey <= 20").select("name"), names.filter("n_nationkey >= 3").select("name"))


@query("""SELECT doc_id, lang, CAST(NULL AS VARCHAR) AS url FROM documents WHERE lang = 'en' UNION ALL SELECT page_id, NULL, url FROM pages""")
def q84_concat(t):
    """Tables with different columns, one below the other."""
    return t("documents").filter("lang = 'en'").select("doc_id", "lang").unionByName(t("pages").select(F.col("page_id").alias("doc_id"), "url"), allowMissingColumns=True)


@query("""SELECT c_mktsegment AS segment, count(DISTINCT c_nationkey) AS codes FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 1) GROUP BY 1""")
def q85_among(t):
    """Rows whose key is in a table of keys, however many, and how many distinct keys they have."""
    rows = serving.among(t("customer"), "c_nationkey", t("nation").filter("n_regionkey <> 1").select("n_nationkey"))
    return rows.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count_distinct("c_nationkey").alias("codes"))


def _served(t):
    return t("lineitem").select(F.col("l_orderkey").cast("string").alias("doc_id"), F.concat_ws(":", "l_returnflag", F.concat("l_linestatus", F.when(F.col("l_linestatus") == "F", "TextBlock").otherwise(""))).alias("element"), F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity").alias("context_ref"), F.col("l_shipdate").cast("string").alias("value"), (F.col("l_linestatus") == "F").alias("is_text_block"))


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, l_returnflag || ':' || l_linestatus || 'TextBlock' AS element FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'A' AND CAST(l_shipdate AS VARCHAR) LIKE '%1997%' ORDER BY CAST(l_orderkey AS VARCHAR), 2, concat_ws('-', l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) LIMIT 100""")
def q86_fact_search(t):
    """Blocks of text of one kind of element that contain the words."""
    return serving.search_facts(serving.facts(_served(t), element="A:_T", text_only=True, limit=None), "1997").select("doc_id", "element")


@query("""SELECT l_returnflag || ':' || l_linestatus || CASE WHEN l_linestatus = 'F' THEN 'TextBlock' ELSE '' END AS element, l_returnflag AS namespace, count(DISTINCT l_orderkey) AS doc_count, l_linestatus = 'F' AS is_text_block FROM lineitem WHERE l_returnflag IN ('A') GROUP BY l_returnflag, l_linestatus""")
def q87_elements(t):
    return serving.elements(serving.element_vocabulary(_served(t)), "A:")


@query("""SELECT c_custkey AS code, c_mktsegment AS disclosure_type, c_acctbal AS roe_pct FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal DESC, c_custkey LIMIT 100""")
def q88_most_profitable(t):
    rows = t("customer").select(F.col("c_custkey").alias("code"), F.when(F.col("c_mktsegment") == "BUILDING", "本決算").otherwise("1Q").alias("disclosure_type"), F.col("c_acctbal").alias("roe_pct"))
    return serving.most_profitable(rows).withColumn("disclosure_type", F.lit("BUILDING"))


@query("""SELECT strftime(o_orderdate + INTERVAL 9 HOUR, '%Y-%m-%d') AS day, o_orderpriority AS doc_type, count(*) AS documents FROM orders GROUP BY 1, 2""")
def q89_calendar(t):
    rows = t("orders").select(F.col("o_orderdate").cast("timestamp").alias("disclosed_at"), F.col("o_orderpriority").alias("doc_type"))
    return serving.calendar(rows).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("""SELECT c_mktsegment AS sector33, count(*) AS companies, count(*) FILTER (c_acctbal > 0) AS listed FROM customer GROUP BY 1""")
def q90_by_sector(t):
    return serving.by_sector(t("customer").select(F.col("c_mktsegment").alias("sector33"), (F.col("c_acctbal") > 0).alias("listed")))


@query("""SELECT o_orderkey AS doc_id, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_custkey = 7 AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31' ORDER BY o_orderdate DESC, o_orderkey LIMIT 200""")
def q91_disclosures(t):
    rows = t("orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_custkey").alias("code"), F.col("o_orderpriority").alias("doc_type"), F.col("o_orderdate").alias("disclosed_at"))
    return serving.disclosures(rows, code=7, since="1996-01-01 00:00:00", until="1999-12-31 00:00:00").select("doc_id", F.date_format("disclosed_at", "yyyy-MM-dd").alias("day"))


@query("""SELECT l_suppkey AS genre_id, l_linenumber AS min_shares FROM lineitem JOIN (SELECT min(l_partkey) AS l_partkey FROM lineitem WHERE l_partkey > 40) USING (l_partkey) ORDER BY 1, 2 LIMIT 50""")
def q92_benefits(t):
    rows = t("lineitem").select(F.col("l_partkey").alias("stock_id"), F.col("l_suppkey").alias("genre_id"), F.col("l_linenumber").alias("min_shares"), F.lit("x").alias("description"), F.lit(3).alias("record_month"))
    master = t("lineitem").filter("l_partkey > 40").agg(F.min("l_partkey").alias("id")).withColumn("code", F.lit("own"))
    return serving.benefits(rows, master.unionByName(t("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("code"))), "own").select("genre_id", "min_shares")


@query("""WITH d AS (SELECT event_type, CAST(ts AS DATE) AS d, sum(CAST(value AS DECIMAL(18, 6)))::DOUBLE AS close, count(*) AS volume FROM events GROUP BY 1, 2)
    SELECT event_type, CAST(d AS VARCHAR) AS d, CASE WHEN count(*) OVER w5 = 5 THEN round(avg(close) OVER w5, 6) END AS sma5, CASE WHEN count(*) OVER w20 = 20 THEN round(avg(close) OVER w20 + 2 * stddev_pop(close) OVER w20, 6) END AS upper,
        CASE WHEN count(*) OVER w25 = 25 THEN round(volume / avg(volume) OVER w25, 6) END AS volume_ratio, round((close / lag(close) OVER w - 1) * 100, 6) AS change_pct FROM d
    WINDOW w AS (PARTITION BY event_type ORDER BY d), w5 AS (PARTITION BY event_type ORDER BY d ROWS 4 PRECEDING), w20 AS (PARTITION BY event_type ORDER BY d ROWS 19 PRECEDING), w25 AS (PARTITION BY event_type ORDER BY d ROWS 24 PRECEDING)""")
def q93_indicators(t):
    days = t("events").groupBy("event_type", F.to_date("ts").alias("d")).agg(F.sum(F.col("value").cast("decimal(18,6)")).cast("double").alias("close"), F.count(F.lit(1)).alias("volume"))
    out = indicators.moving(days, "event_type", "d")
    return out.select("event_type", F.date_format("d", "yyyy-MM-dd").alias("d"), *[F.round(c, 6).alias(n) for c, n in (("sma5", "sma5"), ("bb_upper", "upper"), ("volume_ratio", "volume_ratio"), ("change_pct", "change_pct"))])


@query("""WITH RECURSIVE d AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE)) AS k, CAST(ts AS DATE) AS d, sum(CAST(value AS DECIMAL(18, 6)))::DOUBLE AS c FROM events GROUP BY event_type, CAST(ts AS DATE)),
    e AS (SELECT event_type, k, d, c, c AS f, c AS s, 0::DOUBLE AS g FROM d WHERE k = 1 UNION ALL SELECT d.event_type, d.k, d.d, d.c, e.f + (d.c - e.f) * 2 / 13, e.s + (d.c - e.s) * 2 / 27, e.g + ((e.f + (d.c - e.f) * 2 / 13) - (e.s + (d.c - e.s) * 2 / 27) - e.g) * 2 / 10 FROM e JOIN d ON d.event_type = e.event_type AND d.k = e.k + 1)
    SELECT event_type, CAST(d AS VARCHAR) AS d, round(f - s, 6) AS macd, round(g, 6) AS macd_signal FROM e""")
def q94_smoothed(t):
    days = t("events").groupBy("event_type", F.to_date("ts").alias("d")).agg(F.sum(F.col("value").cast("decimal(18,6)")).cast("double").alias("close"))
    return indicators.smoothed(days, "event_type", "d").select("event_type", F.date_format("d", "yyyy-MM-dd").alias("d"), F.round("macd", 6).alias("macd"), F.round("macd_signal", 6).alias("macd_signal"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, '' AS unit, CASE WHEN l_tax > 0 THEN CAST(l_linenumber AS VARCHAR) ELSE '' END AS value FROM lineitem""")
def q95_tidy_table(t):
    """Tidy facts in their fixed columns, all text, unknown as empty."""
    rows = t("lineitem").select(*[F.lit(None).cast("string").alias(c) for c in TIDY if c not in ("code", "doc_id", "element", "value", "context_ref")], F.col("l_orderkey").alias("doc_id"), F.col("l_partkey").alias("code"), F.col("l_suppkey").alias("element"), F.col("l_extendedprice").alias("context_ref"), F.when(F.col("l_tax") > 0, F.col("l_linenumber")).alias("value"), F.lit(1).alias("more"), F.col("l_linenumber").alias("n"))
    out = tidy_table(rows.withColumn("period_start", F.col("n")))
    return out.select(F.col("doc_id").cast("long").alias("l_orderkey"), F.col("period_start").cast("int").alias("l_linenumber"), F.col("code").cast("long").alias("l_partkey"), F.col("element").cast("long").alias("l_suppkey"), F.col("context_ref").cast("double").alias("l_extendedprice"), "unit", "value")


@query("""SELECT CAST(c_custkey AS BIGINT) AS code, c_acctbal > 0 AS listed FROM customer WHERE c_acctbal > 0 ORDER BY c_custkey LIMIT 30 OFFSET 20""")
def q111_stocks(t):
    return serving.stocks(t("customer").select(F.col("c_custkey").alias("code"), (F.col("c_acctbal") > 0).alias("listed")), listed=True, limit=30, offset=20)


@query("""SELECT l_suppkey AS code, strftime(l_shipdate, '%Y-%m-%d') AS data_date, l_orderkey FROM lineitem WHERE l_suppkey = 3 AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'""")
def q112_prices(t):
    rows = t("lineitem").select(F.col("l_suppkey").alias("code"), F.col("l_shipdate").alias("data_date"), "l_orderkey")
    return serving.prices(rows, 3, "1996-01-01 00:00:00", "1997-12-31 00:00:00", 1_000_000).withColumn("data_date", F.date_format("data_date", "yyyy-MM-dd"))


@query("""SELECT o_orderkey AS consolidated, o_orderpriority AS disclosure_type FROM orders WHERE o_custkey = 11 AND o_orderpriority = '1-URGENT' ORDER BY o_orderdate DESC, o_orderkey LIMIT 100""")
def q113_financials(t):
    rows = t("orders").select(F.col("o_custkey").alias("code"), F.col("o_orderdate").alias("fiscal_period_end"), F.col("o_orderpriority").alias("disclosure_type"), F.col("o_orderkey").alias("consolidated"))
    return serving.financials(rows, 11, "1-URGENT").select("consolidated", "disclosure_type")


@query("""SELECT o_orderkey AS sha256 FROM orders WHERE o_orderpriority = '5-LOW' ORDER BY o_orderdate DESC, o_orderkey LIMIT 200""")
def q114_raw_index(t):
    return serving.raw_index(t("orders").select(F.col("o_orderkey").alias("sha256"), F.col("o_orderpriority").alias("scope"), F.col("o_orderdate").alias("fetched_at")), "5-LOW").select("sha256")


@query("""SELECT event_id FROM events WHERE event_type = 'click' ORDER BY ts DESC, event_id LIMIT 50""")
def q115_jobs(t):
    rows = t("events").select("event_id", F.col("event_type").alias("job_name"), F.col("ts").alias("finished_at"))
    return serving.jobs(rows, "click", serving.limit_of("50")).select("event_id")


@query("""SELECT s_suppkey AS code, 'jsf_zandaka' AS data_type FROM supplier WHERE s_suppkey % 2 = 0 ORDER BY s_suppkey LIMIT 500""")
def q116_supply_latest(t):
    rows = t("supplier").select(F.col("s_suppkey").alias("code"), F.when(F.col("s_suppkey") % 2 == 0, "jsf_zandaka").otherwise("jsf_shina").alias("data_type"))
    return serving.supply_latest(rows, "jsf_zandaka", serving.limit_of("9999"))


@query("""SELECT event_id, event_type AS data_type FROM events WHERE user_id = 3 AND event_type = 'view' AND CAST(CAST(ts AS DATE) AS VARCHAR) BETWEEN '2024-01-05' AND '2024-01-20'""")
def q117_series_between(t):
    points = t("events").select("event_id", F.col("user_id").cast("string").alias("code"), F.col("event_type").alias("data_type"), F.date_format("ts", "yyyy-MM-dd").alias("d"))
    return supply.series_between(points, "3", "view", "2024-01-05", "2024-01-20").select("event_id", "data_type")


@query("""SELECT DISTINCT lang AS dataset FROM documents WHERE lang IS NOT NULL AND lang <> 'de'""")
def q118_public_freshness(t):
    rows = t("documents").filter("lang is not null").select(F.col("lang").alias("dataset")).distinct()
    return serving.public_freshness(rows.withColumn("license_tag", F.when(F.col("dataset") == "de", "personal-only").when(F.col("dataset") == "en", "commercial-ok"))).select("dataset")


@query("""SELECT doc_id FROM documents WHERE text IS NOT NULL AND sha256(text) = (SELECT max(sha256(text)) FROM documents WHERE doc_id % 2 = 0) AND doc_id % 2 = 0""")
def q119_raw_file(t):
    rows = t("documents").filter("text is not null").select("doc_id", F.sha2("text", 256).alias("sha256"), F.when(F.col("doc_id") % 2 == 0, "commercial-ok").otherwise("factual-cite").alias("license_tag"))
    last = rows.filter("license_tag = 'commercial-ok'").agg(F.max("sha256")).scalar()
    return serving.raw_file(rows, last).select("doc_id")


@query("""SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def q120_work_list(t):
    return serving.head(t("orders"), [F.desc("o_totalprice"), "o_orderkey"], 25).select("o_orderkey")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'json' WHEN 1 THEN 'empty' WHEN 2 THEN 'not a zip' END AS problem, c_custkey % 2 = 0 AS is_csv FROM customer""")
def q121_bodies(t):
    """Bodies that aren't the document asked for, whatever the status said."""
    k = F.col("c_custkey")
    body = F.when(k % 4 == 1, F.lit(b"")).when(k % 4 == 2, F.encode(F.lit("<html>"), "utf-8")).otherwise(F.unhex(F.lit("504B0304FF")))
    kind = F.when(k % 4 == 0, "application/JSON; charset=utf-8").when(k % 4 == 3, "application/zip")
    csv = F.encode(F.when(k % 2 == 0, F.rpad(F.lit("a,b"), 100, "x")).otherwise(F.rpad(F.lit("a"), 300, "x")), "utf-8")
    return t("customer").select("c_custkey", body_problem(body, kind, "zip").alias("problem"), looks_like(csv, "csv").alias("is_csv"))


@query("""SELECT sha256(coalesce(text, '')) AS sha256, min(CASE WHEN lang = 'en' THEN doc_id END) AS first_fetched_at FROM documents GROUP BY 1""")
def q122_raw_index_merge(t):
    """The index of raw objects: digests seen again keep the time at which they were first fetched."""
    rows = t("documents").select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"), "lang", "doc_id")
    index = rows.filter("lang = 'en'").groupBy("sha256").agg(F.min("doc_id").alias("first_fetched_at"))
    return store.index_raw(index, rows.select("sha256").withColumn("first_fetched_at", F.lit(None).cast("long")))


@query("""SELECT event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'""")
def q123_trusted_map(t):
    return store.trusted_map(t("events").select("event_id", F.to_date("ts").alias("event_date")), F.lit("2024-01-10").cast("date")).select("event_id")


@query("""SELECT CAST(n_nationkey + 1 AS INT) AS page, '2024-05-01' AS day FROM nation WHERE n_regionkey <> 2 AND n_nationkey < 20""")
def q124_page_numbers(t):
    """The pages that a day's pages link to, up to a bound; other days' links don't count."""
    link = F.concat(F.lit("<a onclick=\"pagerLink('I_list_"), F.lpad((F.col("n_nationkey") + 1).cast("string"), 3, "0"), F.when(F.col("n_regionkey") == 2, "_20240502").otherwise("_20240501"), F.lit(".html')\">"))
    pages = t("nation").groupBy("n_regionkey").agg(F.array_join(F.collect_list(link), "").alias("html")).withColumn("day", F.lit("2024-05-01").cast("date"))
    return disclosures.page_numbers(pages, 20).select("page", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("""SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment LIKE 'B_ILD%' ORDER BY c_custkey LIMIT 40""")
def q125_like_prefix(t):
    return serving.page(serving.like_prefix(t("customer"), "c_mktsegment", "B_ILD").select("c_custkey", "c_mktsegment"), ["c_custkey"], 40)
