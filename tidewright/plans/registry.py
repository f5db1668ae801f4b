"""The registered queries: each applies an operator to the synthetic tables, beside SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewright.functions import codes, titles, values
from tidewright.operators import keyed, quality, serving
from tidewright.plans import atrest, governance, records, stores
from tidewright.plans.base import Registry
from tidewright.sources import tidy

_OWN = Registry()
query = _OWN.query

@query("""SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1998-12-31'
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 500""")
def q01_date_range_topk(t):
    rows = serving.where_between(serving.where_equal(t("orders"), o_orderstatus="F"), "o_orderdate", "1996-01-01 00:00:00", "1998-12-31 00:00:00")
    return serving.page(rows.select("o_orderkey", "o_orderdate", "o_totalprice"), [F.desc("o_orderdate"), "o_orderkey"], 500)


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 50 OFFSET 100")
def q02_paging(t):
    return serving.page(t("customer").select("c_custkey", "c_name"), ["c_custkey"], serving.limit_of("50"), 100)


@query("SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'hot ') OR p_name LIKE 'r_d%'")
def q03_prefix_range(t):
    name = F.col("p_name")
    return t("part").filter(name.startswith("hot ") | name.like("r_d%")).select("p_partkey", "p_name")


@query("SELECT doc_id, lang FROM documents WHERE text ILIKE '%the%' ORDER BY doc_id LIMIT 200")
def q04_text_search(t):
    return serving.page(t("documents").filter(F.col("text").ilike("%the%")).select("doc_id", "lang"), ["doc_id"], 200)


@query("""SELECT 'customer' AS child, count(*) AS orphans FROM customer WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)
    UNION ALL SELECT 'supplier', count(*) FROM supplier WHERE s_nationkey IS NOT NULL AND s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)
    UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    UNION ALL SELECT 'labels', count(*) FROM labels WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')""")
def q05_orphans(t):
    nation, rich = t("nation").filter("n_regionkey < 3"), t("customer").filter("c_acctbal > 0")
    parts = [keyed.orphans(t("customer"), nation, "c_nationkey", "n_nationkey", "customer"), keyed.orphans(t("supplier"), nation, "s_nationkey", "n_nationkey", "supplier"), keyed.orphans(t("orders"), rich, "o_custkey", "c_custkey", "orders"), keyed.orphans(t("labels"), t("documents").filter("lang = 'en'"), "doc_id", "doc_id", "labels")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_LINE = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(f"""SELECT l_orderkey, l_linenumber, {', '.join(_LINE)} FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in _LINE)}) AS rn FROM lineitem) WHERE rn = 1""")
def q06_last_wins(t):
    return keyed.pick_last(t("lineitem").select("l_orderkey", "l_linenumber", *_LINE), ["l_orderkey", "l_linenumber"], [F.col(c) for c in _LINE])


@query("""SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM (
    SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_partkey ORDER BY (s_nationkey <> 7)::INT, l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_extendedprice) AS rn
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) WHERE rn = 1""")
def q07_primary_pick(t):
    rows = t("lineitem").join(t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    order = [(F.col("s_nationkey") != 7).cast("int"), *[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice")]]
    return keyed.least_of_each(rows.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "s_nationkey", "l_shipdate", "l_extendedprice"), ["l_partkey"], order).select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")


_RANKED = "CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice"


@query(f"""SELECT o_orderkey, o_orderpriority, arg_min(l_quantity, k) AS quantity, arg_min(l_extendedprice, k) FILTER (l_discount > 0.05) AS discounted_price, arg_min(l_tax, k) FILTER (l_tax > 0) AS tax
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_RANKED}) AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY o_orderkey, o_orderpriority""")
def q08_priority_pivot(t):
    """One pass over the lines of an order: each measure is the first acceptable line's by flag, status and order."""
    order = F.struct(F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2), F.when(F.col("l_linestatus") == "F", 0).otherwise(1), "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min_by("l_quantity", order).alias("quantity"), F.min_by("l_extendedprice", F.when(F.col("l_discount") > 0.05, order)).alias("discounted_price"), F.min_by("l_tax", F.when(F.col("l_tax") > 0, order)).alias("tax")
    )
    return lines.join(t("orders").select("o_orderkey", "o_orderpriority"), "o_orderkey")


@query("""WITH n AS (SELECT o_custkey AS c_custkey, CASE WHEN count(*) > 12 THEN max(o_totalprice) END AS c_acctbal, max(o_orderpriority) AS c_mktsegment FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
    o AS (SELECT c_custkey, c_acctbal, c_mktsegment, c_name FROM customer WHERE c_mktsegment <> 'MACHINERY')
    SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal, CASE WHEN n.c_custkey IS NULL THEN o.c_mktsegment ELSE n.c_mktsegment END AS c_mktsegment, o.c_name
    FROM o FULL JOIN n ON o.c_custkey = n.c_custkey""")
def q09_merge_upsert(t):
    new = t("orders").filter("o_orderstatus <> 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.when(F.count(F.lit(1)) > 12, F.max("o_totalprice")).alias("c_acctbal"), F.max("o_orderpriority").alias("c_mktsegment"))
    old = t("customer").filter("c_mktsegment <> 'MACHINERY'").select("c_custkey", "c_acctbal", "c_mktsegment", "c_name")
    return keyed.merge_upsert(old, new, ["c_custkey"], {"c_acctbal": keyed.MERGE, "c_name": keyed.PRESERVE})


@query("""WITH h AS (SELECT user_id, event_type, max(ts) FILTER (event_id % 2 = 0) AS old_ts, arg_max(value, (ts, event_id)) FILTER (event_id % 2 = 0) AS old_value,
        max(ts) FILTER (event_id % 2 = 1) AS new_ts, arg_max(value, (ts, event_id)) FILTER (event_id % 2 = 1) AS new_value FROM events GROUP BY 1, 2)
    SELECT user_id, event_type, CASE WHEN new_ts IS NULL OR new_ts < old_ts THEN old_ts ELSE new_ts END AS ts, CASE WHEN new_ts IS NULL OR new_ts < old_ts THEN old_value ELSE new_value END AS value FROM h""")
def q10_merge_guard(t):
    last = lambda k: keyed.fold_batch(t("events").filter(f"event_id % 2 = {k}").select("user_id", "event_type", "ts", "value", "event_id"), ["user_id", "event_type"], ["ts", "event_id"], []).drop("event_id")
    return keyed.merge_upsert(last(0), last(1), ["user_id", "event_type"], guard="ts")


_TAG = "CASE WHEN quality = 1 AND toxic = 0 THEN 'commercial-ok' WHEN quality = 1 THEN 'factual-cite' WHEN toxic = 1 THEN 'unlisted' ELSE 'personal-only' END"


@query(f"""SELECT source, max(r) AS strictest_rank, arg_max(tag, r) AS strictest, count(*) FILTER (tag = 'commercial-ok') AS publishable FROM (
    SELECT source, tag, CASE tag WHEN 'commercial-ok' THEN 0 WHEN 'factual-cite' THEN 1 WHEN 'personal-only' THEN 2 ELSE 3 END AS r FROM (SELECT source, {_TAG} AS tag FROM documents JOIN labels USING (doc_id))) GROUP BY source""")
def q11_licence_lattice(t):
    rows = t("documents").select("doc_id", "source").join(t("labels"), "doc_id").select("source", F.expr(_TAG).alias("tag")).withColumn("r", values.licence_rank(F.col("tag")))
    return rows.groupBy("source").agg(F.max("r").alias("strictest_rank"), values.strictest("tag").alias("strictest"), F.count_if(values.is_publishable(F.col("tag"))).alias("publishable"))


@query("""SELECT a.o_orderkey, a.o_orderstatus, b.o_orderstatus AS old_o_orderstatus FROM orders a JOIN (SELECT o_orderkey + 1 AS o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders) b
    ON a.o_orderkey = b.o_orderkey WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus""")
def q12_changed_rows(t):
    now = t("orders").select("o_orderkey", "o_orderstatus")
    return keyed.changed_rows(now.select((F.col("o_orderkey") + 1).alias("o_orderkey"), F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus")), now, ["o_orderkey"], ["o_orderstatus"])


@query("""WITH d AS (SELECT * FROM (VALUES (0, 0), (1, 4), (2, 2), (99, 1)) AS v(n_nationkey, n_regionkey))
    SELECT coalesce(d.n_nationkey, n.n_nationkey) AS n_nationkey, CASE WHEN n.n_nationkey IS NULL THEN 'missing' WHEN d.n_nationkey IS NULL THEN 'orphan' ELSE 'mismatched' END AS status
    FROM d FULL JOIN nation n ON d.n_nationkey = n.n_nationkey WHERE n.n_nationkey IS NULL OR d.n_nationkey IS NULL OR d.n_regionkey IS DISTINCT FROM n.n_regionkey""")
def q13_declared_diff(t):
    nation = t("nation")
    declared = nation.sparkSession.createDataFrame([(0, 0), (1, 4), (2, 2), (99, 1)], "n_nationkey int, n_regionkey int")
    return keyed.diff_declared(declared, nation, ["n_nationkey"], "n_regionkey")


@query("""WITH f AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
    SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM f) AND (SELECT avg((c_custkey IN (SELECT o_custkey FROM f))::INT) FROM customer) >= 0.5""")
def q14_delist_guard(t):
    fetched = t("orders").filter("o_orderdate >= TIMESTAMP_NTZ '1999-01-01 00:00:00'").select(F.col("o_custkey").alias("c_custkey"))
    return keyed.departed(t("customer"), fetched, "c_custkey")


@query("""SELECT s_suppkey, coalesce(n_name, 'unknown') AS nation, coalesce(r_name, n_name, '') AS place FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n ON s_nationkey = n_nationkey
    LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) r ON n_regionkey = r_regionkey""")
def q15_lookup_coalesce(t):
    nation, region = t("nation").filter("n_nationkey < 20"), t("region").filter("r_regionkey <> 2")
    rows = t("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return rows.select("s_suppkey", F.coalesce("n_name", F.lit("unknown")).alias("nation"), F.coalesce("r_name", "n_name", F.lit("")).alias("place"))


_DATED = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"), ("customer", None), ("documents", None))


@query(" UNION ALL ".join(f"SELECT '{n}' AS dataset, {f'strftime(max({c}), chr(37) || chr(89) || chr(45) || chr(37) || chr(109) || chr(45) || chr(37) || chr(100))' if c else 'NULL::VARCHAR'} AS latest, count(*) AS row_count, {f'(max({c}) IS NOT NULL)::INT' if c else '0'} AS has_date FROM {n}" for n, c in _DATED))
def q16_freshness(t):
    return quality.freshness({n: (t(n), c) for n, c in _DATED})


_WEEKEND = "len(list_filter(range(CAST(ts + INTERVAL 9 HOUR AS DATE) + 1, DATE '2024-02-01' + 1, INTERVAL 1 DAY), lambda d: isodow(d) >= 6))"


@query(f"""SELECT event_id, CASE WHEN age <= 30 THEN 'green' WHEN age <= 480 THEN 'yellow' ELSE 'red' END AS verdict, CAST(round(age * 3600) AS BIGINT) AS age_seconds FROM (
    SELECT event_id, greatest(0, date_diff('second', ts, TIMESTAMP '2024-02-01 12:00:00') / 3600.0 - 24 * {_WEEKEND}) AS age FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events))""")
def q17_slo_age(t):
    age = values.elapsed_business_hours(F.date_trunc("SECOND", F.col("ts").cast("timestamp")), F.lit("2024-02-01 12:00:00").cast("timestamp"))
    return t("events").select("event_id", age.alias("a")).select("event_id", values.judge(F.col("a"), F.lit(1), 30, 480).alias("verdict"), F.round(F.col("a") * 3600).cast("bigint").alias("age_seconds"))


@query("""SELECT user_id, count(*) AS idle FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type <> 'signup') WHERE rn <= 5 AND value < 50 GROUP BY user_id HAVING count(*) >= 3""")
def q18_idle_runs(t):
    return quality.idle_runs(t("events").filter("event_type <> 'signup'"), "user_id", [F.desc("ts"), F.desc("event_id")], F.col("value") < 50)


@query("""WITH p AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS d, event_type, arg_max(value, event_id) AS value, event_id % 2 AS b FROM events GROUP BY 1, 2, 4)
    SELECT d, event_type, value FROM p WHERE b = 1 UNION ALL SELECT d, event_type, value FROM p WHERE b = 0 AND (d, event_type) NOT IN (SELECT (d, event_type) FROM p WHERE b = 1 AND event_type <> 'view') AND event_type <> 'view'
    UNION ALL SELECT d, event_type, value FROM p WHERE b = 0 AND event_type = 'view' AND (d, event_type) NOT IN (SELECT (d, event_type) FROM p WHERE b = 1)""")
def q19_series_merge(t):
    def batch(k):
        return t("events").filter(f"event_id % 2 = {k}").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("d"), "event_type").agg(F.max_by("value", "event_id").alias("value"))

    return keyed.merge_series(batch(0), batch(1), ["d", "event_type"])


@query("""WITH o AS (SELECT event_type, user_id, CAST(ts AS DATE) AS d FROM events WHERE event_id % 4 > 0 GROUP BY ALL), n AS (SELECT event_type, user_id, CAST(ts AS DATE) AS d FROM events WHERE event_id % 4 <> 1 GROUP BY ALL)
    SELECT event_type, (SELECT count(*) FROM o WHERE o.event_type = x.event_type) AS old_size, (SELECT count(*) FROM n WHERE n.event_type = x.event_type) AS new_size, count(*) AS lost
    FROM (SELECT * FROM o EXCEPT SELECT * FROM n) x GROUP BY event_type""")
def q20_no_regression(t):
    rows = t("events").select("event_type", "user_id", F.to_date("ts").alias("d"), "event_id")
    old, new = (rows.filter(f"event_id % 4 {x}").drop("event_id").distinct() for x in ("> 0", "<> 1"))
    return keyed.regressions(old, new, ["event_type"], ["user_id", "d"]).filter("lost > 0")


_CODE = "CASE c_custkey % 4 WHEN 0 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0') WHEN 1 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0') || '0' WHEN 2 THEN '  ' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || 'a ' ELSE lpad(CAST(c_custkey AS VARCHAR), 4, '0') || '5' END"


@query(f"""SELECT c_custkey, c AS code, CASE WHEN regexp_full_match(c, '[0-9]{{3}}[0-9A-Z]') THEN c END AS parsed, CASE WHEN regexp_full_match(c, '[0-9]{{3}}[0-9A-Z]0?') THEN c[1:4] END AS ticker,
    CASE WHEN regexp_full_match(c, '[0-9]{{3}}[0-9A-Z]0?') THEN c[1:4] WHEN regexp_full_match(c, '[0-9]{{3}}[0-9A-Z][1-9]') THEN c END AS margin_key FROM (SELECT c_custkey, upper(trim({_CODE})) AS c FROM customer)""")
def q21_stock_code(t):
    raw = F.expr(_CODE.replace("VARCHAR", "STRING"))
    return t("customer").select("c_custkey", codes.normalize_stock_code(raw).alias("code"), codes.parse_stock_code(raw).alias("parsed"), codes.source_code_to_ticker(raw).alias("ticker"), codes.margin_code_to_key(raw).alias("margin_key"))


_TITLE = "CASE doc_id % 11 WHEN 0 THEN '2024年3月期 決算短信' WHEN 1 THEN '株式分割に関するお知らせ' WHEN 2 THEN '業績予想の修正に関するお知らせ' WHEN 3 THEN '配当予想の修正' WHEN 4 THEN '自己株式の取得' WHEN 5 THEN '上場廃止のお知らせ' WHEN 6 THEN '上場廃止に関する猶予期間' WHEN 7 THEN '株式併合（５株を１株）の訂正' WHEN 8 THEN '株主優待制度' WHEN 9 THEN '大量保有報告書' ELSE lang END"


@query("""SELECT doc_id, CASE doc_id % 11 WHEN 0 THEN '短信' WHEN 1 THEN '株式分割' WHEN 2 THEN '業績修正' WHEN 3 THEN '配当修正' WHEN 4 THEN '自社株買い' WHEN 5 THEN '上場廃止' WHEN 7 THEN '株式併合' WHEN 8 THEN '優待' WHEN 9 THEN '大量保有' ELSE 'その他' END AS label,
    CASE WHEN doc_id % 11 = 7 THEN 0.2 END AS factor FROM documents""")
def q22_classify_priority(t):
    title = F.expr(_TITLE)
    return t("documents").select("doc_id", titles.classify_title(title).alias("label"), titles.split_terms(title)["factor"].alias("factor"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE l_linenumber % 5 WHEN 0 THEN -floor(l_extendedprice) WHEN 1 THEN floor(l_extendedprice) WHEN 2 THEN NULL WHEN 3 THEN -floor(l_quantity) ELSE NULL END AS parsed FROM lineitem""")
def q23_numeric_parse(t):
    text = F.expr("""CASE l_linenumber % 5 WHEN 0 THEN concat('△', format_number(floor(l_extendedprice), 0)) WHEN 1 THEN format_number(floor(l_extendedprice), 0) WHEN 2 THEN '－'
        WHEN 3 THEN concat('(', CAST(floor(l_quantity) AS STRING), ')') ELSE '(注1)' END""")
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", values.parse_numeric(text).alias("parsed"))


@query("""SELECT o_orderkey, CASE WHEN quarter(o_orderdate) = 4 THEN '本決算' WHEN quarter(o_orderdate) = 2 AND CAST(o_orderdate AS DATE) >= DATE '1996-06-30' THEN '中間' ELSE quarter(o_orderdate) || 'Q' END AS kind FROM orders""")
def q24_date_derive(t):
    day = F.to_date("o_orderdate")
    quarter = F.quarter(day)
    kind = values.interim_type(F.concat(quarter.cast("string"), F.lit("Q")), F.add_months(day, 336))
    return t("orders").select("o_orderkey", F.when(quarter == 4, "本決算").otherwise(kind).alias("kind"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def q25_json_flat(t):
    return t("events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query(r"""SELECT page_id, count(*) AS links, count(*) FILTER (h LIKE '/%') AS local FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]+)"', 1)) AS h FROM pages) GROUP BY page_id""")
def q26_html_links(t):
    links = t("pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]+)"'), 1)).alias("h"))
    return links.groupBy("page_id").agg(F.count(F.lit(1)).alias("links"), F.count_if(F.col("h").startswith("/")).alias("local"))


@query("SELECT user_id, len(list_filter(l, lambda x: x > 50)) AS high, l[1] AS first FROM (SELECT user_id, list(value ORDER BY ts, event_id) AS l FROM events GROUP BY user_id)")
def q27_array_filter(t):
    """What a filter over a user's series gives, as sums that combine before the shuffle: no series is gathered."""
    return t("events").groupBy("user_id").agg(F.count_if(F.col("value") > 50).alias("high"), F.min_by("value", F.struct("ts", "event_id")).alias("first"))


@query("""SELECT o_orderkey, kind, flag FROM (SELECT o_orderkey, unnest(['status', 'priority']) AS kind, unnest([o_orderstatus, o_orderpriority]) AS flag FROM orders) WHERE flag <> 'P'""")
def q28_unpivot_map(t):
    pairs = F.map_filter(F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority"), lambda k, v: v != "P")
    return t("orders").select("o_orderkey", F.explode(pairs).alias("kind", "flag"))


@query("""SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS licences, count(c_acctbal) FILTER (c_nationkey < 0) AS shown_balances, count(*) AS rows FROM customer GROUP BY c_nationkey""")
def q29_redact(t):
    rows = serving.redact(t("customer"), ["c_acctbal"])
    return rows.groupBy("c_nationkey").agg(F.concat_ws(",", F.sort_array(F.collect_set("c_mktsegment"))).alias("licences"), F.count("c_acctbal").alias("shown_balances"), F.count(F.lit(1)).alias("rows"))


@query("""WITH s AS (SELECT o_orderpriority AS s, min(o_orderkey) AS k FROM orders WHERE o_orderpriority <> '2-HIGH' GROUP BY 1)
    SELECT (SELECT string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) FROM orders WHERE o_orderstatus <> 'P') AS licences, (SELECT string_agg(s, ',' ORDER BY k) FROM s) AS sources, (SELECT count(*) FROM orders) AS rows""")
def q29_envelope(t):
    rows = t("orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("licence"), F.when(F.col("o_orderpriority") == "2-HIGH", "").otherwise(F.col("o_orderpriority")).alias("source"), "o_orderkey")
    return serving.envelope(rows, "licence", "source", "o_orderkey")


@query("SELECT sha256(text) AS sha256, min(doc_id) AS first_id, count(*) AS copies FROM documents GROUP BY 1")
def q30_sha_dedupe(t):
    return t("documents").groupBy(F.sha2("text", 256).alias("sha256")).agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))


@query("""SELECT user_id, CASE WHEN bool_or(value > 99.9) THEN '失敗' WHEN f > 0 AND p = 0 THEN '失敗' WHEN f > 0 THEN '一部失敗' ELSE '成功' END AS status
    FROM (SELECT *, count(*) FILTER (event_type = 'error') OVER w AS f, count(*) FILTER (event_type <> 'error') OVER w AS p FROM events WINDOW w AS (PARTITION BY user_id)) GROUP BY user_id, f, p""")
def q31_status_rollup(t):
    sums = t("events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("f"), F.count_if(F.col("event_type") != "error").alias("p"), F.bool_or(F.col("value") > 99.9).alias("c"))
    return sums.select("user_id", quality.run_status(F.col("f"), F.col("p"), F.col("c")).alias("status"))


@query("""SELECT o_orderkey, 'raw/src/' || regexp_replace(regexp_replace(lower(o_orderpriority), '[^A-Za-z0-9._-]+', '-', 'g'), '^-+|-+$', '', 'g') || '/' || year(o_orderdate) || '/' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '/' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') || '/_/'
    || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 16) || '.csv' AS key FROM orders""")
def q32_left_pad_keys(t):
    key = F.col("o_orderkey").cast("string")
    return t("orders").select("o_orderkey", codes.raw_key(F.lit("src"), F.col("o_orderpriority"), F.lpad(key, 8, "0"), F.col("o_orderdate"), F.sha2(key, 256), F.lit("csv")).alias("key"))


@query("""SELECT event_type, d, round(v, 2) AS v, round(avg(v) OVER w, 2) AS sma5, count(*) OVER w AS days FROM (SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS d, CAST(sum(CAST(value AS DECIMAL(18, 6))) AS DOUBLE) AS v FROM events GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY event_type ORDER BY d ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def q33_window_sma(t):
    days = t("events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("d")).agg(F.sum(F.col("value").cast("decimal(18,6)")).cast("double").alias("v"))
    w = Window.partitionBy("event_type").orderBy("d").rowsBetween(-4, 0)
    cents = lambda c: F.round(c * 100) / 100  # noqa: E731  rounds the double itself, not its shortest decimal form
    return days.select("event_type", "d", cents(F.col("v")).alias("v"), cents(F.avg("v").over(w)).alias("sma5"), F.count(F.lit(1)).over(w).alias("days"))


@query(r"SELECT doc_id, length(regexp_replace(text, '[ \t\n\r\f\v]+', '', 'g')) >= 200 AS meaningful FROM documents")
def q34_text_threshold(t):
    return t("documents").select("doc_id", values.meaningful_text(F.col("text"), 200).alias("meaningful"))


@query("SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS roles, count(*) AS turns FROM conversations GROUP BY conv_id")
def q35_nested_conv(t):
    """Turns are put together in pieces of 256 first, then the pieces in order."""
    piece = t("conversations").groupBy("conv_id", F.floor(F.col("turn") / 256).alias("piece")).agg(F.concat_ws(">", F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"])).alias("roles"), F.count(F.lit(1)).alias("n"))
    whole = F.concat_ws(">", F.transform(F.array_sort(F.collect_list(F.struct("piece", "roles"))), lambda x: x["roles"]))
    return piece.groupBy("conv_id").agg(whole.alias("roles"), F.sum("n").alias("turns"))


@query(r"""WITH p AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'), '(?s)<!--.*?-->', '', 'g') AS h FROM pages),
    a AS (SELECT page_id, unnest(regexp_extract_all(h, '(?s)<a [^>]*href="[^"]+"[^>]*>.*?</a>')) AS x, unnest(range(len(regexp_extract_all(h, '(?s)<a [^>]*href="[^"]+"[^>]*>.*?</a>')))) AS ord FROM p)
    SELECT page_id, ord, regexp_extract(x, 'href="([^"]+)"', 1) AS href, trim(regexp_replace(x, '<[^>]*>', '', 'g')) AS label FROM a""")
def q36_page_links(t):
    return tidy.links_of(t("pages"))


_ALL = (_OWN, records.QUERIES, stores.QUERIES, governance.QUERIES, atrest.QUERIES)


def queries():
    return {k: f for r in _ALL for k, f in r.queries.items()}


def oracle_sql():
    return {k: s for r in _ALL for k, s in r.sql.items()}
