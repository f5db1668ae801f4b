"""Freshness, liveness, guards, drift and licence coverage."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.functions.values import due_from, elapsed_hours, judge
from tidewright.operators.keyed import diff_declared

#: For each dataset the hours that are green and yellow, whether they count business days only, and the days after
#: its date on which data is due; and datasets that are observed but not refreshed any more.
THRESHOLDS = (
    ("d1_core_stock_financials", 30.0, 48.0, True, 0),
    ("tdnet_disclosures", 30.0, 48.0, True, 0),
    ("edinet_documents", 30.0, 48.0, True, 0),
    ("jsf_supply", 30.0, 48.0, True, 1),
    ("core_stocks", 960.0, 1080.0, False, 0),
    ("financials", 48.0, 168.0, True, 0),
)
NOT_REFRESHED = ("yutai_benefits",)
#: Jobs that collect nothing, the observing job, states of runs, and how much silence is accepted.
PROBE_JOB = "freshness_probe"
DIAGNOSTIC_JOBS = ("ops_check", "cloud_check", PROBE_JOB)
SUCCESS, PARTLY, FAILURE = "成功", "一部失敗", "失敗"
IDLE_DAYS, SILENCE_HOURS = 30, 48.0


def freshness(tables: dict[str, tuple]) -> DataFrame:
    """dataset, latest (of its own date column, as text), row_count, has_date: measured on the tables themselves. A table's entry
    is (table, date column or None) or also (…, filter, column of the time it was fetched), which add `fetched`."""
    parts = []
    for name, (df, column, *more) in tables.items():
        where, fetched = [*more, None, None][:2]
        df = df if where is None else df.filter(where)
        latest = F.max(column) if column else F.lit(None)
        aggs = [latest.alias("latest"), F.count(F.lit(1)).alias("row_count")] + ([F.max(fetched).alias("fetched")] if fetched else [F.lit(None).cast("long").alias("fetched")] * any(len(t) > 2 for t in tables.values()))
        text = F.date_format("latest", "yyyy-MM-dd") if column else F.lit(None).cast("string")
        out = df.agg(*aggs)
        parts.append(out.select(F.lit(name).alias("dataset"), text.alias("latest"), "row_count", F.col("latest").isNotNull().cast("int").alias("has_date"), *[c for c in out.columns if c == "fetched"]))
    return reduce(DataFrame.unionByName, parts)


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(THRESHOLDS), "dataset string, green double, yellow double, business_days boolean, lag_days int")


def declaration_conflicts(declared: DataFrame, accepted: DataFrame, exempt: DataFrame) -> DataFrame:
    """dataset and problem for declarations (dataset, reason) that contradict each other or the thresholds, or lack a reason."""
    said = lambda df, text: df.select("dataset", F.lit(text).alias("problem"))
    both = said(accepted.join(exempt, "dataset", "left_semi"), "accepted and exempt")
    judged = said(exempt.join(declared, "dataset", "left_semi"), "judged and exempt")
    unknown = said(accepted.join(declared, "dataset", "left_anti"), "accepted without a threshold")
    silent = said(accepted.unionByName(exempt).filter(F.coalesce(F.trim("reason"), F.lit("")) == ""), "no reason")
    return reduce(DataFrame.unionByName, [both, judged, unknown, silent])


def verdicts(observed: DataFrame, declared: DataFrame, exempt: DataFrame, now: Column) -> DataFrame:
    """observed (dataset, latest_data_date, updated_at, row_count) with age_hours and verdict. Age counts from the data's own date
    and its lag, only without one from the time of fetching; exempt datasets age by the calendar."""
    rows = observed.join(F.broadcast(declared), "dataset", "left").join(F.broadcast(exempt.select("dataset", F.lit(True).alias("exempt"))), "dataset", "left")
    day = F.try_to_date(F.substring("latest_data_date", 1, 10), "yyyy-MM-dd")
    rows = rows.withColumn("_start", due_from(day, F.coalesce("lag_days", F.lit(0)), F.col("updated_at")))
    age = F.when(F.col("green").isNotNull() | F.coalesce("exempt", F.lit(False)), elapsed_hours(F.col("_start"), now, F.coalesce("business_days", F.lit(False))))
    rows = rows.withColumn("age_hours", age)
    return rows.select("dataset", "latest_data_date", "updated_at", "row_count", "age_hours", judge(F.col("age_hours"), F.col("row_count"), F.col("green"), F.col("yellow"), F.col("exempt")).alias("verdict"), F.coalesce("exempt", F.lit(False)).alias("exempt"))


def freshness_report(judged: DataFrame, declared: DataFrame, accepted: DataFrame, exempt: DataFrame) -> DataFrame:
    """dataset, verdict, level: problem for red, yellow and unknown, warning for an accepted red or an acceptance that is no longer
    needed, info else; a dataset that is declared but not observed is a problem with the verdict missing."""
    rows = judged.join(F.broadcast(accepted.select("dataset", F.lit(True).alias("accepted"))), "dataset", "left")
    verdict, taken = F.col("verdict"), F.coalesce("accepted", F.lit(False))
    level = F.when(verdict == "not_refreshed", "info").when(F.col("exempt"), "problem").when(taken & (verdict != "unknown"), "warning").when(verdict == "green", "info").otherwise("problem")
    missing = declared.select("dataset").unionByName(exempt.select("dataset")).distinct().join(judged, "dataset", "left_anti")
    return rows.select("dataset", "verdict", level.alias("level")).unionByName(missing.select("dataset", F.lit("missing").alias("verdict"), F.lit("problem").alias("level")))


def silences(runs: DataFrame, now: Column, most_hours: float = SILENCE_HOURS) -> DataFrame:
    """job_name, last_ok (epoch of the job's last success), silent_hours and problem: never, silent or null. Failures don't count."""
    last = runs.groupBy("job_name").agg(F.max(F.when(F.col("status") == SUCCESS, F.col("finished_at"))).alias("last_ok"))
    hours = (F.unix_seconds(now) - F.col("last_ok")) / 3600.0
    return last.select("job_name", "last_ok", hours.alias("silent_hours"), F.when(F.coalesce("last_ok", F.lit(0)) == 0, "never").when(hours > most_hours, "silent").alias("problem"))


def probe_silence(runs: DataFrame, now: Column, job: str = PROBE_JOB, most_hours: float = SILENCE_HOURS) -> DataFrame:
    """One row: last_ok (epoch of the job's last success), silent_hours and problem: never, silent or null. Failures don't count."""
    last = runs.filter((F.col("job_name") == job) & (F.col("status") == SUCCESS)).agg(F.max("finished_at").alias("last_ok"))
    hours = (F.unix_seconds(now) - F.col("last_ok")) / 3600.0
    return last.select("last_ok", hours.alias("silent_hours"), F.when(F.coalesce("last_ok", F.lit(0)) == 0, "never").when(hours > most_hours, "silent").alias("problem"))


def idle_runs(runs: DataFrame, job: str, order: list, is_idle, last: int = 5, least: int = 3) -> DataFrame:
    """Jobs with at least `least` idle runs among their `last` newest."""
    rank = F.row_number().over(Window.partitionBy(job).orderBy(*order))
    return runs.withColumn("_rn", rank).filter(F.col("_rn") <= last).filter(is_idle).groupBy(job).agg(F.count(F.lit(1)).alias("idle")).filter(F.col("idle") >= least)


def idle_jobs(runs: DataFrame, now: Column) -> DataFrame:
    """Collecting jobs whose last five runs within 30 days hold three successes or more that processed nothing."""
    recent = runs.filter(~F.col("job_name").isin(*DIAGNOSTIC_JOBS) & (F.col("finished_at") >= F.unix_seconds(now) - IDLE_DAYS * 86400))
    return idle_runs(recent, "job_name", [F.desc("finished_at")], (F.col("processed") == 0) & (F.col("status") == SUCCESS))


def run_status(failed, processed, crashed):
    return F.when(crashed, FAILURE).when((failed > 0) & (processed == 0), FAILURE).when(failed > 0, PARTLY).otherwise(SUCCESS)


def empty_is_failure(rows: DataFrame, what: str) -> DataFrame:
    """One row: processed, failed, problem; a list without entries counts as one failure."""
    return rows.agg(F.count(F.lit(1)).alias("processed")).select("processed", (F.col("processed") == 0).cast("int").alias("failed"), F.when(F.col("processed") == 0, F.lit(f"{what} is empty")).alias("problem"))


def contract_breaks(rows: DataFrame, key: str, required: list[str], arrays: dict[str, list[str]] | None = None) -> DataFrame:
    """key, path, missing: the required keys that a payload (JSON text in `payload`) lacks at its top or in any element of an
    array, or the array itself; what isn't an object breaks the contract too."""
    payload = F.try_parse_json("payload")
    parts = []
    has = lambda v, path: F.try_variant_get(v, path, "variant").isNotNull()  # noqa: E731  a key whose value is null is there
    absent = F.array_compact(F.array(*[F.when(~F.coalesce(has(payload, f"$.{k}"), F.lit(False)), F.lit(k)) for k in required]))
    parts.append(rows.select(key, F.lit("$").alias("path"), F.explode(absent).alias("missing")))
    for name, keys in (arrays or {}).items():
        items = F.try_variant_get(payload, f"$.{name}", "array<variant>")
        parts.append(rows.filter(items.isNull()).select(key, F.lit(name).alias("path"), F.lit(name).alias("missing")))
        each = rows.select(key, F.explode(items).alias("_i"))
        lacking = F.array_compact(F.array(*[F.when(~F.coalesce(has(F.col("_i"), f"$.{k}"), F.lit(False)), F.lit(k)) for k in keys]))
        parts.append(each.select(key, F.explode(lacking).alias("missing")).distinct().select(key, F.lit(f"{name}[]").alias("path"), "missing"))
    return reduce(DataFrame.unionByName, parts)


def arrays_in(rows: DataFrame, key: str, paths: list[str] | None = None) -> DataFrame:
    """key, path, items (variants): the arrays of payloads (JSON text in `payload`) at the given dotted paths, or, without any given, all
    that stand in the payload or in objects within objects; a payload that is an array itself is at `$`. Arrays within arrays are part of
    their elements. Objects are opened level by level, as deep as any payload goes."""
    level = rows.select(F.col(key).alias("k"), F.lit("").alias("path"), F.try_parse_json("payload").alias("v")).filter("v IS NOT NULL")
    if paths is not None:
        found = [F.struct(F.lit(p).alias("path"), F.try_variant_get("v", f"$.{p}", "array<variant>").alias("items")) for p in paths]
        return level.select("k", F.explode(F.array(*found)).alias("a")).select(F.col("k").alias(key), "a.path", "a.items").filter("items IS NOT NULL")
    found = []
    while True:
        level = level.withColumn("kind", F.split_part(F.schema_of_variant("v"), F.lit("<"), F.lit(1))).persist(StorageLevel.MEMORY_AND_DISK)
        found.append(level.filter("kind = 'ARRAY'").select(F.col("k").alias(key), F.when(F.col("path") == "", "$").otherwise(F.col("path")).alias("path"), F.expr("try_variant_get(v, '$', 'array<variant>')").alias("items")))
        objects = level.filter("kind = 'OBJECT'")
        if objects.isEmpty():
            return reduce(DataFrame.unionByName, found)
        name = f"objects_{uuid.uuid4().hex}"
        objects.createOrReplaceTempView(name)
        level = rows.sparkSession.sql(f"SELECT o.k, CASE WHEN o.path = '' THEN e.key ELSE concat(o.path, '.', e.key) END AS path, e.value AS v FROM {name} o, LATERAL variant_explode(o.v) e")


def guard_problems(old: DataFrame, new: DataFrame, key: str, paths: list[str] | None, writer: str) -> DataFrame:
    """key, problem: why new payloads (key, payload) may not replace old ones: another writer, an array that is gone (even if it was
    empty), shorter or lacks an old element, or a later first_date. Arrays are found where no paths are given. A payload without an old
    one only needs the right writer. Elements are compared as JSON in a canonical order of keys."""
    at = lambda side, path: F.try_variant_get(F.try_parse_json(F.col(side)), f"$.{path}", "string")
    both = old.select(key, F.col("payload").alias("_old")).join(new.select(key, F.col("payload").alias("_new")), key, "right")
    later = at("_new", "first_date") > at("_old", "first_date")
    found = F.array_compact(F.array(
        F.when(~at("_new", "writer").eqNullSafe(F.lit(writer)), "another writer now"), F.when(at("_old", "writer").isNotNull() & (at("_old", "writer") != writer), "another writer before"), F.when(later, "first_date moved on"),
    ))
    heads = both.select(key, F.explode(found).alias("problem"))
    had, has = arrays_in(old.join(new.select(key), key, "left_semi"), key, paths), arrays_in(new, key, paths)
    side = lambda df, old: df.select(key, "path", F.lit(old).alias("old"), "items")
    arrays = side(had, True).unionByName(side(has, False))
    size = lambda old: F.max(F.when(F.col("old") == old, F.size("items")))
    sizes = arrays.groupBy(key, "path").agg(size(True).alias("before"), size(False).alias("now"))
    each = arrays.select(key, "path", "old", F.explode("items").alias("i")).groupBy(key, "path", F.to_json("i").alias("element")).agg(F.bool_or("old").alias("_had"), F.bool_or(~F.col("old")).alias("_has"))
    lost = each.filter("_had AND NOT _has").select(key, "path").distinct().withColumn("_lost", F.lit(True))
    told = F.when(F.col("now").isNull(), "gone").when(F.col("now") < F.col("before"), "shorter").when(F.col("_lost"), "elements lost")
    problems = sizes.filter("before IS NOT NULL").join(lost, [key, "path"], "left").select(key, F.concat(F.col("path"), F.lit(" "), told).alias("problem"))
    return heads.unionByName(problems.filter("problem IS NOT NULL"))


def guarded(old: DataFrame, new: DataFrame, key: str, paths: list[str] | None, writer: str) -> DataFrame:
    """What is stored after a guarded full replacement: new payloads in place of old ones, but not where the guard objects."""
    bad = guard_problems(old, new, key, paths, writer).select(key).distinct()
    passed = new.join(bad, key, "left_anti")
    return old.join(passed.select(key), key, "left_anti").unionByName(passed)


def schema_of(tables: dict[str, DataFrame]) -> DataFrame:
    """table, column, kind, nullable of tables as they stand: what their files' footers or the catalogue say, by no scan."""
    rows = [(name, f.name, f.dataType.simpleString(), f.nullable) for name, df in tables.items() for f in df.schema.fields]
    return next(iter(tables.values())).sparkSession.createDataFrame(rows, "table string, column string, kind string, nullable boolean")


def catalogue_schema(spark: SparkSession, database: str | None = None) -> DataFrame:
    """schema_of all tables of a database."""
    names = [x.name for x in spark.catalog.listTables(database) if not x.isTemporary]
    return schema_of({n: spark.table(f"{database}.{n}" if database else n) for n in names})


def schema_drift(observed: DataFrame, declared: DataFrame) -> DataFrame:
    """(table, column, kind, nullable) of both -> table, column, problem: missing, undeclared, another type or nullability."""
    d = declared.select("table", "column", F.upper("kind").alias("_dk"), F.col("nullable").alias("_dn"), F.lit(True).alias("_d"))
    o = observed.select("table", "column", F.upper("kind").alias("_ok"), F.col("nullable").alias("_on"), F.lit(True).alias("_o"))
    problem = F.when(F.col("_o").isNull(), "missing").when(F.col("_d").isNull(), "undeclared").when(~F.col("_dk").eqNullSafe(F.col("_ok")), "type").when(~F.col("_dn").eqNullSafe(F.col("_on")), "nullability")
    return d.join(o, ["table", "column"], "full_outer").select("table", "column", problem.alias("problem")).filter("problem is not null")


def licence_coverage(columns: DataFrame, tables: DataFrame, column_licences: DataFrame, row_tag: str = "license_tag") -> DataFrame:
    """columns (table, column) that exist, tables (table, kind) and column_licences (table, column) as declared -> table, column,
    level, problem. A table that is not declared warns, one that vanished fails; so does a row-tagged table without its tag and a
    declared column that is gone; a column of a mapped table without a licence warns."""
    live = columns.select("table").distinct()
    row = lambda df, column, level, problem: df.select("table", column.alias("column"), F.lit(level).alias("level"), F.lit(problem).alias("problem"))
    none, mapped = F.lit(None).cast("string"), tables.filter("kind = 'column-map'").join(live, "table", "left_semi").select("table")
    there = columns.select("table", "column")
    declared = column_licences.select("table", "column")
    parts = [
        row(live.join(tables, "table", "left_anti"), none, "warning", "table not declared"),
        row(tables.join(live, "table", "left_anti"), none, "failure", "table vanished"),
        row(tables.filter("kind = 'unclassified'").join(live, "table", "left_semi"), none, "warning", "table unclassified"),
        row(tables.filter("kind = 'row-tag'").join(live, "table", "left_semi").join(there.filter(F.col("column") == row_tag), "table", "left_anti"), none, "failure", "no row tag"),
        row(declared.join(mapped, "table", "left_semi").join(there, ["table", "column"], "left_anti"), F.col("column"), "failure", "column vanished"),
        row(there.join(mapped, "table", "left_semi").join(declared, ["table", "column"], "left_anti"), F.col("column"), "warning", "column without a licence"),
    ]
    return reduce(DataFrame.unionByName, parts)


def writer_claims(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """(dataset, column_group, writer) of both -> dataset, column_group, status: missing, mismatched or orphan; orphans are told
    and never deleted."""
    return diff_declared(declared, observed, ["dataset", "column_group"], "writer")


def is_publishable_column(columns: DataFrame, column_licences: DataFrame) -> DataFrame:
    """columns (table, column) with publishable: only what is declared commercial-ok is; undeclared columns are not."""
    told = columns.join(F.broadcast(column_licences.select("table", "column", "tag")), ["table", "column"], "left")
    return told.withColumn("publishable", F.coalesce(F.col("tag") == "commercial-ok", F.lit(False)))
