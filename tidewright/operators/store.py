"""Tables that are written: raw files by content, logs with retention, observations, seeds and plans of writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.codes import raw_file_name, raw_key
from tidewright.operators.keyed import KEEP, diff_declared, merge_upsert

#: Days that runs are kept, and failed codes that a run's row lists.
RETENTION_DAYS, MOST_CODES = 90, 50


def raw_files(fetched: DataFrame) -> DataFrame:
    """fetched (content, source, datatype, scope, data_date, ext, doc_id and more) with sha256, size_bytes, key and file name."""
    rows = fetched.withColumns({"sha256": F.sha2("content", 256), "size_bytes": F.octet_length("content").cast("long")})
    parts = [F.col(c) for c in ("source", "datatype", "scope", "data_date")]
    return rows.withColumns({"key": raw_key(*parts, F.col("sha256"), F.col("ext"), F.col("doc_id")), "filename": raw_file_name(*parts, F.col("ext"))})


def raw_names(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """rows (filename, sha256), each once, with the name under which their bytes are kept: their own where it is free or holds the
    same bytes, else one with the digest's first 8 characters; nothing is overwritten. Of new rows with one name the least digest
    has it."""
    rows = rows.dropDuplicates(["filename", "sha256"])
    taken = stored.groupBy("filename").agg(F.min("sha256").alias("_held"))
    first = rows.groupBy("filename").agg(F.min("sha256").alias("_first"))
    other = F.regexp_replace("filename", "([.][^.]*)$", "")
    named = F.concat(other, F.lit("_"), F.substring("sha256", 1, 8), F.regexp_extract("filename", "([.][^.]*)$", 1))
    told = rows.join(taken, "filename", "left").join(first, "filename")
    return told.withColumn("name", F.when(F.coalesce("_held", "_first") == F.col("sha256"), F.col("filename")).otherwise(named)).drop("_held", "_first")


def unseen(rows: DataFrame, stored: DataFrame, key: str = "sha256") -> DataFrame:
    """Rows whose content is not stored yet, each content once."""
    return rows.dropDuplicates([key]).join(stored.select(key), key, "left_anti")


def index_raw(index: DataFrame, rows: DataFrame) -> DataFrame:
    """The index with the rows of stored objects merged in by digest; when a file was first fetched stays."""
    return merge_upsert(index, rows.dropDuplicates(["sha256"]), ["sha256"], {"first_fetched_at": KEEP})


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text: arrays, maps and structs as JSON."""
    plain = lambda c, kind: F.to_json(c) if kind.startswith(("array", "map", "struct")) else F.col(c).cast("string")
    return df.select(*[plain(c, kind).alias(c) for c, kind in df.dtypes])


def write_pair(df: DataFrame, path: str, name: str) -> tuple[str, str]:
    """The table as CSV and as Parquet, all text, beside the raw file: the paths of both."""
    base = f"{path}/{name.rsplit('.', 1)[0]}_converted"
    text = as_text(df)
    text.write.option("header", True).option("emptyValue", "").csv(f"{base}.csv")
    text.write.parquet(f"{base}.parquet")
    return f"{base}.csv", f"{base}.parquet"


def write_typed(df: DataFrame, path: str, name: str) -> str:
    """The table as Parquet with its own types, beside the raw file."""
    out = f"{path}/{name.rsplit('.', 1)[0]}_converted.parquet"
    df.write.parquet(out)
    return out


def within_retention(runs: DataFrame, now: Column, days: int = RETENTION_DAYS, column: str = "finished_at") -> DataFrame:
    """Runs whose epoch isn't older than the days; the boundary itself and unknown times stay."""
    return runs.filter(~F.coalesce(F.col(column) < F.unix_seconds(now) - days * 86400, F.lit(False)))


def log_runs(runs: DataFrame, finished: DataFrame, now: Column) -> DataFrame:
    """The run log with old rows gone and finished runs (failed_codes as an array) appended; a run lists at most MOST_CODES codes,
    as JSON, null if none."""
    codes = F.when(F.size("failed_codes") > 0, F.to_json(F.slice("failed_codes", 1, MOST_CODES)))
    return within_retention(runs, now).unionByName(finished.withColumn("failed_codes", codes), allowMissingColumns=True)


def append_log(log: DataFrame, finished: DataFrame) -> DataFrame:
    """The plain log: every run is a row, codes joined by commas."""
    codes = F.when(F.size("failed_codes") > 0, F.array_join("failed_codes", ","))
    return log.unionByName(finished.withColumn("failed_codes", codes), allowMissingColumns=True)


def record_freshness(stored: DataFrame, observed: DataFrame) -> DataFrame:
    """One row for each dataset, wholly replaced by what was observed; updated_at is the data's own epoch, never the time of the
    observation, so an observation that has none is an error."""
    checked = observed.withColumn("updated_at", F.coalesce("updated_at", F.raise_error(F.concat(F.lit("no epoch of its own: "), "dataset"))))
    return merge_upsert(stored, checked.dropDuplicates(["dataset"]), ["dataset"])


def seed(stored: DataFrame, declared: DataFrame, keys: list[str], column: str, prune: bool) -> tuple[DataFrame, DataFrame]:
    """(the table after seeding, what differed before): declared rows are written where missing or different; rows that are not
    declared go if prune, else stay and are only told."""
    differ = diff_declared(declared, stored, keys, column)
    others = stored.join(declared.select(*keys), keys, "left_anti")
    return (declared if prune else declared.unionByName(others.select(*declared.columns))), differ


def plan(table: str, old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """What writing new in place of old would do, without doing it: table, operation, rows."""
    rest = [c for c in new.columns if c not in keys]
    o = old.select(*keys, F.struct(*rest).alias("_o"), F.lit(True).alias("_in_o"))
    n = new.select(*keys, F.struct(*rest).alias("_n"), F.lit(True).alias("_in_n"))
    kind = F.when(F.col("_in_o").isNull(), "insert").when(F.col("_in_n").isNull(), "delete").when(~F.col("_o").eqNullSafe(F.col("_n")), "update").otherwise("keep")
    return o.join(n, keys, "full_outer").groupBy(kind.alias("operation")).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(table).alias("table"), "operation", "rows")


def write_to_all(df: DataFrame, writers: dict[str, Callable[[DataFrame], None]], dry_run: bool = False) -> dict[str, str | None]:
    """Each store's writer on its own: the error by name, null where it went well. All failing is an error; a dry run calls none."""
    if dry_run:
        return dict.fromkeys(writers)
    errors: dict[str, str | None] = {}
    for name, write in writers.items():
        try:
            write(df)
            errors[name] = None
        except Exception as e:
            errors[name] = f"{type(e).__name__}: {e}"
    if writers and all(errors.values()):
        raise RuntimeError("no store was written: " + "; ".join(f"{k}: {v}" for k, v in errors.items()))
    return errors


def exportable(files: DataFrame) -> DataFrame:
    """files (url, sha256, content, license_tag) that may be handed on: a digest that is the content's, a known link, a zip, and a
    licence that allows it."""
    zipped = F.hex(F.substring("content", 1, 4)) == "504B0304"
    return files.filter((F.sha2("content", 256) == F.col("sha256")) & F.coalesce(F.col("url").startswith("https://"), F.lit(False)) & zipped & (F.col("license_tag") == "commercial-ok"))


def trusted_map(entries: DataFrame, target: Column) -> DataFrame:
    """Entries of a date-scoped lookup that may be trusted: those of the target day alone."""
    return entries.filter(F.col("event_date") == target)


def write_map(entries: DataFrame, path: str) -> None:
    """Add the entries of some days (event_date and others) to a lookup that is laid out by day; a day's entries replace those it has."""
    entries.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def look_up_dated(rows: DataFrame, entries: DataFrame, day: str, key: str, value: str) -> DataFrame:
    """rows with the value that the lookup holds for their key on their own day, null where it holds none: an entry of another day is never
    taken. Which days the rows have is found first, so no other day of the lookup is read."""
    days = rows.select(day).distinct().filter(F.col(day).isNotNull())
    own = entries.select(F.col("event_date").alias(day), F.col(key), F.col(value)).join(F.broadcast(days), day, "left_semi")
    return rows.join(own, [day, key], "left")
