"""The table of listed companies: what lists, disclosures and absences may change in it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.codes import normalize_sector
from tidewright.functions.values import clip
from tidewright.operators.keyed import PRESERVE, changed_rows, departed, merge_upsert, pick_last

#: States, the labels that set them, and the columns that a list owns and those that disclosures own.
LISTED, DELISTED = "上場", "上場廃止"
LIFECYCLE = {"上場廃止": (DELISTED, "delisting_date"), "新規上場": (LISTED, "listing_date")}
LIST_COLUMNS = ["name", "listed", "market", "sector33", "sector17", "edinet_code"]
LIFECYCLE_COLUMNS = ["status", "listing_date", "delisting_date"]


def one_for_each_code(rows: DataFrame) -> DataFrame:
    """Of rows with one code the last by ord."""
    return pick_last(rows, ["code"], [F.col("ord")])


def upsert(master: DataFrame, rows: DataFrame, include_lifecycle: bool = False) -> DataFrame:
    """The list's rows merged in; states and dates, which disclosures own, are only written if asked."""
    return merge_upsert(master, rows, ["code"], {} if include_lifecycle else dict.fromkeys(LIFECYCLE_COLUMNS, PRESERVE))


def to_write(master: DataFrame, rows: DataFrame) -> DataFrame:
    """The list's rows that are new or differ from the stored one in a column that the list owns. Names are compared as they are
    stored, clipped; an unknown EDINET code equals an empty one. Times and provenance, which change every run, don't count."""
    shown = lambda df: df.select("code", *[clip(F.col(c)).alias(c) if c == "name" else F.coalesce(F.col(c), F.lit("")).alias(c) if c == "edinet_code" else F.coalesce(F.col(c), F.lit(False)).alias(c) if c == "listed" else F.col(c) for c in LIST_COLUMNS])
    changed = changed_rows(shown(master), shown(rows), ["code"], LIST_COLUMNS).select("code")
    new = rows.select("code").join(master.select("code"), "code", "left_anti")
    return rows.join(changed.unionByName(new).distinct(), "code", "left_semi")


def sector_changes(master: DataFrame, rows: DataFrame) -> DataFrame:
    """code, sector33: the exchange's name for each listed company whose stored sector is another; others' codes are left alone."""
    named = rows.select("code", normalize_sector(F.col("sector33")).alias("sector33"))
    return changed_rows(master.select("code", "sector33"), named, ["code"], ["sector33"]).select("code", "sector33")


def grouped_changes(changes: DataFrame, column: str, most: int = 99) -> DataFrame:
    """Changes by new value, in lists of bounded size: value, part, codes."""
    part = F.pmod(F.xxhash64("code"), F.greatest(F.lit(1), F.ceil(F.col("_n") / (most / 2))))
    sizes = changes.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    dealt = changes.join(sizes.select(F.col(column).alias("_v"), "_n"), F.col(column).eqNullSafe(F.col("_v"))).withColumn("part", part)
    return dealt.groupBy(column, "part").agg(F.array_sort(F.collect_list("code")).alias("codes"))


def mark_absent(master: DataFrame, fetched: DataFrame, least_coverage: float = 0.5) -> DataFrame:
    """The master with listed = false for codes that the list lacks, unless it covers too few; the state is left to disclosures."""
    gone = departed(master.select("code"), fetched.select("code"), "code", least_coverage).withColumn("_gone", F.lit(True))
    return master.join(gone, "code", "left").withColumn("listed", F.when(F.col("_gone"), F.lit(False)).otherwise(F.col("listed"))).select(*master.columns)


def lifecycle_updates(records: DataFrame) -> DataFrame:
    """code, status, listing_date, delisting_date of listing events: of one code's the latest disclosed. A date is known only if
    the disclosure states it."""
    kind = F.col("doc_type")
    rows = records.filter(kind.isin(*LIFECYCLE) & (F.coalesce("code", F.lit("")) != ""))
    date = lambda column: F.max_by(F.when(kind.isin(*[k for k, v in LIFECYCLE.items() if v[1] == column]), F.col("effective_date")), F.when(kind.isin(*[k for k, v in LIFECYCLE.items() if v[1] == column]) & F.col("effective_date").isNotNull(), F.struct("disclosed_at", "doc_id"))).alias(column)
    status = F.max_by(F.when(kind == "上場廃止", DELISTED).otherwise(LISTED), F.struct("disclosed_at", "doc_id")).alias("status")
    return rows.groupBy("code").agg(status, date("listing_date"), date("delisting_date"))


def apply_lifecycle(master: DataFrame, updates: DataFrame) -> DataFrame:
    """The master with the states of listing events, and their dates where known; listed and codes not in it stay as they are."""
    new = updates.select("code", *[F.col(c).alias(f"_{c}") for c in LIFECYCLE_COLUMNS])
    joined = master.join(new, "code", "left")
    return joined.withColumns({c: F.coalesce(f"_{c}", c) for c in LIFECYCLE_COLUMNS}).select(*master.columns)


def code_of_issuer(master: DataFrame) -> DataFrame:
    """edinet_code, code: the last one of each by ord of the scan."""
    return pick_last(master.filter("edinet_code is not null").select("edinet_code", "code", "ord"), ["edinet_code"], [F.col("ord")]).select("edinet_code", "code")
