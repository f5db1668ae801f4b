"""Rows of a store without unique keys: which of several stands for a key, and when it may be overwritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.values import clip, same_instant

#: The kinds that a kind was called before, and the key of a financial record.
EARLIER_KINDS = {"中間": ("2Q",)}
FINANCIAL_KEY = ["code", "fiscal_period_end", "disclosure_type", "consolidated"]
#: Columns of a disclosure whose change is worth a write.
DISCLOSURE_COLUMNS = ["title", "disclosed_at", "doc_type", "has_xbrl", "code", "source_url", "split_ratio", "split_factor", "effective_date"]


def plain_id(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "-", ""))


def oldest(rows: DataFrame, keys: list[str], created: str = "created_time", page: str = "id") -> DataFrame:
    """For each key the row created first, of those the one with the least id. One pass that combines before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(created, plain_id(F.col(page)))).alias("_r"))
    return best.select(*keys, "_r.*")


def converge(rows: DataFrame, keys: list[str], created: str = "created_time", page: str = "id") -> DataFrame:
    """page, keep and whether the row stays: rows of one key converge onto the oldest."""
    keep = oldest(rows.select(*keys, created, page), keys, created, page).select(*keys, F.col(page).alias("keep"))
    return rows.select(*keys, page).join(keep, keys).select(page, "keep", (F.col(page) == F.col("keep")).alias("stays"))


def write_targets(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Each financial record with the id of the stored row it is written to, or null for a new row. Rows of the exact key come
    first, then those of the kind's earlier name, then those without a scope; of equals the oldest."""
    earlier = F.create_map(*[x for k, v in EARLIER_KINDS.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))])
    stored = pages.select("code", "fiscal_period_end", F.col("disclosure_type").alias("_kind"), F.nullif("consolidated", F.lit("")).alias("_scope"), "created_time", "id")
    rows = records.withColumn("consolidated", F.nullif("consolidated", F.lit("")))
    met = rows.select(*FINANCIAL_KEY).distinct().join(stored, ["code", "fiscal_period_end"])
    kind = (F.col("_kind") == F.col("disclosure_type")) | F.coalesce(F.array_contains(earlier[F.col("disclosure_type")], F.col("_kind")), F.lit(False))
    met = met.filter(kind & (F.col("_scope").eqNullSafe(F.col("consolidated")) | F.col("_scope").isNull()))
    rank = F.struct(~F.col("_scope").eqNullSafe(F.col("consolidated")), F.col("_kind") != F.col("disclosure_type"), "created_time", plain_id(F.col("id")))
    best = met.groupBy(*FINANCIAL_KEY).agg(F.min_by("id", rank).alias("page"))
    best = best.withColumnsRenamed({c: f"_{c}" for c in FINANCIAL_KEY})
    return rows.join(best, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FINANCIAL_KEY], "left").select(*rows.columns, "page")


def may_overwrite(stored_at: Column, incoming_at: Column) -> Column:
    """Only a stored row that is known to be newer blocks: an unknown time on either side allows, unlike the guard of merges."""
    return ~F.coalesce(stored_at > incoming_at, F.lit(False))


def disclosures_to_write(stored: DataFrame, records: DataFrame) -> DataFrame:
    """Records whose stored row is missing or differs where it matters; an instant is one whatever its offset, empty text equals
    none, and the time of fetching doesn't count. Titles meet as digests: the join need not move them unless the output holds them."""
    plain = lambda c: F.coalesce(F.col(c), F.lit(""))
    digest = lambda c: F.unhex(F.sha2(c, 256))
    old = stored.select("doc_id", *[(digest(F.col(c)) if c == "title" else F.col(c)).alias(f"_{c}") for c in DISCLOSURE_COLUMNS], F.lit(True).alias("_known"))
    same = F.lit(True)
    for c, kind in records.select(*DISCLOSURE_COLUMNS).dtypes:
        if c == "disclosed_at" and kind == "string":
            same = same & same_instant(F.col(c), F.col(f"_{c}"))
        elif c == "title":
            same = same & F.col("_digest").eqNullSafe(F.col(f"_{c}"))
        else:
            same = same & (plain(c) == plain(f"_{c}") if kind == "string" else F.col(c).eqNullSafe(F.col(f"_{c}")))
    return records.withColumn("_digest", digest(clip(F.col("title")))).join(old, "doc_id", "left").filter(~(F.coalesce("_known", F.lit(False)) & same)).select(*records.columns)
