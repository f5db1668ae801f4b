"""Series of lending points by code, and their latest cross-section."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.codes import supply_key

#: The exchange whose row stands for a code, and the name and licence of the series.
PRIMARY_EXCHANGE = "東証およびＰＴＳ"
BALANCE_SERIES, FEE_SERIES = "jsf_zandaka", "jsf_shina"
SERIES_LICENCE = "personal-only"
SERIES_KEY = ["code", "data_type", "d", "ex"]
_BALANCE_POINT = ["loan_bal", "loan_chg", "stock_bal", "stock_chg", "ratio", "turn_days", "loan_amt", "stock_amt"]
_FEE_POINT = ["excess", "max_rate", "today_rate", "prev_rate", "note", "bid_rank"]


def change(new: str, repaid: str) -> Column:
    """What came less what went; unknown if either is."""
    return F.col(new) - F.col(repaid)


def balance_points(rows: DataFrame) -> DataFrame:
    """Rows of balances as points: code, data_type, d (as text), ex, ord and the measures."""
    rows = rows.withColumns({"loan_chg": change("loan_new", "loan_repaid"), "stock_chg": change("stock_new", "stock_repaid")})
    return rows.select("code", F.lit(BALANCE_SERIES).alias("data_type"), F.date_format("d", "yyyy-MM-dd").alias("d"), "ex", "ord", *_BALANCE_POINT)


def fee_points(rows: DataFrame) -> DataFrame:
    text = [F.nullif(F.col(c), F.lit("")).alias(c) if c in ("note", "bid_rank") else F.col(c) for c in _FEE_POINT]
    return rows.select("code", F.lit(FEE_SERIES).alias("data_type"), F.date_format("d", "yyyy-MM-dd").alias("d"), "ex", "ord", *text)


def as_documents(points: DataFrame) -> DataFrame:
    """code, data_type, points: each series as JSON objects without unknown fields, in order of day and exchange. One series of
    one code is gathered: a row a day and exchange."""
    fields = [c for c in points.columns if c not in ("code", "data_type", "ord")]
    point = F.struct(F.coalesce("d", F.lit("")).alias("_d"), F.coalesce("ex", F.lit("")).alias("_ex"), F.to_json(F.struct(*fields)).alias("json"))
    return points.groupBy("code", "data_type").agg(F.transform(F.array_sort(F.collect_list(point)), lambda p: p["json"]).alias("points"))


def merge_series(existing: DataFrame, points: DataFrame, keys: list[str] = SERIES_KEY) -> DataFrame:
    """Both sets of points, new ones in place of old ones with the same keys (null equals null), of new ones the last by ord. No
    old point with other keys is lost, and other series stay."""
    fields = [c for c in existing.columns if c != "ord"]
    both = existing.withColumn("_new", F.lit(0)).unionByName(points.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_new"), F.desc("ord")))
    return both.withColumn("_last", last).filter("_last = 1").select(*fields)


def primary_rows(rows: DataFrame, primary: str = PRIMARY_EXCHANGE) -> DataFrame:
    """For each code and data_type the row of the primary exchange, else the first of the file."""
    rest = [c for c in rows.columns if c not in ("code", "data_type")]
    best = rows.groupBy("code", "data_type").agg(F.min_by(F.struct(*rest), F.struct(~F.col("ex").eqNullSafe(F.lit(primary)), "ord")).alias("_r"))
    return best.select("code", "data_type", "_r.*")


def latest_rows(points: DataFrame, stored: DataFrame, fetched_at: Column, quality: Column) -> DataFrame:
    """The latest table's rows for codes whose series is stored (stored: code). Only balances reach it, without their changes."""
    balances = primary_rows(points.filter(F.col("data_type") == BALANCE_SERIES)).join(stored.select("code").distinct(), "code", "left_semi")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return balances.select(
        "code", "data_type", F.col("d").alias("data_date"), none("string", "isin"), "loan_bal", none("long", "loan_chg"), "stock_bal", none("long", "stock_chg"), "ratio", "turn_days",
        supply_key(F.col("code")).alias("r2_key"), F.lit(SERIES_LICENCE).alias("license_tag"), F.unix_seconds(fetched_at).alias("updated_at"), quality.alias("quality"),
    )


def series_between(points: DataFrame, code: str, series: str | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """The points of a code, of one series or all, in a closed range of days as text."""
    out = points.filter(F.col("code") == code)
    for part in ([F.col("data_type") == series] if series else []) + ([F.coalesce("d", F.lit("")) >= since] if since else []) + ([F.coalesce("d", F.lit("")) <= until] if until else []):
        out = out.filter(part)
    return out
