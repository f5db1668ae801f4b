"""Read queries: filters, paging, redaction, envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.values import is_publishable, market_day


def where_equal(df: DataFrame, **values) -> DataFrame:
    for column, value in values.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def where_between(df: DataFrame, column: str, since=None, until=None) -> DataFrame:
    """A closed range; an end that is None is open."""
    if since is not None:
        df = df.filter(F.col(column) >= F.lit(since).cast(df.schema[column].dataType))
    return df if until is None else df.filter(F.col(column) <= F.lit(until).cast(df.schema[column].dataType))


def page(df: DataFrame, order: list, limit: int, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def limit_of(text: str | None, default: int = 100, most: int = 500) -> int:
    """A limit as a request gives it: the default for what isn't a positive number, never more than the cap."""
    try:
        n = int(float(text))
    except (TypeError, ValueError, OverflowError):
        return default
    return min(n, most) if n > 0 else default


def redact(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as nulls of their types."""
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in columns})


#: Columns that a public reader gets as nulls, by table.
RESTRICTED = {"core_stocks": ["market", "sector", "sector17", "instrument_type"], "yutai_benefits": ["description", "short_summary", "estimated_value"]}


def envelope(df: DataFrame, licence: str, source: str, order: str) -> DataFrame:
    """Distinct licences in order, distinct sources in the order in which they come first, and the number of rows; empty and null
    ones aren't named. Sources are few: only their first places are gathered."""
    named = lambda c: F.when(F.col(c) != "", F.col(c))
    rows = df.groupBy(named(licence).alias("l"), named(source).alias("s")).agg(F.min(order).alias("at"), F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("s").agg(F.min("at").alias("at"), F.collect_set("l").alias("l"), F.sum("n").alias("n"))
    sources = F.transform(F.array_sort(F.collect_list(F.when(F.col("s").isNotNull(), F.struct("at", "s")))), lambda x: x["s"])
    licences = F.array_sort(F.array_distinct(F.flatten(F.collect_list("l"))))
    return first.agg(F.concat_ws(",", licences).alias("licences"), F.concat_ws(",", sources).alias("sources"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def redact_table(df: DataFrame, table: str, public: bool = True) -> DataFrame:
    return redact(df, [c for c in RESTRICTED.get(table, []) if c in df.columns]) if public else df


def like_prefix(df: DataFrame, column: str, prefix: str | None) -> DataFrame:
    """Rows whose text begins as the pattern does: % and _ in it are wildcards, as its users may have come to expect."""
    return df if not prefix else df.filter(F.col(column).like(f"{prefix}%"))


def stocks(df: DataFrame, listed: bool | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    return page(where_equal(df, listed=listed), ["code"], limit, offset)


def stock(df: DataFrame, code: str) -> DataFrame:
    return df.filter(F.col("code") == code)


def prices(df: DataFrame, code: str, since=None, until=None, limit: int = 500) -> DataFrame:
    return page(where_between(where_equal(df, code=code), "data_date", since, until), [F.desc("data_date")], limit)


def financials(df: DataFrame, code: str, disclosure_type: str | None = None, limit: int = 100) -> DataFrame:
    return page(where_equal(df, code=code, disclosure_type=disclosure_type or None), [F.desc("fiscal_period_end"), "disclosure_type", "consolidated"], limit)


def disclosures(df: DataFrame, code: str | None = None, doc_type: str | None = None, since=None, until=None, limit: int = 200) -> DataFrame:
    rows = where_equal(df, code=code or None, doc_type=doc_type or None)
    return page(where_between(rows, "disclosed_at", since, until), [F.desc("disclosed_at"), "doc_id"], limit)


def raw_index(df: DataFrame, scope: str | None = None, limit: int = 200) -> DataFrame:
    return page(where_equal(df, scope=scope or None), [F.desc("fetched_at"), "sha256"], limit)


def facts(df: DataFrame, doc_id: str | None = None, code: str | None = None, element: str | None = None, text_only: bool = False, limit: int | None = 200, offset: int = 0) -> DataFrame:
    """A page of facts in order. Without a limit all of them, in no order, for another search to page: a limit of millions would
    bring them all to one task."""
    rows = like_prefix(where_equal(df, doc_id=doc_id or None, code=code or None), "element", element)
    rows = rows.filter("is_text_block") if text_only else rows
    if limit is None and offset:
        raise ValueError("an offset needs a limit")
    return rows if limit is None else page(rows, ["doc_id", "element", "context_ref"], limit, offset)


def search_facts(df: DataFrame, text: str, code: str | None = None, limit: int = 100) -> DataFrame:
    """Blocks of text that contain the words, in either case; % and _ in them are wildcards."""
    rows = where_equal(df.filter("is_text_block"), code=code or None)
    return page(rows.filter(F.col("value").ilike(f"%{text}%")), ["doc_id", "element", "context_ref"], limit)


def jobs(df: DataFrame, job_name: str | None = None, limit: int = 100) -> DataFrame:
    return page(where_equal(df, job_name=job_name or None), [F.desc("finished_at"), "job_name"], limit)


def public_freshness(df: DataFrame, public: bool = True) -> DataFrame:
    """Observations in order of dataset; the public doesn't see those of personal-only data, but those without a tag."""
    rows = df.filter(F.coalesce("license_tag", F.lit("")) != "personal-only") if public else df
    return rows.orderBy("dataset")


def elements(df: DataFrame, prefix: str | None = None, limit: int = 100) -> DataFrame:
    """The element vocabulary, by a prefix taken as it is, which reaches the scan."""
    return page(df.filter(F.col("element").startswith(prefix)) if prefix else df, ["element"], limit)


def element_vocabulary(df: DataFrame) -> DataFrame:
    """element, namespace, doc_count, is_text_block from typed facts."""
    space = F.when(F.col("element").contains(":"), F.substring_index("element", ":", 1))
    return df.groupBy("element").agg(F.count_distinct("doc_id").alias("doc_count")).select("element", space.alias("namespace"), "doc_count", F.col("element").endswith("TextBlock").alias("is_text_block"))


def raw_file(df: DataFrame, sha256: str | Column, public: bool = True) -> DataFrame:
    """The file of a digest; a text that isn't a digest finds nothing, and the public only finds what may be published in full."""
    rows = df.filter((F.col("sha256") == sha256) & F.col("sha256").rlike("^[0-9a-f]{64}$"))
    return rows.filter(is_publishable(F.col("license_tag"))) if public else rows


def supply_latest(df: DataFrame, data_type: str | None = None, limit: int = 100) -> DataFrame:
    return page(where_equal(df, data_type=data_type or None), ["code", "data_type"], limit)


def benefits(rows: DataFrame, master: DataFrame, code: str) -> DataFrame:
    """A company's shareholder benefits, 50 at most, without the columns that may not be shown."""
    own = master.filter(F.col("code") == code).select(F.col("id").alias("stock_id"))
    shown = redact_table(rows.join(own, "stock_id").select("genre_id", "min_shares", "record_month"), "yutai_benefits")
    return page(shown, ["genre_id", "min_shares", "record_month"], 50)


def most_profitable(df: DataFrame, limit: int = 100) -> DataFrame:
    """Annual records by return on equity, the highest first; unknown ones come last."""
    return page(df.filter("disclosure_type = '本決算'"), [F.desc_nulls_last("roe_pct"), "code"], limit)


def by_sector(master: DataFrame) -> DataFrame:
    return master.groupBy("sector33").agg(F.count(F.lit(1)).alias("companies"), F.count_if("listed").alias("listed"))


def calendar(df: DataFrame) -> DataFrame:
    """Disclosures by market day and label."""
    return df.groupBy(market_day(F.col("disclosed_at")).alias("day"), "doc_type").agg(F.count(F.lit(1)).alias("documents"))


def head(rows: DataFrame, order: list, limit: int | None) -> DataFrame:
    """The first rows of a list of work; 0 and none mean all."""
    return rows.orderBy(*order).limit(limit) if limit else rows.orderBy(*order)


def among(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose value is in a table of values, however many."""
    return df.join(values.select(F.col(values.columns[0]).alias(column)), column, "left_semi")
