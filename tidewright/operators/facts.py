"""From tidy facts (all strings, one row per fact, `ord` for their order) to typed facts and to one typed record per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.values import accounting_standard, as_percent, interim_type, parse_numeric, strip

#: The elements that hold each measure, the preferred ones first.
MEASURES = {
    "net_sales": ["NetSales", "OperatingRevenues", "OperatingRevenue", "Revenue", "RevenuesIFRS", "RevenueIFRS", "NetSalesIFRS", "SalesIFRS"],
    "operating_income": ["OperatingIncome", "OperatingProfit", "OperatingIncomeIFRS", "OperatingProfitIFRS", "OperatingProfitLossIFRS"],
    "ordinary_income": ["OrdinaryIncome", "OrdinaryProfit", "OrdinaryProfitLoss", "ProfitBeforeTaxIFRS"],
    "net_income": ["ProfitAttributableToOwnersOfParent", "ProfitAttributableToOwnersOfParentIFRS", "NetIncome", "ProfitLossAttributableToOwnersOfParent", "ProfitLoss"],
    "eps": ["NetIncomePerShare", "BasicEarningsPerShareIFRS", "BasicEarningsLossPerShare", "BasicEarningsPerShare", "BasicNetIncomePerShare",
            "BasicEarningsLossPerShareSummaryOfBusinessResults", "BasicEarningsLossPerShareIFRSSummaryOfBusinessResults", "BasicEarningsLossPerShareIFRS"],
    "bps": ["NetAssetsPerShare", "BookValuePerShare", "EquityAttributableToOwnersOfParentPerShareIFRS", "NetAssetsPerShareSummaryOfBusinessResults",
            "EquityAttributableToOwnersOfParentPerShareIFRSSummaryOfBusinessResults"],
    "equity_ratio_pct": ["CapitalAdequacyRatio", "EquityToAssetRatio", "RatioOfOwnersEquityToTotalAssets", "EquityAttributableToOwnersOfParentToTotalAssetsRatioIFRS",
                         "EquityToAssetRatioSummaryOfBusinessResults", "EquityToAssetRatioIFRSSummaryOfBusinessResults"],
    "cf_operating": ["CashFlowsFromOperatingActivities", "NetCashProvidedByUsedInOperatingActivities", "CashFlowsFromUsedInOperatingActivitiesIFRS"],
    "cf_investing": ["CashFlowsFromInvestingActivities", "NetCashProvidedByUsedInInvestmentActivities", "NetCashProvidedByUsedInInvestingActivities",
                     "NetCashProvidedByUsedInInvestingActivitiesSummaryOfBusinessResults", "CashFlowsFromUsedInInvestingActivitiesIFRS",
                     "CashFlowsFromUsedInInvestingActivitiesIFRSSummaryOfBusinessResults"],
    "cf_financing": ["CashFlowsFromFinancingActivities", "NetCashProvidedByUsedInFinancingActivities", "CashFlowsFromUsedInFinancingActivitiesIFRS"],
}
DIVIDENDS = ["DividendPerShare", "DistributionsPerUnit", "DividendPaidPerShareSummaryOfBusinessResults"]
FORECASTS = ("net_sales", "operating_income", "ordinary_income", "net_income", "eps")
RATIOS = ("equity_ratio_pct",)
#: Elements of the period's end, its kind and the accounting standard, and the kinds as records name them.
PERIOD_END = ["CurrentPeriodEndDateDEI", "CurrentFiscalYearEndDateDEI", "FiscalYearEnd", "FiscalYearEndDEI"]
PERIOD_KIND = ["TypeOfCurrentPeriodDETAIL", "TypeOfCurrentPeriodDEI", "QuarterlyPeriodDEI", "QuarterlyPeriod", "TypeOfCurrentPeriod"]
STANDARD = ["AccountingStandardsDEI", "AccountingStandards"]
KINDS = {"FY": "本決算", "1Q": "1Q", "2Q": "2Q", "HY": "2Q", "3Q": "3Q", "Q1": "1Q", "Q2": "2Q", "Q3": "3Q", "1": "1Q", "2": "2Q", "3": "3Q"}
FACT_KEY = ["doc_id", "element", "context_ref"]


def local_name(element: Column) -> Column:
    return F.substring_index(element, ":", -1)


def is_forecast(context: Column) -> Column:
    return context.contains("Forecast")


def is_next_year(context: Column) -> Column:
    return context.contains("NextYear") | context.contains("NextAccumulated")


def is_current(context: Column) -> Column:
    return context.startswith("Current") | context.contains("CurrentYear")


def is_text_block(element: Column) -> Column:
    return element.endswith("TextBlock")


def _rank(candidates: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col("_name"))


def prepared(facts: DataFrame, numbers: set[str], texts: set[str]) -> DataFrame:
    """Facts with what picks look at, each once: the local name, the text and number of the elements that are picked as such, the place of
    the scope and kinds of context."""
    scope = F.when(F.col("consolidated") == "連結", 0).when(F.col("consolidated") == "", 1).when(F.col("consolidated") == "単体", 2)
    context = F.col("context_ref")
    ahead = is_forecast(context)
    name, value = local_name(F.col("element")), F.col("value")
    return facts.withColumns({
        "_name": name, "_text": strip(F.when(name.isin(*sorted(texts)), value)), "_number": parse_numeric(F.when(name.isin(*sorted(numbers)), value)), "_scope": scope, "_actual": is_current(context) & ~ahead, "_next": ahead & is_next_year(context), "_other": ahead & ~is_next_year(context),
    })


def pick_value(candidates: list[str], where: str) -> Column:
    """Over prepared facts: the first parseable value by candidate, then consolidated before unknown before single, then order."""
    rank = _rank(candidates)
    return F.min_by("_number", F.when((rank > 0) & F.col("_number").isNotNull() & F.col("_scope").isNotNull() & F.col(where), F.struct(rank, "_scope", "ord")))


def pick_text(candidates: list[str]) -> Column:
    """Over prepared facts: the first text that isn't blank by candidate, then order."""
    rank = _rank(candidates)
    return F.min_by("_text", F.when((rank > 0) & (F.col("_text") != ""), F.struct(rank, "ord")))


def summarize(
    facts: DataFrame, measures: dict[str, list[str]] | None = None, forecasts: dict[str, list[str]] | None = None, ratios: tuple[str, ...] = RATIOS, dividends: list[str] | None = None, kind: Column | None = None
) -> DataFrame:
    """One record per doc_id that has a period end, in one grouped pass: measures, forecast_ columns, the dividend paid and
    forecast, period end, kind, standard and scope. A next-year forecast of exactly 0 gives way to any other forecast, as one
    that is missing does. kind: an aggregate that overrules the filing's own. Returns on equity and assets are never computed."""
    measures = MEASURES if measures is None else measures
    forecasts = {f"forecast_{k}": MEASURES[k] for k in FORECASTS} if forecasts is None else forecasts
    dividends = DIVIDENDS if dividends is None else dividends
    context = F.col("context_ref")
    aggs = [pick_value(names, "_actual").alias(k) for k, names in measures.items()]
    for k, names in forecasts.items():
        aggs += [pick_value(names, "_next").alias(f"_next_{k}"), pick_value(names, "_other").alias(f"_this_{k}")]
    aggs += [pick_value(dividends, "_actual").alias("dps_actual"), pick_value(dividends, "_other").alias("dps_forecast")]
    texts = {"_end": PERIOD_END, "_standard": STANDARD, "_kind": PERIOD_KIND}
    aggs += [pick_text(names).alias(k) for k, names in texts.items()]
    ends = F.max(F.when(context.contains("CurrentYear") & ~is_forecast(context), F.try_to_date(F.substring("period_end", 1, 10), "yyyy-MM-dd")))
    # all scopes being one says as much as a count of distinct ones, which would group and shuffle everything once more
    label = F.when(F.bool_or(F.col("consolidated") == "連結"), "連結").when(F.bool_and(F.col("consolidated") == "単体"), "単体")
    aggs += [ends.alias("_ends"), label.alias("consolidated"), (F.lit(None).cast("string") if kind is None else kind).alias("_given")]
    numbers = {x for names in [*measures.values(), *forecasts.values(), dividends] for x in names}
    wide = prepared(facts, numbers, {x for names in texts.values() for x in names}).groupBy("doc_id").agg(*aggs)
    named = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])[F.col("_kind")]
    wide = wide.withColumns({
        "fiscal_period_end": F.coalesce(F.try_to_date(F.substring("_end", 1, 10), "yyyy-MM-dd"), "_ends"), "accounting_standard": accounting_standard(F.col("_standard")), "disclosure_type": F.coalesce("_given", named, F.lit("本決算")),
    }).filter("fiscal_period_end is not null").drop(*texts, "_ends", "_given")
    for k in forecasts:
        following = F.col(f"_next_{k}")
        wide = wide.withColumn(k, F.when(following.isNotNull() & (following != 0), following).otherwise(F.col(f"_this_{k}"))).drop(f"_next_{k}", f"_this_{k}")
    wide = wide.withColumn("disclosure_type", interim_type(F.col("disclosure_type"), F.col("fiscal_period_end")))
    wide = wide.withColumns({k: as_percent(F.col(k)) for k in ratios if k in measures})
    return wide.withColumns({k: F.lit(None).cast("double") for k in ("roe_pct", "roa_pct")})


def typed_facts(facts: DataFrame, source: Column, licence: Column, fetched_at: Column) -> DataFrame:
    """Facts as they are stored: blank values and incomplete keys go, empty text is null, of rows with one key the last stays,
    with a flag for blocks of text and the provenance of the file."""
    kept = facts.withColumn("value", strip(F.col("value")))
    for c in (*FACT_KEY, "value"):
        kept = kept.filter(F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    last = F.row_number().over(Window.partitionBy(*FACT_KEY).orderBy(F.desc("ord")))
    kept = kept.withColumn("_last", last).filter("_last = 1").drop("_last")
    plain = [F.nullif(F.col(c), F.lit("")).alias(c) for c in ("code", "period_start", "period_end", "instant_date", "consolidated", "unit")]
    return kept.select(*FACT_KEY, *plain, "value", is_text_block(F.col("element")).alias("is_text_block"), source.alias("source"), licence.alias("license_tag"), fetched_at.alias("fetched_at"))
