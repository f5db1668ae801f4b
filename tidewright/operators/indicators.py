"""Technical indicators of daily prices. The reference only names them; what it leaves open is defined here: a window that isn't
full gives null, deviations are of the population, and exponential and Wilder averages begin with the first value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _last(n: int, by: str, order: str):
    return Window.partitionBy(by).orderBy(order).rowsBetween(1 - n, 0)


def _full(value: Column, n: int, by: str, order: str) -> Column:
    return F.when(F.count(F.lit(1)).over(_last(n, by, order)) == n, value)


def moving(prices: DataFrame, by: str = "code", order: str = "data_date") -> DataFrame:
    """prices (by, order, close, volume) with sma5, sma25, sma75, sma200, the deviation from sma25 in percent, Bollinger bands of 20
    days at two deviations, volume over its mean of 25 days, high and low of 252 days, and the change from the day before."""
    mean = lambda c, n: _full(F.avg(c).over(_last(n, by, order)), n, by, order)
    out = prices.withColumns({f"sma{n}": mean("close", n) for n in (5, 25, 75, 200)})
    deviation = _full(F.stddev_pop("close").over(_last(20, by, order)), 20, by, order)
    before = F.lag("close").over(Window.partitionBy(by).orderBy(order))
    return out.withColumns({
        "sma25_dev_pct": (F.col("close") / F.col("sma25") - 1) * 100, "bb_upper": mean("close", 20) + 2 * deviation, "bb_lower": mean("close", 20) - 2 * deviation,
        "volume_ratio": F.col("volume") / mean("volume", 25), "high_52w": _full(F.max("close").over(_last(252, by, order)), 252, by, order), "low_52w": _full(F.min("close").over(_last(252, by, order)), 252, by, order),
        "change_pct": (F.col("close") / before - 1) * 100,
    })


#: Rows of a series that are summed in one piece; powers of a decay stay within a double's range over so many.
_PIECE = 512


def in_pieces(rows: DataFrame, by: str, order: str, span: Column | None = None) -> DataFrame:
    """rows with _piece and _j: each series cut into pieces of consecutive rows, and a row's place in its piece. Rows are dealt out by series
    and span (a column that grows with the order; for days the years), so a long series is spread over tasks."""
    if span is None:
        span = F.year(order) if dict(rows.dtypes)[order] in ("date", "timestamp", "timestamp_ntz") else F.lit(0)
    place = F.row_number().over(Window.partitionBy(by, "_span").orderBy(order)) - 1
    numbered = rows.withColumn("_span", span).withColumn("_k", place)
    return numbered.withColumns({"_piece": F.struct(F.col("_span").alias("span"), F.floor(F.col("_k") / _PIECE).alias("part")), "_j": F.col("_k") % _PIECE}).drop("_span", "_k")


def averages(pieces: DataFrame, by: str, wanted: list[tuple[str, float, str]]) -> DataFrame:
    """pieces (see in_pieces) with averages (value, decay, name), each of which begins with the first value and then moves by 1 - decay
    towards every other: within a piece a sum of decayed values, to which comes what the piece before hands on, decayed too. What pieces
    hand on is folded over one short list for each series. Rows without a value have no average and don't move it."""
    until = Window.partitionBy(by, "_piece").orderBy("_j").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows, told = pieces, []
    for k, (value, decay, _) in enumerate(wanted):
        n, v = F.col(f"_n{k}"), F.col(value)
        rows = rows.withColumn(f"_n{k}", F.count(value).over(until))
        rows = rows.withColumn(f"_sum{k}", F.pow(F.lit(decay), n) * F.sum(v * (1 - decay) * F.pow(F.lit(decay), -n)).over(until))
        at = F.when(v.isNotNull(), F.col("_j"))
        told += [F.max_by(f"_sum{k}", at).alias(f"sum{k}"), F.max(n).alias(f"n{k}"), F.min_by(v, at).alias(f"first{k}")]
    each = rows.groupBy(by, "_piece").agg(*told).groupBy(by).agg(F.array_sort(F.collect_list(F.struct("_piece", *[f"{x}{k}" for k in range(len(wanted)) for x in ("sum", "n", "first")]))).alias("p"))

    def carried(k: int, decay: float):
        def add(done, x):
            got = F.coalesce(done["now"], x[f"first{k}"])
            after = F.when(x[f"n{k}"] > 0, x[f"sum{k}"] + got * F.pow(F.lit(decay), x[f"n{k}"])).otherwise(done["now"])
            return F.struct(F.concat(done["all"], F.array(got)).alias("all"), after.alias("now"))

        start = F.struct(F.array().cast("array<double>").alias("all"), F.lit(None).cast("double").alias("now"))
        return F.aggregate("p", start, add)["all"]

    handed = each.select(by, F.inline(F.arrays_zip(F.col("p._piece").alias("_piece"), *[carried(k, decay).alias(f"_carry{k}") for k, (_, decay, _) in enumerate(wanted)])))
    out = rows.join(handed, [by, "_piece"])
    for k, (value, decay, name) in enumerate(wanted):
        out = out.withColumn(name, F.when(F.col(value).isNotNull(), F.col(f"_sum{k}") + F.col(f"_carry{k}") * F.pow(F.lit(decay), F.col(f"_n{k}")))).drop(f"_n{k}", f"_sum{k}", f"_carry{k}")
    return out


def previous(pieces: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """pieces with the value of the row before, over the ends of pieces."""
    own = F.lag(value).over(Window.partitionBy(by, "_piece").orderBy("_j"))
    ends = pieces.groupBy(by, "_piece").agg(F.max_by(value, "_j").alias("last"))
    before = ends.select(by, "_piece", F.lag("last").over(Window.partitionBy(by).orderBy("_piece")).alias("_before"))
    return pieces.withColumn("_own", own).join(before, [by, "_piece"]).withColumn(name, F.when(F.col("_j") == 0, F.col("_before")).otherwise(F.col("_own"))).drop("_own", "_before")


def smoothed(prices: DataFrame, by: str = "code", order: str = "data_date", span: Column | None = None) -> DataFrame:
    """by, order, macd, macd_signal, rsi14, and atr14 where prices have high and low: averages that depend on all days before. The signal is
    an average of an average, so it is scanned after that; an index of nothing but equal closes is null."""
    days = previous(in_pieces(prices.filter("close IS NOT NULL"), by, order, span), by, "close", "_last")
    move = F.col("close") - F.col("_last")
    days = days.withColumns({"_up": F.greatest(move, F.lit(0.0)), "_down": F.greatest(-move, F.lit(0.0))})
    days = days.withColumns({"_up": F.when(F.col("_last").isNotNull(), F.col("_up")), "_down": F.when(F.col("_last").isNotNull(), F.col("_down"))})
    ranged = {"high", "low"} <= set(prices.columns)
    if ranged:
        true_range = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("_last")), F.abs(F.col("low") - F.col("_last")))
        days = days.withColumn("_range", true_range)
    days = averages(days, by, [("close", 11 / 13, "_fast"), ("close", 25 / 27, "_slow"), ("_up", 13 / 14, "_gain"), ("_down", 13 / 14, "_loss"), *([("_range", 13 / 14, "atr14")] if ranged else [])])
    days = averages(days.withColumn("macd", F.col("_fast") - F.col("_slow")), by, [("macd", 8 / 10, "macd_signal")])
    both = F.col("_gain") + F.col("_loss")
    return days.select(by, order, "macd", "macd_signal", F.when(both != 0, 100 * F.col("_gain") / both).alias("rsi14"), *(["atr14"] if ranged else []))
