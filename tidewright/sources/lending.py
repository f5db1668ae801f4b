"""Securities-lending CSV files by position."""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.codes import margin_code_to_key
from tidewright.functions.values import lending_ratio, parse_day, strip
from tidewright.sources.tidy import per_row

#: Header rows, least columns and positions of the columns used in each file.
BALANCES = (1, 14, {"d": 0, "code": 2, "name": 3, "ex": 4, "report_type": 6, "loan_new": 7, "loan_repaid": 8, "loan_bal": 9, "stock_new": 10, "stock_repaid": 11, "stock_bal": 12, "net_bal": 13,
                    "loan_amt": 16, "stock_amt": 19, "margin_buy_bal": 21, "margin_sell_bal": 22, "turn_days": 29})
FEES = (4, 14, {"d": 0, "code": 2, "name": 3, "ex": 4, "excess": 8, "max_rate": 9, "today_rate": 10, "prev_rate": 12, "note": 13, "bid_rank": 15})
_TEXT = ("name", "ex", "report_type", "note", "bid_rank")
_DOUBLE = ("turn_days", "max_rate", "today_rate", "prev_rate")
MASK = "*****"


def number(c: Column, kind: str = "double") -> Column:
    """Blank and masked cells, and what isn't a number, are null; whole numbers drop their fraction."""
    text = F.regexp_replace(strip(c), ",", "")
    value = F.when(text.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))
    return value.cast("long") if kind == "long" else value


def lines_of(files: DataFrame) -> DataFrame:
    """files (file, content) of CSV in the Japanese code page -> file, ord, cells, every line of each."""
    schema = T.StructType([files.schema["file"], *T._parse_datatype_string("ord long, cells array<string>").fields])
    read = lambda file, content: [(file, k, r) for k, r in enumerate(csv.reader(io.StringIO(content.decode("cp932", "replace"))))]
    return per_row(files, ["file", "content"], schema, read)


def parse_lines(lines: DataFrame, layout: tuple[int, int, dict[str, int]]) -> DataFrame:
    """lines (file, ord, cells) -> typed rows with a date and a code; header rows and short rows go, columns past a row's end are
    null. code is as the file has it, key is the code that series are kept under, or null."""
    header, least, columns = layout
    rows = lines.filter((F.col("ord") >= header) & (F.size("cells") >= least))
    cell = lambda i: F.get("cells", F.lit(i))
    typed = [(strip(cell(i)) if k in _TEXT else number(cell(i), "double" if k in _DOUBLE else "long")).alias(k) for k, i in columns.items() if k not in ("d", "code")]
    rows = rows.select("file", "ord", parse_day(strip(cell(columns["d"]))).alias("d"), strip(cell(columns["code"])).alias("code"), *typed).filter("d is not null and code <> ''")
    out = rows.withColumn("key", margin_code_to_key(F.col("code")))
    return out.withColumn("ratio", lending_ratio(F.col("loan_bal"), F.col("stock_bal"))) if "loan_bal" in columns else out


def parse_balances(files: DataFrame) -> DataFrame:
    return parse_lines(lines_of(files), BALANCES)


def parse_fees(files: DataFrame) -> DataFrame:
    return parse_lines(lines_of(files), FEES)


def parse_eligibility(files: DataFrame) -> DataFrame:
    """file, ord, d, code, name and a map from exchange to class, by each file's own header in its second row; blank headers and
    dashes, and cells without a number, are left out."""
    lines = lines_of(files)
    header = lines.filter("ord = 1").select("file", F.transform("cells", strip).alias("header"))
    rows = lines.filter((F.col("ord") > 1) & (F.size("cells") >= 4)).join(header, "file")
    width = F.least(F.size("cells"), F.size("header")) - 3
    pairs = F.zip_with(F.slice("header", F.lit(4), width), F.slice("cells", F.lit(4), width), lambda h, v: F.struct(h.alias("h"), number(v, "long").alias("v")))
    kept = F.filter(pairs, lambda p: (p["h"] != "") & (p["h"] != "－") & p["v"].isNotNull())
    last = F.aggregate(kept, F.create_map().cast("map<string,bigint>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, v: k != p["h"]), F.create_map(p["h"], p["v"])))
    out = rows.select("file", "ord", parse_day(strip(F.get("cells", F.lit(0)))).alias("d"), strip(F.get("cells", F.lit(1))).alias("code"), strip(F.get("cells", F.lit(2))).alias("name"), last.alias("classes"))
    return out.filter("d is not null and code <> ''")
