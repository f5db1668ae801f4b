"""Numbers, dates, titles and licences as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Licence tags from open to closed; anything else ranks above them.
LICENCE_RANK = {"commercial-ok": 0, "factual-cite": 1, "personal-only": 2}
#: Accounting standards as filings name them, and as records do.
ACCOUNTING_STANDARDS = {"Japan GAAP": "日本基準", "JapanGAAP": "日本基準", "IFRS": "IFRS", "US GAAP": "US-GAAP", "USGAAP": "US-GAAP"}
#: The default licence of each source; what is calculated has none of its own.
SOURCE_LICENCE = {"EDINET": "commercial-ok", "TDnet": "factual-cite", "yfinance": "personal-only", "stooq": "personal-only", "JPX": "personal-only", "日証金": "personal-only"}
#: Content types by a file's ending.
CONTENT_TYPES = {"csv": "text/csv", "html": "text/html", "htm": "text/html", "json": "application/json", "pdf": "application/pdf", "txt": "text/plain", "xml": "text/xml", "zip": "application/zip"}


#: White space of any script.
_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space of any script at the ends."""
    return F.btrim(c, F.lit(_SPACE))


_DIGITS = "[0-9](?:_?[0-9])*+"
_NUMBER = rf"^[△▲()\s]*+([+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?)[△▲()\s]*+$"


def parse_numeric(c: Column) -> Column:
    """Commas dropped; a leading triangle or bracket is minus, if it isn't a note's; dashes, notes and what isn't a number are null, as is
    one beyond a double's range. Plain numbers are cast as they are; only others go through the pattern."""
    text = strip(F.translate(c, "０１２３４５６７８９,", "0123456789"))
    minus = F.substring(text, 1, 2).rlike("^(?:[△▲]|[(](?!注))")
    value = F.replace(F.regexp_extract(text, _NUMBER, 1), F.lit("_"), F.lit("")).try_cast("double")
    number = F.when(text.rlike("^[0-9.eE+-]+$"), text.try_cast("double")).otherwise(value * F.when(minus, -1.0).otherwise(1.0))
    return F.nullif(F.nullif(number, F.lit(float("inf"))), F.lit(float("-inf")))


def round_half_even(c: Column, places: int) -> Column:
    """The double itself rounded, ties to even: not its shortest decimal form, as round() and bround() do."""
    return F.call_function("format_number", c, F.lit("0." + "0" * places)).cast("double")


def lending_ratio(loan: Column, stock: Column) -> Column:
    """Null where either side is 0 or unknown."""
    return F.when((loan != 0) & (stock != 0), round_half_even(loan / stock, 4))


def as_percent(c: Column) -> Column:
    return F.when(F.abs(c) <= 1, c * 100).otherwise(c)


def parse_day(c: Column) -> Column:
    return F.coalesce(F.try_to_date(c, "yyyy/MM/dd"), F.try_to_date(c, "yyyyMMdd"))


def interim_type(kind: Column, period_end: Column) -> Column:
    """From the mid-2024 rule on the second quarter is the interim report."""
    return F.when((kind == "2Q") & (period_end >= F.lit("2024-06-30").cast("date")), "中間").otherwise(kind)


def weekend_days(start: Column, end: Column) -> Column:
    """Saturdays and Sundays in (start, end]: two for each whole week, and those of the days left."""
    days = F.greatest(F.datediff(end, start), F.lit(0))
    left, first = days % 7, F.weekday(start) + 1  # the days left are numbered first, first + 1 ... from Monday = 0
    partly = F.greatest(F.least(first + left, F.lit(7)) - F.greatest(first, F.lit(5)), F.lit(0)) + F.greatest(F.least(first + left - 7, F.lit(7)) - 5, F.lit(0))
    return (F.floor(days / 7) * 2 + partly).cast("int")


def add_business_days(start: Column, n: Column | int) -> Column:
    """n weekdays on; 0 leaves the day as it is, whatever it is. From a weekend, counting begins with Monday."""
    n, day = F.lit(n) if isinstance(n, int) else n, F.weekday(start)
    weeks = F.floor((F.least(day, F.lit(4)) + n) / 5)
    return F.when(n > 0, F.date_add(start, (F.least(F.lit(0), 4 - day) + n + 2 * weeks).cast("int"))).otherwise(start)


def market_day(at: Column, zone: str = "Asia/Tokyo") -> Column:
    """The day of an instant in the market's zone, whatever the session's is."""
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit(zone), at.cast("timestamp_ntz")))


def market_midnight(day: Column, zone: str = "Asia/Tokyo") -> Column:
    """The instant at which a day begins in the market's zone."""
    return F.convert_timezone(F.lit(zone), F.current_timezone(), day.cast("timestamp_ntz")).cast("timestamp")


def elapsed_hours(start: Column, end: Column, business_days: Column | bool = True) -> Column:
    """Hours from start to end, 0 at least; on business days without 24 for each weekend day between their market days."""
    hours = (F.unix_micros(end) - F.unix_micros(start)) / 3.6e9
    off = F.when(F.lit(business_days) if isinstance(business_days, bool) else business_days, 24.0 * weekend_days(market_day(start), market_day(end))).otherwise(0.0)
    return F.greatest(F.lit(0.0), hours - off)


def elapsed_business_hours(start: Column, end: Column) -> Column:
    return elapsed_hours(start, end)


def due_from(data_date: Column, lag_days: Column, epoch: Column) -> Column:
    """Where age begins: midnight of the market after the data's own date and its lag in business days, else the epoch, else null.
    An epoch of 0 is unknown."""
    return F.coalesce(market_midnight(add_business_days(data_date, lag_days)), F.when(epoch != 0, F.timestamp_seconds(epoch)))


def default_target_date(now: Column, late_hour: int = 21) -> Column:
    """The day a run works on: today from the late hour of the market on, yesterday before it."""
    local = F.convert_timezone(F.current_timezone(), F.lit("Asia/Tokyo"), now.cast("timestamp_ntz"))
    return F.date_sub(F.to_date(local), F.when(F.hour(local) >= late_hour, 0).otherwise(1))


def within_market_day(at: Column, day: Column) -> Column:
    """Whether an instant lies in the half-open day of the market."""
    return (at >= market_midnight(day)) & (at < market_midnight(F.date_add(day, 1)))


def epoch_day(epoch: Column) -> Column:
    return market_day(F.timestamp_seconds(epoch))


def declared_epoch(day: Column) -> Column:
    """The epoch of a declared day, at midnight UTC; null for what isn't a day."""
    return F.unix_date(F.try_to_date(day, "yyyy-MM-dd")).cast("long") * 86400


def coerce_epoch(c: Column) -> Column:
    """Epoch seconds of a text: a number loses its fraction, a time in ISO form without a zone is the market's; else null."""
    text = strip(c)
    number = F.when(text.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double")).cast("long")
    iso = F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"), text)
    zoned = F.when(iso.rlike("(Z|[+-][0-9]{2}:[0-9]{2})$") & (F.length(iso) > 10), iso.try_cast("timestamp"))
    plain = F.when(zoned.isNull(), F.convert_timezone(F.lit("Asia/Tokyo"), F.lit("UTC"), iso.try_cast("timestamp_ntz")))
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), plain)
    return F.coalesce(number, F.unix_seconds(zoned), seconds)


def submit_time(c: Column) -> Column:
    """The instant of a submission, given in market time with or without seconds."""
    local = F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm")))
    return F.convert_timezone(F.lit("Asia/Tokyo"), F.current_timezone(), local.cast("timestamp_ntz")).cast("timestamp")


def as_of_day(c: Column) -> Column:
    """The day in a heading of the form YYYY年MM月DD日現在."""
    parts = [F.regexp_extract(c, "([0-9]{4})年([0-9]{2})月([0-9]{2})日現在", k) for k in (1, 2, 3)]
    return F.try_to_date(F.concat_ws("-", *parts), "yyyy-MM-dd")


def same_instant(a: Column, b: Column) -> Column:
    """Whether two times in ISO form are one instant: equal as text, or equal whatever their offsets; unreadable ones aren't."""
    return F.coalesce(a == b, F.lit(False)) | F.coalesce(coerce_epoch(a) == coerce_epoch(b), F.lit(False))


def accounting_standard(c: Column) -> Column:
    text = strip(c)
    return F.coalesce(F.create_map(*[F.lit(x) for pair in ACCOUNTING_STANDARDS.items() for x in pair])[text], text)


def judge(age: Column, rows: Column, green, yellow, exempt: Column | None = None) -> Column:
    """unknown without a threshold or exemption, then red for no rows, unknown for uncounted ones, not_refreshed for the exempt,
    then by age; a threshold itself still counts as kept."""
    green, yellow = (F.lit(x) if isinstance(x, int | float) else x for x in (green, yellow))
    free = F.coalesce(exempt, F.lit(False)) if exempt is not None else F.lit(False)
    by_age = F.when(age.isNull(), "unknown").when(age <= green, "green").when(age <= yellow, "yellow").otherwise("red")
    return F.when(green.isNull() & ~free, "unknown").when(rows == 0, "red").when(rows.isNull(), "unknown").when(free, "not_refreshed").otherwise(by_age)


def licence_rank(tag: Column) -> Column:
    out = F.lit(3)
    for name, rank in LICENCE_RANK.items():
        out = F.when(tag == name, rank).otherwise(out)
    return out


def source_licence(source: Column) -> Column:
    """The default tag of a source. What is calculated takes the strictest of its inputs and fails here; so does an unknown source."""
    known = F.create_map(*[F.lit(x) for pair in SOURCE_LICENCE.items() for x in pair])[source]
    return F.when(known.isNotNull(), known).otherwise(F.raise_error(F.concat(F.lit("no default licence for source "), F.coalesce(source, F.lit("null")))))


def strictest(tag: str) -> Column:
    """The strictest licence of a group; a group without rows is an error."""
    best = F.max_by(tag, licence_rank(F.col(tag)))
    return F.when(F.count(F.lit(1)) > 0, best).otherwise(F.raise_error(F.lit("no licence to inherit from")))


def stricter(incoming: Column, existing: Column) -> Column:
    return F.when(licence_rank(incoming) >= licence_rank(existing), incoming).otherwise(existing)


def is_publishable(tag: Column, metadata: bool = False) -> Column:
    return F.coalesce(tag.isin(*(["commercial-ok", "factual-cite"] if metadata else ["commercial-ok"])), F.lit(False))


def consolidated_of(context: Column) -> Column:
    return F.when(context.contains("NonConsolidatedMember"), "単体").when(context.contains("ConsolidatedMember"), "連結").when(context.rlike("^(Current|Prior[0-9]*|Interim)[A-Za-z]*(Duration|Instant)$"), "連結").otherwise("")


def meaningful_text(c: Column, least: int = 50) -> Column:
    return F.length(F.regexp_replace(c, r"\s+", "")) >= least


def clip(c: Column, most: int = 2000, suffix: str = "…(省略)") -> Column:
    """At most so many characters, the last of a longer text being the suffix after the first most - 10."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 10), F.lit(suffix))).otherwise(c)


def record_title(code: Column, period_end: Column, kind: Column) -> Column:
    return F.concat(code, F.lit(" "), F.date_format(period_end, "yyyy/MM"), F.lit("期 "), kind)


def content_type(ext: Column) -> Column:
    """The content type of a file's ending, as the store records it."""
    return F.coalesce(F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])[F.lower(F.regexp_replace(ext, "^[.]+", ""))], F.lit("application/octet-stream"))
