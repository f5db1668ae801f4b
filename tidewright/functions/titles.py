"""Disclosure titles and links as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that deny, delay or undo a listing event, others' events, and other securities' events.
NOT_HAPPENING = ("該当しない", "抵触しない", "非該当", "回避", "おそれ", "可能性", "猶予", "解除", "解消", "見送り", "中止", "撤回")
THIRD_PARTIES = ("子会社", "孫会社", "対象者", "関連会社", "持分法")
OTHER_SECURITIES = ("優先株式", "優先出資", "種類株式", "新株予約権付社債", "優先証券")
#: Document labels, with the words of which a title must have all, in the order in which they are tried after
#: earnings reports, splits and consolidations.
TITLE_RULES = (
    ("上場廃止", ("上場廃止",)),
    ("新規上場", ("新規上場",)),
    ("業績修正", ("業績予想", "修正")),
    ("配当修正", ("配当", "修正")),
    ("優待", ("株主優待",)),
    ("自社株買い", ("自己株式", "取得")),
    ("大量保有", ("大量保有",)),
    ("有報", ("有価証券報告書",)),
    ("四半期報告", ("四半期報告書",)),
)
#: Labels whose titles may name a ratio, and those that may name an effective date.
WITH_RATIO = ("株式分割", "株式併合")
CORPORATE_ACTIONS = (*WITH_RATIO, "上場廃止", "新規上場")
#: Labels of document type codes, and the codes of large holdings, which name their issuer.
DOCUMENT_LABELS = {"120": "有報", "130": "有報", "140": "四半期報告", "150": "四半期報告", "160": "半期報告", "170": "半期報告", "350": "大量保有", "360": "大量保有"}
LARGE_HOLDINGS = ("350", "360")
#: How titles write a ratio and an effective date.
_PAIR = r"(?U)([0-9]+)\s*株?\s*(?:を|につき|対|:)\s*([0-9]+)\s*株"
_RATIO = r"(?U)([0-9]+)\s*[:対]\s*([0-9]+)"
_EFFECTIVE = r"(?U)効力発生日?[\s（(:：・,，。．をはがと/／]{0,6}([0-9]{4})\s*年\s*([0-9]{1,2})\s*月\s*([0-9]{1,2})\s*日"


def _any(title: Column, words) -> Column:
    return title.rlike("|".join(words))


def _all(title: Column, words) -> Column:
    out = F.lit(True)
    for w in words:
        out = out & title.contains(w)
    return out


def _ascii_numbers(title: Column) -> Column:
    return F.translate(title, "０１２３４５６７８９：", "0123456789:")


def split_terms(title: Column) -> Column:
    """struct(ratio, factor) of a share split or consolidation named in a title, else null."""
    text = _ascii_numbers(title)
    part = lambda k: F.when(text.rlike(_PAIR), F.regexp_extract(text, _PAIR, k)).otherwise(F.regexp_extract(text, _RATIO, k)).try_cast("long")
    old, new = part(1), part(2)
    return F.when((old > 0) & (new > 0), F.struct(F.concat_ws(":", old, new).alias("ratio"), (new / old).alias("factor")))


def effective_date(title: Column) -> Column:
    """The date right after the words for taking effect; another date further on isn't taken."""
    year, month, day = (F.regexp_extract(_ascii_numbers(title), _EFFECTIVE, k) for k in (1, 2, 3))
    return F.when(year > "0000", F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd"))


def is_genuine_listing_event(title: Column) -> Column:
    """Not a denial or a step before it, another firm's event (but for becoming a wholly owned subsidiary), another security's, or a
    revision that comes with the event."""
    others = _any(title, THIRD_PARTIES) & ~title.contains("子会社化")
    revision = title.contains("修正") & _any(title, ("に伴う", "に関連"))
    return ~(_any(title, NOT_HAPPENING) | others | _any(title, OTHER_SECURITIES) | revision)


def classify_title(title: Column, terms: Column | None = None) -> Column:
    """The label of a title. A split or consolidation without a ratio gives way to a revision of forecasts or dividends. terms: the
    title's split_terms, if they are known."""
    terms = split_terms(title) if terms is None else terms
    split, merge = title.rlike("株式の?分割"), title.rlike("株式の?併合")
    own = terms.isNotNull() | ~((title.contains("業績予想") | title.contains("配当")) & title.contains("修正"))
    out = F.when(title.contains("決算短信"), "短信").when(split & own, "株式分割").when(merge & own, "株式併合")
    for label, words in TITLE_RULES:
        hit = _all(title, words)
        out = out.when(hit & is_genuine_listing_event(title) if label in ("上場廃止", "新規上場") else hit, label)
    return out.otherwise("その他")


def action_attributes(title: Column, label: Column, terms: Column | None = None) -> Column:
    """struct(ratio, factor, effective_date): the ratio of a split or consolidation, the date of these and of listing events."""
    terms = split_terms(title) if terms is None else terms
    ratio = label.isin(*WITH_RATIO)
    return F.struct(
        F.when(ratio, terms["ratio"]).alias("ratio"), F.when(ratio, terms["factor"]).alias("factor"), F.when(label.isin(*CORPORATE_ACTIONS), effective_date(title)).alias("effective_date")
    )


def direct_url(url: Column) -> Column:
    """A link without the redirecting page before it."""
    return F.regexp_replace(url, r"(?s)^.*?rd\.php\?", "")


def document_id(url: Column) -> Column:
    """The name of the PDF that a link's path ends in, without its ending; null for other links."""
    name = F.regexp_extract(direct_url(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*+:)?+(?://[^/?#]*+)?+(?:[^?#]*/)?([^/?#]+)\.[pP][dD][fF](?:[?#].*)?$", 1)
    return F.nullif(name, F.lit(""))


def document_label(code: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for pair in DOCUMENT_LABELS.items() for x in pair])[F.trim(code)], F.lit("その他"))
