"""Lists of disclosures and of listed companies to typed records."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.codes import source_code_to_ticker
from tidewright.functions.titles import DOCUMENT_LABELS, LARGE_HOLDINGS, action_attributes, classify_title, direct_url, document_id, document_label, split_terms
from tidewright.functions.values import as_of_day, market_day, strip, submit_time
from tidewright.operators.master import code_of_issuer
from tidewright.sources.tidy import per_row

#: Names that the payloads and files use.
_DOCUMENT = "struct<docID:string,secCode:string,docTypeCode:string,docDescription:string,submitDateTime:string,xbrlFlag:string,issuerEdinetCode:string>"
_ITEM = "id:string,company_code:string,pubdate:string,title:string,document_url:string,url_xbrl:string"
_CODE_LIST = {"edinet_code": "ＥＤＩＮＥＴコード", "listed": "上場区分", "name": "提出者名", "sector": "提出者業種", "code": "証券コード"}
#: The primary list gives at most so many documents; beyond it the pages are asked too.
LIST_LIMIT = 1000


def list_errors(payloads: DataFrame, json_col: str = "payload") -> DataFrame:
    """payloads with the reason for which a daily list isn't one, else null: the answer's own status, or no list in it."""
    parsed = F.from_json(json_col, f"metadata struct<status:string>, results array<{_DOCUMENT}>")
    return payloads.withColumn("error", F.when(~parsed["metadata"]["status"].eqNullSafe(F.lit("200")), F.concat(F.lit("status "), F.coalesce(parsed["metadata"]["status"], F.lit("missing")))).when(parsed["results"].isNull(), "no list of results"))


def list_documents(payloads: DataFrame, json_col: str = "payload") -> DataFrame:
    """The entries of daily lists with `ord`; a payload that isn't such a list is an error."""
    parsed = F.from_json(json_col, f"metadata struct<status:string>, results array<{_DOCUMENT}>")
    checked = list_errors(payloads, json_col).select(F.when(F.col("error").isNull(), parsed["results"]).otherwise(F.raise_error(F.concat(F.lit("not a document list: "), "error"))).alias("results"))
    return checked.select(F.posexplode("results").alias("ord", "d")).select("ord", "d.*")


def is_target() -> Column:
    """A document type that is collected, from a company that can be told: by its code, or for large holdings by the issuer's."""
    filled = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    kind = F.col("docTypeCode")
    return F.coalesce(kind.isin(*DOCUMENT_LABELS), F.lit(False)) & (filled("secCode") | (kind.isin(*LARGE_HOLDINGS) & filled("issuerEdinetCode")))


def disclosures_of(documents: DataFrame, base_url: str) -> DataFrame:
    """Typed records of list entries; an entry without an id or a time of submission gives none."""
    at = submit_time(F.trim("submitDateTime"))
    rows = documents.withColumns({"doc_id": F.trim("docID"), "disclosed_at": at}).filter((F.col("doc_id") != "") & F.col("disclosed_at").isNotNull())
    return rows.select(
        "doc_id", F.coalesce(F.trim("docDescription"), F.lit("")).alias("title"), "disclosed_at", source_code_to_ticker(F.col("secCode")).alias("code"), document_label(F.col("docTypeCode")).alias("doc_type"),
        F.concat(F.lit(f"{base_url}/documents/"), "doc_id").alias("source_url"), F.coalesce(F.col("xbrlFlag") == "1", F.lit(False)).alias("has_xbrl"), market_day(F.col("disclosed_at")).alias("data_date"), "issuerEdinetCode",
    )


def with_issuer_codes(records: DataFrame, master: DataFrame) -> DataFrame:
    """records, whose missing codes come from the master (edinet_code, code, ord) by the issuer's, of several the last by ord; else empty."""
    known = code_of_issuer(master).select(F.col("edinet_code").alias("issuerEdinetCode"), F.col("code").alias("_issuer"))
    return records.join(known, "issuerEdinetCode", "left").withColumn("code", F.coalesce("code", "_issuer", F.lit(""))).drop("_issuer")


def _typed(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, title, disclosed_at, company_code, source_url, has_xbrl, data_date) as records with label and attributes."""
    labelled = rows.withColumn("_terms", split_terms(F.col("title"))).withColumn("doc_type", classify_title(F.col("title"), F.col("_terms")))
    return labelled.withColumn("_a", action_attributes(F.col("title"), F.col("doc_type"), F.col("_terms"))).select(
        "doc_id", "title", "disclosed_at", source_code_to_ticker(F.col("company_code")).alias("code"), "doc_type", "source_url", "has_xbrl", "data_date",
        F.col("_a.ratio").alias("split_ratio"), F.col("_a.factor").alias("split_factor"), F.col("_a.effective_date").alias("effective_date"),
    )


def _items(payloads: DataFrame, json_col: str) -> DataFrame:
    parsed = F.from_json(json_col, f"items array<struct<Tdnet:struct<{_ITEM}>,{_ITEM}>>")
    names = [c.split(":")[0] for c in _ITEM.split(",")]
    fields = [F.when(F.col("i.Tdnet").isNotNull(), F.col(f"i.Tdnet.{c}")).otherwise(F.col(f"i.{c}")).alias(c) for c in names]
    return payloads.select(F.posexplode(parsed["items"]).alias("ord", "i")).select("ord", *fields)


def timely_disclosures(payloads: DataFrame, json_col: str = "payload") -> DataFrame:
    """Typed records of timely disclosure lists, whose items may be wrapped; the id is the PDF's name, else the service's own. Items
    without a time, or without either id, give none."""
    rows = _items(payloads, json_col).filter(F.coalesce(F.col("pubdate") != "", F.lit(False)))
    url = F.when(F.col("document_url") != "", direct_url(F.col("document_url")))
    own = F.coalesce(document_id(url), F.when(F.col("id") != "", F.concat(F.lit("yanoshin-"), "id")))
    at = submit_time(F.col("pubdate"))
    rows = rows.select(own.alias("doc_id"), strip(F.coalesce("title", F.lit(""))).alias("title"), at.alias("disclosed_at"), "company_code", url.alias("source_url"), F.coalesce(F.col("url_xbrl") != "", F.lit(False)).alias("has_xbrl"), market_day(at).alias("data_date"))
    return _typed(rows.filter("doc_id is not null"))


def xbrl_links(payloads: DataFrame, json_col: str = "payload") -> DataFrame:
    """doc_id and the link to its XBRL file, the last one of each id; documents without such a link are left out."""
    rows = _items(payloads, json_col).select("ord", document_id(F.col("document_url")).alias("doc_id"), F.when(F.col("url_xbrl") != "", direct_url(F.col("url_xbrl"))).alias("xbrl_url"))
    return rows.filter("doc_id is not null and xbrl_url is not null").groupBy("doc_id").agg(F.max_by("xbrl_url", "ord").alias("xbrl_url"))


class _ListPage(HTMLParser):
    """The rows of the main list table: for each its cells as [class, text, links, text of the first link]."""

    def __init__(self):
        super().__init__()
        self.rows, self.depth, self.cell, self.linked = [], 0, None, False

    def handle_starttag(self, tag, attributes):
        attributes = dict(attributes)
        if tag == "table" and (self.depth or attributes.get("id") == "main-list-table"):
            self.depth += 1
        elif self.depth and tag == "tr":
            self.rows.append([])
        elif self.depth and tag == "td" and self.rows:
            self.cell, self.linked = [attributes.get("class") or "", "", [], ""], False
            self.rows[-1].append(self.cell)
        elif self.cell is not None and tag == "a":
            self.linked = not self.cell[2]
            self.cell[2].append((attributes.get("href") or "").strip())

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
        elif tag == "td":
            self.cell = None
        elif tag == "a":
            self.linked = False

    def handle_data(self, data):
        if self.cell is not None:
            self.cell[1] += data
            self.cell[3] += data * self.linked


def _list_rows(html: str, base_url: str) -> list[tuple]:
    """(ord, time, company_code, title, url, has_xbrl) of a page's rows that have a PDF link and a time."""
    page, out = _ListPage(), []
    page.feed(html)
    for cells in page.rows:
        cell = lambda kind, cells=cells: next((c for c in cells if kind in c[0]), ["", "", [], ""])
        time, title = cell("kjTime")[1].strip(), cell("kjTitle")
        link = title[2][0] if title[2] else ""
        if link.lower().endswith(".pdf") and re.fullmatch(r"([01]?\d|2[0-3]):[0-5]\d", time):
            out.append((len(out), time, cell("kjCode")[1].strip(), title[3].strip(), urljoin(base_url, link), bool(cell("kjXbrl")[2])))
    return out


def list_pages(pages: DataFrame, base_url: str) -> DataFrame:
    """pages (day, html) -> typed records of their list tables."""
    schema = T.StructType([pages.schema["day"], *T._parse_datatype_string("ord long, time string, company_code string, title string, source_url string, has_xbrl boolean").fields])
    rows = per_row(pages, ["day", "html"], schema, lambda day, html: [(day, *r) for r in _list_rows(html or "", base_url)])
    at = submit_time(F.concat_ws(" ", F.date_format("day", "yyyy-MM-dd"), F.lpad("time", 5, "0")))
    return _typed(rows.select(document_id(F.col("source_url")).alias("doc_id"), "title", at.alias("disclosed_at"), "company_code", "source_url", "has_xbrl", F.col("day").alias("data_date")))


def page_numbers(pages: DataFrame, most: int = 40) -> DataFrame:
    """day, page: the pages of a day that its pages link to, up to the bound."""
    links = F.regexp_extract_all("html", F.lit(r"I_list_(\d{3}_\d{8})[.]html"), 1)
    found = pages.select("day", F.explode(links).alias("l")).select("day", F.substring("l", 1, 3).cast("int").alias("page"), F.substring("l", 5, 8).alias("of"))
    return found.filter((F.col("of") == F.date_format("day", "yyyyMMdd")) & (F.col("page") <= most)).select("day", "page").distinct()


def with_unseen(primary: DataFrame, fallback: DataFrame, limit: int = LIST_LIMIT) -> DataFrame:
    """The primary list, with the fallback's documents that it lacks on days when it is full. A day without a primary list, as
    after an error, is the fallback's alone."""
    full = primary.groupBy("data_date").agg((F.count(F.lit(1)) < limit).alias("_whole")).filter("_whole").select("data_date")
    unseen = fallback.join(full, "data_date", "left_anti").join(primary.select("doc_id"), "doc_id", "left_anti")
    return primary.unionByName(unseen)


def financial_reports(records: DataFrame, links: DataFrame) -> DataFrame:
    """Earnings reports with XBRL whose link is known."""
    return records.filter("doc_type = '短信' and has_xbrl").join(links.select("doc_id"), "doc_id", "left_semi")


def _listed(content: bytes) -> list[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = sorted(n for n in z.namelist() if n.lower().endswith(".csv"))
        if not names:
            raise ValueError("no CSV in the code list")
        rows = list(csv.reader(io.StringIO(z.read(names[0]).decode("cp932"))))
    if len(rows) < 2 or not set(_CODE_LIST.values()) <= set(rows[1]):
        raise ValueError("the code list has other columns")
    at = [rows[1].index(h) for h in _CODE_LIST.values()]
    return [(k, ",".join(rows[0]), *[r[i] for i in at]) for k, r in enumerate(rows[2:]) if len(r) > max(at)]


def code_list(files: DataFrame) -> DataFrame:
    """files (content: the zip) -> the listed companies with a valid code: ord, code, name, edinet_code, sector33, listed, status,
    data_date of the list."""
    schema = T._parse_datatype_string("ord long, heading string, edinet_code string, listed string, name string, sector string, code string")
    rows = per_row(files, ["content"], schema, lambda content: _listed(content))
    kept = rows.filter(F.trim("listed") == "上場").withColumn("code", source_code_to_ticker(F.col("code"))).filter("code is not null")
    blank = lambda c: F.nullif(strip(F.col(c)), F.lit(""))
    return kept.select("ord", "code", strip(F.col("name")).alias("name"), blank("edinet_code").alias("edinet_code"), blank("sector").alias("sector33"), F.lit(True).alias("listed"), F.lit("上場").alias("status"), as_of_day(F.col("heading")).alias("data_date"))


def code_list_text(files: DataFrame) -> DataFrame:
    """files (content: the zip) -> the CSV in UTF-8, with nothing else changed."""

    def text(content):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            return [(z.read(sorted(n for n in z.namelist() if n.lower().endswith(".csv"))[0]).decode("cp932"),)]

    return per_row(files, ["content"], T._parse_datatype_string("text string"), text)

