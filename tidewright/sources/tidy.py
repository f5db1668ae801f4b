"""Raw payloads to tidy all-string tables. Zip, XML and HTML need Python; each file is one row, parsed where it lies."""

from __future__ import annotations

import csv
import html
import io
import json
import lzma
import re
import zipfile
import zlib
from collections.abc import Callable
from decimal import Decimal, InvalidOperation
from html.parser import HTMLParser
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

TIDY = ["code", "doc_id", "element", "context_ref", "period_start", "period_end", "instant_date", "consolidated", "unit", "value"]
_XBRLI = "{http://www.xbrl.org/2003/instance}"
#: The namespaces of inline XBRL, and the columns that a fact table in CSV form must have.
_INLINE = ("{http://www.xbrl.org/2008/inlineXBRL}", "{http://www.xbrl.org/2013/inlineXBRL}")
_CSV = {"要素ID": "element", "コンテキストID": "context_ref", "連結・個別": "consolidated", "ユニットID": "unit", "単位": "unit", "値": "value"}
_NAMED = re.compile(r"^(Current|Prior\d*|Interim)[A-Za-z]*(Duration|Instant)$")
_NIL = "{http://www.w3.org/2001/XMLSchema-instance}nil"
_PREFIX = "prefix:"  # where an element's own prefix is kept
#: States of a conversion: done, failed, not applicable.
DONE, FAILED, NOT_APPLICABLE = "完了", "失敗", "対象外"


def rows_in_parts(batch: pa.RecordBatch, rows: int = 200):
    """The rows of a batch as tuples, of which no more than so many are held at once."""
    for at in range(0, batch.num_rows, rows):
        yield from zip(*[c.to_pylist() for c in batch.slice(at, rows).columns], strict=True)


def per_row(df: DataFrame, columns: list[str], schema: T.StructType, rows_of: Callable[..., list]) -> DataFrame:
    """mapInArrow over the columns: rows_of gets a row's values and gives tuples of the schema, 1000 at a time at most. Of a batch, however
    long, a few rows at a time are turned into Python's values."""
    fields = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out = []
            for values in rows_in_parts(batch):
                for row in rows_of(*values):
                    out.append(dict(zip(fields.names, row, strict=True)))
                    if len(out) == 1000:
                        yield pa.RecordBatch.from_pylist(out, schema=fields)
                        out = []
            yield pa.RecordBatch.from_pylist(out, schema=fields)

    return df.select(*columns).mapInArrow(run, schema)


def _scope(context: str) -> str:
    if "NonConsolidatedMember" in context:
        return "単体"
    return "連結" if "ConsolidatedMember" in context or _NAMED.match(context) else ""


def _last(name: str) -> str:
    return name.rsplit(":", 1)[-1].strip()


def _named(name: str) -> str:
    """A name as the parser gives it (namespace, local name, prefix) in the form of element trees."""
    parts = name.split("\n")
    return name if len(parts) == 1 else f"{{{parts[0]}}}{parts[1]}"


def parse_xml(data: bytes):
    """The root of a document; elements keep their prefix, and entities that only HTML declares are known."""
    tree = ElementTree.TreeBuilder()
    parser = expat.ParserCreate(namespace_separator="\n")
    parser.namespace_prefixes = True
    parser.buffer_text = True
    parser.UseForeignDTD(True)
    parser.ExternalEntityRefHandler = lambda *_: 1

    def start(name, attributes):
        own = {_named(k): v for k, v in attributes.items()}
        tree.start(_named(name), own | {_PREFIX: (name.split("\n") + ["", ""])[2]})

    parser.StartElementHandler, parser.EndElementHandler = start, lambda name: tree.end(_named(name))
    parser.CharacterDataHandler = tree.data
    parser.SkippedEntityHandler = lambda name, parameter: None if parameter else tree.data(html.unescape(f"&{name};"))
    parser.Parse(data, True)
    return tree.close()


class _Forgiving(HTMLParser):
    """A document that isn't well formed, as a tree: what isn't closed closes with its parent."""

    #: Names whose capitals HTML parsing loses.
    _CASED = {x.lower(): x for x in ("nonFraction", "nonNumeric", "startDate", "endDate", "contextRef", "unitRef", "unitNumerator", "unitDenominator")}

    def __init__(self):
        super().__init__()
        self.tree, self.open, self.spaces = ElementTree.TreeBuilder(), [], {}
        self.tree.start("document", {})

    def _name(self, name: str) -> str:
        prefix, _, local = name.rpartition(":")
        local = self._CASED.get(local, local)
        return f"{{{self.spaces[prefix]}}}{local}" if prefix in self.spaces else local

    def handle_starttag(self, tag, attributes):
        self.spaces |= {k[6:]: v for k, v in attributes if k.startswith("xmlns:")}
        self.tree.start(self._name(tag), {self._name(k): v or "" for k, v in attributes} | {_PREFIX: tag.rpartition(":")[0]})
        self.open.append(tag)

    def handle_startendtag(self, tag, attributes):
        self.handle_starttag(tag, attributes)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        while tag in self.open:
            last = self.open.pop()
            self.tree.end(self._name(last))
            if last == tag:
                break

    def handle_data(self, data):
        self.tree.data(data)

    def root(self, text: str):
        self.feed(text)
        self.close()
        while self.open:
            self.tree.end(self._name(self.open.pop()))
        self.tree.end("document")
        return self.tree.close()


def _periods(contexts) -> dict[str, tuple[str, str, str]]:
    text = lambda x, n: (x.findtext(f"{_XBRLI}period/{_XBRLI}{n}") or "").strip()
    return {c.get("id"): (text(c, "startDate"), text(c, "endDate"), text(c, "instant")) for c in contexts if c.get("id")}


def _units(units, divided: bool) -> dict[str, str]:
    """Units by id, without prefixes; a quotient as numerator/denominator where asked for, else empty."""
    out = {}
    for u in units:
        measure = lambda path, u=u: _last(u.findtext(path) or "")
        if divided and u.find(f"{_XBRLI}divide") is not None:
            part = lambda n, m=measure: m(f"{_XBRLI}divide/{_XBRLI}{n}/{_XBRLI}measure")
            out[u.get("id")] = f"{part('unitNumerator')}/{part('unitDenominator')}"
        else:
            out[u.get("id")] = measure(f"{_XBRLI}measure")
    return out


def decode_inline(text: str, scale: str | None, sign: str | None) -> str:
    """A displayed number as plain digits: separators off, scaled, signed, without trailing zeros; empty if it isn't one."""
    text = re.sub("[,，]", "", text.strip())
    if text in ("", "-", "－", "―", "—"):
        return ""
    try:
        value = Decimal(text).scaleb(int(scale or 0))
        return format((-value if sign == "-" else value).normalize(), "f")
    except (InvalidOperation, ValueError):
        return ""


def _fact(element: str, context: str, periods, unit: str, value: str) -> dict:
    start, end, instant = periods.get(context, ("", "", ""))
    return {"element": element, "context_ref": context, "period_start": start, "period_end": end, "instant_date": instant, "consolidated": _scope(context), "unit": unit, "value": value}


def instance_facts(data: bytes) -> list[dict]:
    """Every element with a context outside XBRL's own namespace, with its prefix and its text as it is."""
    root = parse_xml(data)
    periods, units = _periods(root.findall(f"{_XBRLI}context")), _units(root.findall(f"{_XBRLI}unit"), True)
    out = []
    for e in root.iter():
        context = e.get("contextRef")
        if context is None or e.tag.startswith(_XBRLI):
            continue
        name = e.tag.rsplit("}", 1)[-1]
        element = f"{e.get(_PREFIX)}:{name}" if e.get(_PREFIX) else name
        out.append(_fact(element, context, periods, units.get(e.get("unitRef"), ""), "" if e.get(_NIL) == "true" else e.text or ""))
    return out


def inline_facts(data: bytes) -> list[dict]:
    """By namespace, then numbers before texts, each in document order; facts without a name or context are left out. A page that
    isn't well formed is read as far as it goes."""
    try:
        root = parse_xml(data)
    except expat.ExpatError:
        root = _Forgiving().root(sniff(data))
    periods, units = _periods(root.iter(f"{_XBRLI}context")), _units(root.iter(f"{_XBRLI}unit"), False)
    out = []
    for ns in _INLINE:
        for tag in ("nonFraction", "nonNumeric"):
            for e in root.iter(f"{ns}{tag}"):
                if not e.get("name") or not e.get("contextRef"):
                    continue
                text = "".join(e.itertext())
                value = "" if e.get(_NIL) == "true" else decode_inline(text, e.get("scale"), e.get("sign")) if tag == "nonFraction" else text.strip()
                out.append(_fact(e.get("name"), e.get("contextRef"), periods, units.get(e.get("unitRef"), ""), value))
    return out


#: What a damaged, encrypted or unknown kind of member raises when it is read.
_BROKEN = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, RuntimeError)
#: Fields of delimited files: a block of text may be as long as its file.
csv.field_size_limit(1 << 31)


def zip_facts(data: bytes) -> list[dict]:
    """Facts of all instances in a zip by name; of inline documents only if there is no instance. Bad members are skipped."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for ending, parse in ((".xbrl", instance_facts), ("-ixbrl.htm", inline_facts)):
            if names := sorted(n for n in z.namelist() if n.lower().endswith(ending)):
                out = []
                for n in names:
                    try:
                        out += parse(z.read(n))
                    except (expat.ExpatError, *_BROKEN):
                        continue
                return out
    return []


def sniff(data: bytes) -> str:
    """The text of bytes by byte order mark, NULs, then UTF-8 and the Japanese code page."""
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return data.decode("utf-16")
    if data[:3] == b"\xef\xbb\xbf":
        return data.decode("utf-8-sig")
    if b"\0" in data[:200]:
        return data.decode("utf-16-le")
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("cp932", "replace")


def csv_zip_facts(data: bytes) -> list[dict]:
    """Facts of the tab-separated files in a zip, whose periods stay empty; a file without the needed columns is an error, a member that
    can't be read is skipped."""
    out = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for n in sorted(n for n in z.namelist() if n.lower().endswith(".csv")):
            try:
                text = sniff(z.read(n))
            except _BROKEN:
                continue
            rows = [r for r in csv.reader(io.StringIO(text), delimiter="\t") if any(c.strip() for c in r)]
            header = [h.strip() for h in rows[0]] if rows else []
            if rows and not {"要素ID", "コンテキストID", "値"} <= set(header):
                raise ValueError(f"{n} has columns {header}")
            for r in rows[1:]:
                x = {_CSV[h]: v if h == "値" else v.strip() for h, v in zip(header, r, strict=False) if h in _CSV}
                label = {"連結": "連結", "個別": "単体"}.get(x.get("consolidated", ""), "")
                context = x.get("context_ref", "")
                out.append(_fact(x.get("element", ""), context, {}, x.get("unit", ""), x.get("value", "")) | {"consolidated": label or _scope(context)})
    return out


_PARSERS = {"xbrl": instance_facts, "inline": inline_facts, "zip": zip_facts, "csv": csv_zip_facts}


def facts_of(files: DataFrame, kind: str) -> DataFrame:
    """files (code, doc_id, content) -> tidy facts with `ord`, the state of the conversion and its error: a file that fails gives
    one row with that state and no fact, one without content is not applicable. kind: xbrl, inline, zip or csv."""
    if kind not in _PARSERS:
        raise ValueError(f"{kind} is none of {', '.join(_PARSERS)}")
    parse = _PARSERS[kind]

    def convert(code, doc, content):
        try:
            found, status, error = ([{}], NOT_APPLICABLE, None) if content is None else (parse(content), DONE, None)
        except (ValueError, KeyError, expat.ExpatError, csv.Error, *_BROKEN) as e:
            found, status, error = [{}], FAILED, f"{type(e).__name__}: {e}"
        return [(code, doc, *[x.get(c) for c in TIDY[2:]], i, status, error) for i, x in enumerate(found)]

    schema = T.StructType([T.StructField(c, T.StringType()) for c in TIDY] + T._parse_datatype_string("ord long, status string, error string").fields)
    return per_row(files.select(F.col("code").cast("string"), F.col("doc_id").cast("string"), F.col("content").cast("binary")), ["code", "doc_id", "content"], schema, convert)


def tidy_table(facts: DataFrame) -> DataFrame:
    """The tidy columns in their fixed order, all text, unknown as empty."""
    return facts.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in TIDY])


def json_records(payload: str) -> list[dict[str, str | None]]:
    """Rows of a JSON payload with dotted names and string cells: a list, one of the usual wrappers, or one row."""
    data = json.loads(payload)
    if isinstance(data, dict):
        data = next((data[k] for k in ("results", "items", "data") if isinstance(data.get(k), list)), [data])
    cell = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)

    def flat(x, prefix=""):
        out = {}
        for k, v in x.items():
            out |= flat(v, f"{prefix}{k}.") if isinstance(v, dict) and v else {f"{prefix}{k}": cell(v)}
        return out

    return [flat(x) if isinstance(x, dict) else {"value": cell(x)} for x in (data if isinstance(data, list) else [data])]


def _cell_schema(df: DataFrame, id_col: str) -> T.StructType:
    return T.StructType([df.schema[id_col], *T._parse_datatype_string("row long, name string, value string").fields])


def json_cells(payloads: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """id_col, row, name, value: the cells of every payload; one that isn't JSON gives a row with a null name."""

    def cells(i, text):
        try:
            return [(i, k, n, v) for k, r in enumerate(json_records(text)) for n, v in r.items()]
        except (ValueError, TypeError):
            return [(i, 0, None, None)]

    return per_row(payloads, [id_col, json_col], _cell_schema(payloads, id_col), cells)


def json_line_cells(payloads: DataFrame, id_col: str, lines_col: str) -> DataFrame:
    """id_col, row, name, value: as json_cells, each line that isn't blank being a payload whose rows follow those of the lines
    before; a payload without lines, or with one that isn't JSON, gives a row with a null name."""

    def cells(i, text):
        try:
            rows = [r for line in (text or "").splitlines() if line.strip() for r in json_records(line)]
        except (ValueError, TypeError):
            rows = []
        return [(i, k, n, v) for k, r in enumerate(rows) for n, v in r.items()] or [(i, 0, None, None)]

    return per_row(payloads, [id_col, lines_col], _cell_schema(payloads, id_col), cells)


class _Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found, self.href, self.text = [], None, []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.href, self.text = dict(attrs).get("href"), []

    def handle_data(self, data):
        self.text.append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.href:
            self.found.append((self.href, "".join(self.text).strip()))
            self.href = None


def links_of(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """id_col, ord, href, label of every link of every page, in order."""

    def parse(i, page):
        p = _Links()
        p.feed(page or "")
        return [(i, k, h, t) for k, (h, t) in enumerate(p.found)]

    return per_row(pages, [id_col, html_col], T.StructType([pages.schema[id_col], *T._parse_datatype_string("ord long, href string, label string").fields]), parse)


#: How the bytes of each kind of document begin.
MAGIC = {"zip": "504B0304", "pdf": "25504446"}


def looks_like(content, kind: str):
    """Whether bytes begin as the kind of file they should be: 200 isn't success."""
    head = F.hex(F.substring(content, 1, 4))
    return (F.length(content) >= 100) & F.substring(content, 1, 200).cast("string").contains(",") if kind == "csv" else head == MAGIC[kind]


def body_problem(content, content_type, kind: str):
    """Why a body isn't the document asked for, or null: an error in JSON, nothing at all, or other bytes."""
    said = F.coalesce(F.lower(content_type), F.lit("")).contains("json")
    return F.when(said, "json").when(F.coalesce(F.length(content), F.lit(0)) == 0, "empty").when(~looks_like(content, kind), F.lit(f"not a {kind}"))
