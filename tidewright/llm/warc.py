"""WARC archives: writing segmented records, and reading them back whole.

Writing: a page becomes a response record with an HTTP block in chunked framing, or a revisit record if its payload is
that of a page with a larger id. A block longer than the segment size goes on in continuation records. Records are
rows of a text table whose line separator is the one that ends a record, so the files are gzipped WARC files (each file as a
whole) in any file system that Spark writes to. A revisit names the page that it refers to, its address and date, which the format
allows in place of a record's identifier.

Reading: files are parsed record by record, continuation records are grouped by the identifier of their origin, put in
order of their segment number, held against the total length, and the chunked framing is taken off. A revisit is complete if
the archives have a whole response with its payload.

Defined cases: null html is the empty payload; equal payloads (by SHA-256) below least_bytes are all responses; rows that share the
largest id of a payload are all responses; a null id never owns a payload, and is a revisit only if a row with an id
does; repeated rows stay apart; payloads of any length are kept whole. A record whose segments are missing or don't add up, whose
framing or headers are broken, or that a truncated file cuts off has complete = false and, where its payload can't be told,
null payload columns; identifiers that aren't numbers give null page ids. Null or odd urls are left out or escaped. Empty tables give
empty results. Columns beside the three are not written, whatever their names.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewright.llm.common import HOT_SHARE, checked, stage, text_slices

_END = b"\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    parts = [payload[a : a + size] for a in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """A body without its chunked framing; extensions and trailers are skipped. ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(_END, at)
        size = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise ValueError("a chunk has no size")
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(out)
        if body[at + n : at + n + 2] != _END:
            raise ValueError("a chunk doesn't end where it should")
        out.append(body[at : at + n])
        at += n + 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in headers if v is not None), b"Content-Length: %d" % len(block), b"", b""]
    return _END.join(lines) + block


def _address(url: str | None) -> str | None:
    return re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url) if url else None


def records_of(kind: str, page_id, url: str | None, payload: bytes, refers_to, refers_to_url: str | None, row: int, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """The records of one page, each without the separator that ends it."""
    name = f"urn:x-page:{'' if page_id is None else page_id}:{row}"
    url = _address(url)
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", url), ("X-Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"), ("Content-Type", "application/http; msgtype=response")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if kind == "revisit":
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To-Target-URI", _address(refers_to_url)), ("WARC-Refers-To-Date", "1970-01-01T00:00:00Z"), ("X-Refers-To-Page-ID", refers_to)]
        return [_record(headers, http + b"Content-Length: %d\r\n\r\n" % len(payload))]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    parts = [block[a : a + segment_bytes] for a in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        return [_record(headers, block)]
    out = [_record([*headers, ("WARC-Segment-Number", 1)], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        total = len(block) if k == len(parts) else None
        out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{k}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total)], part))
    return out


#: Owners that are broadcast at most, with their addresses some tens of MB.
_MOST_OWNERS = 100_000


def _with_owners(keyed: DataFrame, owners: DataFrame) -> DataFrame:
    """Pages with the owner of their payload. Owners are broadcast up to a number; beyond it those of frequent payloads, fewer
    than HOT_SHARE, still are, and the rest is joined by sort and merge."""
    if owners.count() <= _MOST_OWNERS:
        return keyed.join(F.broadcast(owners), "digest", "left")
    hot = F.broadcast(owners.filter(F.col("copies") > keyed.count() / HOT_SHARE))
    rest = keyed.join(hot.select("digest"), "digest", "left_anti").join(owners.hint("merge"), "digest", "left")
    return keyed.join(hot, "digest").unionByName(rest)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, segment_bytes: int = 16384, chunk_bytes: int = 4096, records_per_file: int = 1000) -> None:
    """Write pages (page_id, url, html) as gzipped WARC files under path. A file has a bounded number of records of bounded
    size, so a reader can hold one."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = rows.withColumn("digest", F.unhex(F.sha2("html", 256)))
    owners = keyed.groupBy("digest").agg(F.max("page_id").alias("owner"), F.max_by("url", "page_id").alias("owner_url"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    told = _with_owners(keyed, stage(owners, "owners")).select("page_id", "url", "html", F.when(F.octet_length("html") >= least_bytes, F.col("owner")).alias("owner"), "owner_url", F.monotonically_increasing_id().alias("row"))

    def frame(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(2)):
                out = []
                for p, url, html, owner, owner_url, row in zip(*[batch.column(i).slice(a, b - a).to_pylist() for i in range(6)], strict=True):
                    kind = "response" if owner is None or p == owner else "revisit"
                    out += records_of(kind, p, url, html.encode("utf-8", "surrogatepass"), owner, owner_url, row, segment_bytes, chunk_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    framed = told.mapInArrow(frame, "record binary").select(F.col("record").cast("string").alias("value"))
    framed.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def _unzipped(data: bytes) -> bytes:
    """The content of a file, gzipped as a whole, by record, or not at all; of a truncated or broken one as far as it goes."""
    parts = []
    while data[:2] == b"\x1f\x8b":
        d = zlib.decompressobj(31)
        try:
            parts.append(d.decompress(data))
            data = d.unused_data
        except zlib.error:
            whole = zlib.decompressobj(31)
            with contextlib.suppress(zlib.error):
                for a in range(0, len(data), 1024):  # what comes before the fault
                    parts.append(whole.decompress(data[a : a + 1024]))
            data = b""
    return b"".join(parts) + data


def parse_archive(data: bytes):
    """(headers, block, whole) of each record of a WARC file. A record without a usable length goes on to the next one, and one
    that the file's end cuts off has what is there; neither is whole."""
    data, at = _unzipped(data), 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        lines = data[at : end if end >= 0 else len(data)].split(_END)[1:]
        headers = {k.decode("utf-8", "replace").strip().lower(): v.strip().decode("utf-8", "replace") for k, _, v in (x.partition(b":") for x in lines)}
        start = end + 4 if end >= 0 else len(data)
        length = headers.get("content-length", "")
        if re.fullmatch("[0-9]{1,15}", length):
            block = data[start : start + int(length)]
            yield headers, block, len(block) == int(length)
        else:
            following = data.find(b"\r\n\r\nWARC/1.", start)
            block = data[start : following if following >= 0 else len(data)]
            yield headers, block, False
        at = start + len(block)


_PART = "origin string, segment long, total long, type string, page_id long, refers_to long, record_id string, refers_to_record string, claimed string, whole boolean, block binary, payload_bytes long, payload_digest string"


def payload_of(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked", head) else body


def _number(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch("-?[0-9]{1,18}", value) else None


def _told(block: bytes) -> tuple[int | None, str | None]:
    """Length and digest of a block's payload, nulls where its framing is broken."""
    try:
        payload = payload_of(block)
    except ValueError:
        return None, None
    return len(payload), payload_digest(payload)


def _part(h: dict, block: bytes, whole: bool, fallback: str) -> tuple | None:
    kind, segment = h.get("warc-type"), _number(h.get("warc-segment-number"))
    if kind not in ("response", "revisit", "continuation"):
        return None
    claimed = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    name = h.get("warc-record-id") or fallback
    refers = h.get("warc-refers-to", "").strip("<>") or None
    size = digest = kept = None
    if kind == "revisit":
        said = re.search(rb"(?im)^content-length:\s*(\d{1,15})\s*$", block)
        size, digest = int(said[1]) if said else None, claimed
    elif segment or kind == "continuation":
        kept = block
    elif whole:
        size, digest = _told(block)
    origin = h.get("warc-segment-origin-id") or name
    return origin, segment or 1, _number(h.get("warc-segment-total-length")), kind, _number(h.get("x-page-id")), _number(h.get("x-refers-to-page-id")), name.strip("<>"), refers, claimed, whole, kept, size, digest


def _rows(fields: pa.Schema, rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)], names=fields.names)


def _parsed(fields: pa.Schema):
    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for k, (h, block, whole) in enumerate(parse_archive(content.as_py())):
                    if (row := _part(h, block, whole, f"{path}#{k}")) is not None:
                        rows.append(row)
                    if len(rows) == 500:
                        yield _rows(fields, rows)
                        rows = []
                yield _rows(fields, rows)

    return run


_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, complete boolean, record_id string, refers_to_record string"


def _whole_record(segments: list[dict]) -> tuple:
    """One record of its segments."""
    by_number = {s["segment"]: s for s in reversed(segments)}
    parts = [by_number[k] for k in sorted(by_number)]
    first = parts[0]
    size, digest, done = first["payload_bytes"], first["payload_digest"], first["block"] is None and first["whole"]
    if first["block"] is not None:
        total = next((s["total"] for s in parts if s["total"] is not None), None)
        block = b"".join(s["block"] or b"" for s in parts)
        if all(s["whole"] for s in parts) and [s["segment"] for s in parts] == list(range(1, len(parts) + 1)) and total == len(block):
            size, digest = _told(block)
            done = size is not None
    fits = digest is not None and first["claimed"] in (None, digest)
    return first["page_id"], size, digest, first["type"], first["refers_to"], bool(done and fits), first["record_id"], first["refers_to_record"]


def _assembled(fields: pa.Schema):
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                yield _rows(fields, [_whole_record(x) for x in batch.column(0).slice(a, 200).to_pylist()])

    return run


def read_archives(spark: SparkSession, path: str, pattern: str = "*.gz") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, complete, record_id: one row per response or revisit record.
    A revisit that names a record, as foreign archives do, refers to that record's page."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    part, record = T._parse_datatype_string(_PART), T._parse_datatype_string(_RECORD)
    parts = files.select("path", "content").mapInArrow(_parsed(to_arrow_schema(part)), part)
    names = [n for n in part.names if n != "origin"]
    grouped = parts.groupBy("origin").agg(F.collect_list(F.struct(*names)).alias("segments")).select("segments")
    records = stage(grouped.mapInArrow(_assembled(to_arrow_schema(record)), record).filter("record_type <> 'continuation'"), "records")
    asked = records.filter("record_type = 'revisit'").select(F.col("payload_digest").alias("_digest")).distinct()
    known = stage(asked.join(records.filter("record_type = 'response' and complete").select(F.col("payload_digest").alias("_digest")), "_digest", "left_semi"), "payloads")
    named = records.filter("refers_to_record is not null").select("refers_to_record").distinct()
    pages = stage(named.join(records.select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("_page")), "refers_to_record").groupBy("refers_to_record").agg(F.max("_page").alias("_page")), "referred")
    responses, revisits = records.filter("record_type = 'response'"), records.filter("record_type = 'revisit'")
    told = revisits.join(checked(known, _MOST_OWNERS), F.col("payload_digest") == F.col("_digest"), "left").join(checked(pages, _MOST_OWNERS), "refers_to_record", "left")
    told = told.withColumns({"complete": F.col("complete") & F.col("_digest").isNotNull(), "refers_to": F.coalesce("refers_to", "_page")})
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete", "record_id"]
    return responses.select(*columns).unionByName(told.select(*columns))
