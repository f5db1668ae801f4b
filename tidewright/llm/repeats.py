"""Removal of repeated strings of LENGTH bytes by a column-wise suffix order with common prefixes.

Every string of LENGTH bytes (a window) has an anchor, the gram of GRAM bytes in it with the least hash, the first of several. Runs of
windows with one anchor are the pieces that texts are cut into (a piece has the bytes of all its windows). Equal windows have equal
anchors at the same place, so only pieces of one anchor hash need to be held together, laid over each other at the anchor.

1. Anchor hashes are counted; hashes of two pieces or more are marked in a bitmap of a fixed size. Pieces that aren't marked repeat nowhere.
2. Equal pieces are brought together before anything is sorted: the first stays, all windows of the others repeat.
3. The pieces that stay and share their anchor's hash with others go, by hash, into blocks of bounded size. There they are a collection
   of strings that is processed by columns from right to left: each round inserts one symbol of every piece, and a stable sort by that
   symbol takes the suffixes' order to the next (the step of the Burrows-Wheeler transform), while the common prefix of neighbours is
   one more than the least between their tails. As equal windows lie in one column, a column's suffixes are compared with each other
   alone, and a round needs nothing but the column before. Neighbours with a common prefix of LENGTH or more are equal windows.
4. A hash with more than HOT different pieces is dealt out by the digests of its windows, of which the first is kept.
5. Texts are read once more with what was kept and found, and windows that repeat are cut out.

The bitmaps only save work: a piece that is marked by chance is the first of its kind and stays.

Order: windows start in the order of ids (null first), then of the hash of their text, then of their place. Rows with one id and one
text are one document: each of them gets what the first would get, and they don't repeat each other.

Defined cases: a null text counts as empty; texts shorter than LENGTH lose nothing; matches never cross documents; a text of any
length is read whole, in parts; an empty table gives an empty result; other columns, whatever their names, are not read. Between tasks
only Spark's shuffles and the shared folder are used: the columns of a block are written and read in order, in memory, as a block is bounded.
"""

from __future__ import annotations

from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import fresh, release, stage
from tidewright.llm.shingles import mix, parts_of, text_bytes

LENGTH, GRAM = 100, 32
_WINDOW = LENGTH - GRAM + 1  # grams in a window
#: Bits of a bitmap of marked hashes.
_BITS = 27
#: Pieces of one anchor hash that are ordered in one task, and pieces in a block.
HOT, _BLOCK = 1 << 16, 1 << 13
#: Window starts of a text that are looked at together.
_STARTS = 1 << 22
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_ODD = np.uint64(0xD1B54A32D192ED03)
_powers = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n], _powers["down"][:n]


def _runs(data: np.ndarray, offsets: np.ndarray):
    """(row, start, windows, place of the anchor from the start, hash) of the pieces of some texts, as arrays."""
    n = len(data)
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    h = (sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    least, span = h, 1
    while span * 2 <= _WINDOW:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    if span < _WINDOW:
        least = np.minimum(least[: span - _WINDOW], least[_WINDOW - span :])
    begins = np.ones(len(least), bool)
    begins[1:] = (h[: len(least) - 1] == least[:-1]) | (least[1:] < least[:-1])
    sizes = np.diff(offsets)
    fits = sizes >= LENGTH
    begins[offsets[:-1][fits]] = True
    inside = np.zeros(len(least) + 1, np.int8)
    inside[offsets[:-1][fits]] += 1
    np.subtract.at(inside, offsets[1:][fits] - LENGTH + 1, np.int8(1))
    start = np.flatnonzero(begins & (np.cumsum(inside[:-1], dtype=np.int8) > 0))
    row = np.searchsorted(offsets, start, "right") - 1
    windows = np.minimum(np.append(start[1:], n), offsets[row + 1] - LENGTH + 1) - start
    at = np.concatenate([(h[some[:, None] + np.arange(_WINDOW)] == least[some][:, None]).argmax(1) for some in np.array_split(start, len(start) // 100_000 + 1)])
    return row, start - offsets[row], windows, at, h[start + at]


def runs_of(data: np.ndarray, offsets: np.ndarray):
    """Like _runs, for texts of any length."""
    if len(data) < LENGTH:
        return [np.empty(0, np.int64)] * 4 + [np.empty(0, np.uint64)]
    if len(offsets) > 2 or len(data) <= _STARTS:
        return _runs(data, offsets)
    found = []
    for a in range(0, len(data) - LENGTH + 1, _STARTS):
        part = data[a : a + _STARTS + LENGTH - 1]
        row, start, *rest = _runs(part, np.array([0, len(part)]))
        found.append((row, start + a, *rest))
    return [np.concatenate(c) for c in zip(*found, strict=True)]


def _bitmap(spark, numbers: DataFrame):
    """A bit for each of some numbers that are spread evenly, as a broadcast array of a fixed size."""

    def bits(batches):
        found = np.zeros(1 << (_BITS - 6), np.uint64)
        for batch in batches:
            at = np.asarray(batch.column(0)).view(np.uint64) >> np.uint64(64 - _BITS)
            np.bitwise_or.at(found, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        (some,) = found.nonzero()
        for a in range(0, len(some), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(some[a : a + (1 << 16)]), pa.array(found[some[a : a + (1 << 16)]].view(np.int64))], names=["cell", "bits"])

    cells = numbers.mapInArrow(bits, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (_BITS - 6), np.uint64)
    out[np.asarray(cells.column("cell"))] = np.asarray(cells.column("bits")).view(np.uint64)
    return spark.sparkContext.broadcast(out)


def _marked(bitmap: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    at = numbers >> np.uint64(64 - _BITS)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _place(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A number for a place in a document."""
    return mix(doc.view(np.uint64) + start.astype(np.uint64) * _ODD)


def _digests(pieces) -> np.ndarray:
    return np.frombuffer(b"".join(blake2b(p, digest_size=16).digest() for p in pieces), np.int64).reshape(-1, 2)


def _hashes(texts: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for _, _, data, offsets in parts_of(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(runs_of(data, offsets)[4].view(np.int64))], names=["hash"])

    return texts.select("text").mapInArrow(run, "hash long")


def _span(start: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Start and number of windows of a piece in one number, in the order of starts."""
    return (start << 7) | windows


def _doc_key() -> Column:
    return F.xxhash64(F.col("id").cast("string"), "th")


def _pieces(texts: DataFrame, marks) -> DataFrame:
    """hash, d1, d2 (the piece's digest), id, th, span of the pieces whose hash is marked."""
    schema = T.StructType([*T._parse_datatype_string("hash long, d1 long, d2 long").fields, *texts.schema.fields[:2], T.StructField("span", T.LongType())])

    def run(batches):
        for batch in batches:
            for first, _, data, offsets in parts_of(batch.column(2)):
                row, start, windows, _, h = runs_of(data, offsets)
                kept = _marked(marks.value, h)
                row, start, windows, h = row[kept], start[kept], windows[kept], h[kept]
                begin = start + offsets[row]
                raw = data.tobytes()
                d = _digests(raw[a:b] for a, b in zip(begin.tolist(), (begin + windows + LENGTH - 1).tolist(), strict=True))
                own = [batch.column(k).take(pa.array(row + first)) for k in range(2)]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(d[:, 0]), pa.array(d[:, 1]), *own, pa.array(_span(start, windows))], names=schema.names)

    return texts.mapInArrow(run, schema)


def _at_places(texts: DataFrame, places) -> DataFrame:
    """hash, id, th, doc, start, anchor and the bytes of the pieces whose place is marked."""
    schema = T.StructType([T.StructField("hash", T.LongType()), *texts.schema.fields[:2], *T._parse_datatype_string("doc long, start long, anchor long, piece binary").fields])

    def run(batches):
        for batch in batches:
            docs = np.asarray(batch.column(3))
            for first, _, data, offsets in parts_of(batch.column(2)):
                row, start, windows, at, h = runs_of(data, offsets)
                kept = _marked(places.value, _place(docs[row + first], start))
                row, start, windows, at, h = row[kept], start[kept], windows[kept], at[kept], h[kept]
                begin = start + offsets[row]
                raw = data.tobytes()
                pieces = pa.array([raw[a:b] for a, b in zip(begin.tolist(), (begin + windows + LENGTH - 1).tolist(), strict=True)], pa.binary())
                own = [batch.column(k).take(pa.array(row + first)) for k in (0, 1, 3)]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *own, pa.array(start), pa.array(at), pieces], names=schema.names)

    return texts.withColumn("doc", _doc_key()).mapInArrow(run, schema)


def repeats_in_columns(pieces: list[bytes], anchors: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(piece, start) of every window that an earlier piece of the collection has in the same column. anchors: the place in each
    piece that lies in column 0."""
    sizes, at = np.array([len(p) for p in pieces]), np.array(anchors)
    left, right = -at, sizes - at  # first column, and the one after the last
    low, high = int(left.min()), int(right.max())
    symbols = np.zeros((high - low, len(pieces)), np.uint8)
    piece = np.repeat(np.arange(len(pieces)), sizes)
    symbols[np.arange(len(piece)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(left - low, sizes), piece] = np.frombuffer(b"".join(pieces), np.uint8)
    entering, enters = np.argsort(-right, kind="stable"), -np.sort(-right)
    order, common, entered, found = np.empty(0, np.int64), np.empty(0, np.int64), 0, []
    for column in range(high - 1, low - 1, -1):
        now = int(np.searchsorted(-enters, -column, "left"))  # pieces whose last column is this one or a later one
        if now > entered:  # as empty suffixes, which come first
            order = np.concatenate([entering[entered:now], order])
            common = np.concatenate([np.zeros(now - entered, np.int64), common])
            entered = now
        going_on = left[order] <= column
        if not going_on.all():  # a piece that has ended hands its prefix on to the suffix after it
            (stay,) = np.nonzero(going_on)
            if not len(stay):
                order, common = order[:0], common[:0]
                continue
            before = np.concatenate([[0], stay[:-1] + 1])
            common = np.minimum.reduceat(common[: stay[-1] + 1], before)
            order = order[stay]
        n = len(order)
        if not n:
            continue
        own = symbols[column - low, order]
        sort = np.argsort(own, kind="stable")
        after = np.empty(n, np.int64)  # for each suffix, the one before it in the new order
        after[sort[1:]], after[sort[0]] = sort[:-1], -1
        same = np.empty(n, bool)
        same[sort[0]] = False
        same[sort[1:]] = own[sort[1:]] == own[sort[:-1]]
        ranges = np.empty(2 * n, np.int64)
        ranges[0::2], ranges[1::2] = np.where(same, after + 1, np.arange(n)), np.arange(1, n + 1)
        least = np.minimum.reduceat(np.append(common, 0), ranges)[0::2]
        order, common = order[sort], np.where(same, least + 1, 0)[sort]
        if (common >= LENGTH).any():
            (firsts,) = np.nonzero(common < LENGTH)
            keeper = np.repeat(np.minimum.reduceat(order, firsts), np.diff(np.append(firsts, n)))
            gone = order[keeper != order]
            found.append((gone, column - left[gone]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _repeated(pieces: DataFrame) -> DataFrame:
    """doc, th, span: the windows of the pieces (hash, id, th, doc, start, anchor, piece) that an earlier piece has."""

    def solve(some: pa.Table):
        piece, start = repeats_in_columns(some.column("piece").to_pylist(), some.column("anchor").to_pylist())
        order = np.lexsort((start, piece))
        piece, start = piece[order], start[order]
        heads = np.flatnonzero(np.concatenate([[True], (piece[1:] != piece[:-1]) | (start[1:] != start[:-1] + 1)])) if len(piece) else piece
        size = np.diff(np.append(heads, len(piece)))
        piece, start = piece[heads], start[heads]
        at = np.asarray(some.column("start"))[piece] + start
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(some.column("doc"))[piece]), pa.array(np.asarray(some.column("th"))[piece]), pa.array(_span(at, size))], names=["doc", "th", "span"])

    def run(batches):
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if held.num_rows >= _BLOCK:  # whole groups of one hash; the last may go on
                h = np.asarray(held.column("hash"))
                cut = int(np.searchsorted(h, h[-1], "left"))
                if cut:
                    yield solve(held.slice(0, cut))
                    held = held.slice(cut)
        if held is not None and held.num_rows:
            yield solve(held)

    sorted_pieces = pieces.repartition("hash").sortWithinPartitions("hash", "id", "th", "start")
    return sorted_pieces.mapInArrow(run, "doc long, th long, span long")


def _first_windows(texts: DataFrame, hot: DataFrame) -> DataFrame:
    """doc, th, span: of the windows of the hot pieces (doc, th, span) the first of each digest."""
    schema = T.StructType([T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()), *texts.schema.fields[:2], T.StructField("span", T.LongType())])
    lists = hot.groupBy("doc", "th").agg(F.collect_list("span").alias("spans"))

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for k, spans in enumerate(batch.column(3)):
                raw = data[offsets[k] : offsets[k + 1]].tobytes()
                at = np.array([s for x in spans.as_py() for s in range(x >> 7, (x >> 7) + (x & 127))])
                for a in range(0, len(at), 1 << 16):
                    some = at[a : a + (1 << 16)]
                    d = _digests(raw[s : s + LENGTH] for s in some.tolist())
                    own = [batch.column(c).take(pa.array([k] * len(some))) for c in range(2)]
                    yield pa.RecordBatch.from_arrays([pa.array(d[:, 0]), pa.array(d[:, 1]), *own, pa.array(_span(some, np.int64(1)))], names=schema.names)

    windows = texts.withColumn("doc", _doc_key()).join(lists, ["doc", "th"]).select("id", "th", "text", "spans").mapInArrow(run, schema)
    first = windows.groupBy("d1", "d2").agg(F.min(F.struct("id", "th", "span")).alias("x"))
    return first.select("x.*").select(_doc_key().alias("doc"), "th", "span")


def _packed(texts: DataFrame, marks) -> DataFrame:
    """id, th, the text's bytes, compressed for the shuffle, and the spans of its marked pieces."""
    schema = T.StructType([*texts.schema.fields[:2], *T._parse_datatype_string("packed binary, marked array<long>").fields])

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for first, last, data, offsets in parts_of(batch.column(2)):
                row, start, windows, _, h = runs_of(data, offsets)
                some = _marked(marks.value, h)
                at = np.searchsorted(row[some], np.arange(last - first + 1))
                packed = pa.array([pack.compress(data[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.binary())
                marked = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(_span(start[some], windows[some])))
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(first, last - first) for k in range(2)], packed, marked], names=schema.names)

    return texts.mapInArrow(run, schema)


def _covered(n: int, marked: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Which of a text's bytes are in a window that repeats: all those of marked pieces but the kept ones, and those found."""
    repeats = np.zeros(n + 1, np.int32)
    kept, told = (told & 1).astype(bool), told >> 1
    for spans, step in ((marked, 1), (told[kept], -1), (told[~kept], 1)):
        start = spans >> 7
        np.add.at(repeats, start, step)
        np.add.at(repeats, start + (spans & 127), -step)
    edges = np.diff(np.concatenate([[0], np.cumsum(repeats[:-1]) > 0, [0]]).astype(np.int8))
    covered = np.zeros(n + LENGTH, np.int32)
    covered[np.flatnonzero(edges > 0)] += 1
    covered[np.flatnonzero(edges < 0) + LENGTH - 1] -= 1
    return np.cumsum(covered[:n]) > 0


def _cut(texts: DataFrame, told: DataFrame, marks, id_col: str) -> DataFrame:
    """The result for each text, told (doc, th, told) which windows of marked pieces are kept and which others are gone."""
    names = fresh([id_col], "n_bytes", "n_removed", "n_spans", "kept_sha256")
    kinds = [T.LongType()] * 3 + [T.StringType()]
    schema = T.StructType([T.StructField(id_col, texts.schema["id"].dataType), *[T.StructField(n, t) for n, t in zip(names, kinds, strict=True)]])

    def run(batches):
        unpack, none = zstandard.ZstdDecompressor(), np.empty(0, np.int64)
        for batch in batches:
            made = []
            for packed, marked, told in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                raw = unpack.decompress(packed.as_py())
                marked = np.asarray(marked.values)
                if not len(marked):
                    made.append((len(raw), 0, 0, sha256(raw).hexdigest()))
                    continue
                gone = _covered(len(raw), marked, np.asarray(told.values) if told.is_valid else none)
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
                made.append((len(raw), int(np.count_nonzero(gone)), spans, sha256(np.frombuffer(raw, np.uint8)[~gone]).hexdigest()))
            columns = zip(*made, strict=True) if made else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.string() if i == 3 else pa.int64()) for i, c in enumerate(columns)]], names=schema.names)

    packed = _packed(texts, marks).withColumn("doc", _doc_key())
    return packed.join(told, ["doc", "th"], "left").select("id", "packed", "marked", "told").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 (of the bytes that stay)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    marks = _bitmap(spark, _hashes(texts).groupBy("hash").count().filter("count > 1").select("hash"))
    release(spark)
    first = _pieces(texts, marks).groupBy("d1", "d2").agg(F.min(F.struct("id", "th", "span", "hash")).alias("x"))
    first = stage(first.select("x.*"), "first-pieces").withColumn("doc", _doc_key())
    release(spark)
    counts = first.groupBy("hash").count().filter("count > 1")
    shared = stage(first.select("hash", "doc", "th", "span").join(counts, "hash").drop("hash"), "shared-pieces")
    release(spark)

    def places(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_place(np.asarray(batch.column(0)), np.asarray(batch.column(1)) >> 7).view(np.int64))], names=["place"])

    at = _bitmap(spark, shared.filter(F.col("count") <= HOT).select("doc", "span").mapInArrow(places, "place long"))
    gone = stage(_repeated(_at_places(texts, at)), "repeated-windows")
    release(spark)
    hot = shared.filter(F.col("count") > HOT).drop("count")
    kept = first.select("doc", "th", "span")
    if not hot.isEmpty():
        kept = kept.join(hot, ["doc", "th", "span"], "left_anti").unionByName(_first_windows(texts, hot))
    spans = kept.selectExpr("doc", "th", "span * 2 + 1 AS span").unionByName(gone.selectExpr("doc", "th", "span * 2 AS span"))
    return _cut(texts, spans.groupBy("doc", "th").agg(F.collect_list("span").alias("told")), marks, id_col)
