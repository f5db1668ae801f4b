"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over consecutive words: the words under its marks are hashed, the others may be anything. Test
and training texts are hashed under the same masks; equal hashes are hits. For every lag between a text and an item that has a hit,
both are laid side by side word for word over the item's whole length, and the stretch is reported if enough of it agrees, so a few
replaced words don't hide a leak.

Training texts pass a bitmap of the test hashes first, sized by their number up to a bound; what passes is joined with the
test hashes, and the texts of rows with hits are read again to be verified.

Words are runs of letters and digits, lower-cased; a Chinese or Japanese character is a word of its own. The masks are chosen by the
item's length so that no stretch that would be verified is without a hit. Items with the same words are one, reported by the
largest id.
Defined cases: null and empty texts match nothing; an item with fewer words than least_item_words (LEAST_ITEM_WORDS by default)
matches nothing, as single words prove no leak; texts of any length are read whole; every row is judged by its own text,
whatever rows share its id, null ids included; of stretches with equally many words that of the largest item stays, then the
first; documents without a match have contaminated = false and null details; an empty table gives an empty result, an empty
benchmark contaminates nothing; other columns, whatever their names, pass through drop_contaminated() and are not read by
contamination().
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import checked, fresh, numbered, stage, text_slices, without_rows
from tidewright.llm.shingles import parts_of, word_hashes

#: A verified stretch has at least so many agreeing words, or LEAST_SHARE of the item's if those are fewer, and this share of them.
LEAST_WORDS = 12
LEAST_SHARE = 0.8
#: Words that an item needs to be looked for.
LEAST_ITEM_WORDS = 3
_LEAST_BITS, _MOST_BITS = 16, 27  # of the bitmap, 16 MB at most
_MOST_WORDS = 8_000_000  # of all items that are broadcast for verification, 64 MB
_IN_WORDS = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
#: Words that any mask spans at most.
_SPAN = 7


def plain_words(c: Column) -> Column:
    """The text in lower case; outside ASCII what is neither letter nor digit is a space, and ideographs and kana stand alone."""
    low = F.lower(c.cast("string"))
    other = F.regexp_replace(F.regexp_replace(low, r"[^\p{L}\p{M}\p{N}]+", " "), r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}])", " $1 ")
    return F.when(low.rlike(r"[^\x00-\x7F]"), other).otherwise(low)


def least_agreeing(size: int) -> int:
    """The agreeing words that a verified stretch of an item with so many words needs."""
    return min(LEAST_WORDS, -(-size * round(100 * LEAST_SHARE) // 100))


def masks_of(size: int) -> list[str]:
    """The masks of an item with so many words: 1 is a word that counts, 0 one that may differ. Every stretch that would be
    verified is hit by one of them. With m agreeing words and at most m / 4 others between them the longest run of agreeing
    words has 4, or all runs have 3 with single words between; only in items of 5, 6 and 10 words can it be shorter."""
    if size < 5:
        return ["1" * size] if size else []
    more = {5: ["10111", "11011", "11101"], 6: ["111011", "110111"], 10: ["1110111", "111011"]}
    return ["1111", *more.get(size, ["1110111"] if size >= _SPAN else [])]


def text_hashes(text: str | None) -> np.ndarray:
    """The hashes of a text's words."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return word_hashes(data, np.array([0, len(data)]), _IN_WORDS)[0]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """The hash under a mask at every position where it fits."""
    n = len(h) - len(mask) + 1
    if n < 1:
        return np.empty(0, np.uint64)
    total = np.full(n, int(mask, 2), np.uint64)
    for k, c in enumerate(mask):
        if c == "1":
            total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return total


def item_seeds(h: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """(mask, hashes by position) of a test item."""
    return [(mask, _seeds(h, mask)) for mask in masks_of(len(h))]


def _items(benchmark: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """k, item, copies, words: the hashes of each sequence of words that the benchmark has, of at least so many."""

    def hashed(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                words = [text_hashes(t).view(np.int64) for t in batch.column(1).slice(a, b - a).to_pylist()]
                keep = [i for i, w in enumerate(words) if len(w) >= least]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([a + i for i in keep], pa.int64())), pa.array([words[i] for i in keep], pa.list_(pa.int64()))], names=["item", "words"])

    item = T.StructField("item", benchmark.schema[id_col].dataType)
    found = benchmark.select(F.col(id_col), plain_words(F.col(text_col))).mapInArrow(hashed, T.StructType([item, *T._parse_datatype_string("words array<long>").fields]))
    alike = found.groupBy("words").agg(F.max("item").alias("item"), F.count(F.lit(1)).alias("copies"))
    return alike.select(F.monotonically_increasing_id().alias("k"), "item", "copies", "words")


def _item_seeds(items: DataFrame) -> DataFrame:
    """seed, k, at, mask: every position of every item under its masks."""

    def seeds(batches):
        for batch in batches:
            rows = []
            for k, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for mask, found in item_seeds(np.array(words, np.int64).view(np.uint64)):
                    rows += [(seed, k, p, mask) for p, seed in enumerate(found.view(np.int64).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.string()))], names=["seed", "k", "at", "mask"])

    return items.select("k", "words").mapInArrow(seeds, "seed long, k long, at int, mask string")


def _bitmap(tests: DataFrame) -> tuple[np.ndarray, list[str]]:
    """A bit for each test hash, 16 bits a hash within bounds, and the few masks in use."""
    bits = min(_MOST_BITS, max(_LEAST_BITS, (16 * tests.count()).bit_length()))
    bit = F.pmod(F.col("seed"), F.lit(1 << bits))
    rows = tests.groupBy((bit / 64).cast("int").alias("cell")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    bitmap[np.asarray(rows.column("cell"))] = np.asarray(rows.column("bits")).view(np.uint64)
    return bitmap, sorted(r["mask"] for r in tests.select("mask").distinct().collect())


def _hits(docs: DataFrame, bitmap: np.ndarray, masks: list[str]) -> DataFrame:
    """row, seed, at: the positions of docs (row, text) whose hash the bitmap has."""

    def is_test(seeds: np.ndarray) -> np.ndarray:
        bit = seeds & np.uint64(64 * len(bitmap) - 1)
        return np.flatnonzero((bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1))

    def hits(batches):
        for batch in batches:
            for a, _, data, offsets in parts_of(batch.column(1)):
                h, bounds = word_hashes(data, offsets, _IN_WORDS)
                rows, seeds, ats = [], [], []
                for mask in masks:
                    found = _seeds(h, mask)
                    at = is_test(found)
                    row = np.searchsorted(bounds, at, "right") - 1
                    whole = at + len(mask) <= bounds[row + 1]
                    at, row = at[whole], row[whole]
                    rows.append(a + row)
                    seeds.append(found[at].view(np.int64))
                    ats.append(at - bounds[row])
                rows, seeds, ats = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (rows, seeds, ats))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows.astype(np.int64))), pa.array(seeds), pa.array(ats.astype(np.int32))], names=["row", "seed", "at"])

    return docs.mapInArrow(hits, T.StructType([docs.schema["row"], *T._parse_datatype_string("seed long, at int").fields]))


def best_stretch(same: np.ndarray, least_share: float = LEAST_SHARE) -> tuple[int, int, int]:
    """(begin, end, agreeing) of the stretch with the most agreeing words that begins and ends with one and agrees on at
    least the given share."""
    gain = np.where(same, 1 - least_share, -least_share)
    total = np.concatenate([[0], np.cumsum(gain)])
    count = np.concatenate([[0], np.cumsum(same)])
    best = (0, 0, 0)
    low = np.minimum.accumulate(total)
    starts = [i for i in range(len(same)) if i == 0 or total[i] < low[i - 1]]
    for i in starts:
        ends = np.flatnonzero(total[i + 1 :] >= total[i] - 1e-9)
        if len(ends) and count[j := int(ends[-1]) + i + 1] - count[i] > best[2]:
            a, b = i, j
            agree = np.flatnonzero(same[a:b])
            best = (a + int(agree[0]), a + int(agree[-1]) + 1, int(count[b] - count[a]))
    return best


def _verified(batches):
    """Of rows (row, text, k, lag, words) in order of row, its text first: row, k, word_start, word_end, agreeing of the lags with
    enough agreement. One text is held at a time."""
    own = words = None
    for batch in batches:
        out = [[], [], [], [], []]
        columns = [batch.column(i) for i in range(5)]
        for i, (row, is_text) in enumerate(zip(columns[0].to_pylist(), columns[2].is_null().to_pylist(), strict=True)):
            if is_text:
                own, words = row, text_hashes(columns[1][i].as_py())
            elif row == own:
                item, lag = np.asarray(columns[4].slice(i, 1).flatten()).view(np.uint64), columns[3][i].as_py()
                skip = max(0, -lag)
                part = words[lag + skip : lag + len(item)]
                a, b, agree = best_stretch(part == item[skip : skip + len(part)])
                if agree >= least_agreeing(len(item)):
                    for x, v in zip(out, (i, columns[2][i].as_py(), lag + skip + a, lag + skip + b, agree), strict=True):
                        x.append(v)
        yield pa.RecordBatch.from_arrays([columns[0].take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int64()), *[pa.array(x, pa.int32()) for x in out[2:]]], names=["row", "k", "word_start", "word_end", "agreeing"])


def find_overlaps(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text", least_item_words: int = LEAST_ITEM_WORDS) -> DataFrame:
    """docs (row, text), where row is a number of its own for each row -> row, item, copies, word_start, word_end, agreeing:
    verified stretches, each once; copies is how many items of the benchmark have the item's words."""
    items = stage(_items(benchmark, item_col, item_text, least_item_words), "test-items")
    tests = stage(_item_seeds(items), "test-seeds")
    bitmap, masks = _bitmap(tests)
    docs = docs.select("row", plain_words(F.col("text")).alias("text"))
    hits = _hits(docs, bitmap, masks).join(checked(tests.select("seed", "k", F.col("at").alias("item_at"))), "seed")
    met = stage(hits.select("row", "k", (F.col("at") - F.col("item_at")).alias("lag")).distinct(), "hits")
    texts = docs.join(checked(stage(met.select("row").distinct(), "rows-met")), "row", "left_semi")
    words = items.select("k", "words")
    pairs = met.join(F.broadcast(words) if (items.agg(F.sum(F.size("words"))).first()[0] or 0) <= _MOST_WORDS else words, "k")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    both = texts.select("row", "text", none("long", "k"), none("int", "lag"), none("array<long>", "words")).unionByName(pairs.select("row", none("string", "text"), "k", "lag", "words"))
    found = both.repartition("row").sortWithinPartitions("row", F.col("k").isNotNull(), "k", "lag").mapInArrow(_verified, T.StructType([docs.schema["row"], *T._parse_datatype_string("k long, word_start int, word_end int, agreeing int").fields]))
    return found.distinct().join(checked(items.select("k", "item", "copies")), "k").drop("k")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", least_item_words: int = LEAST_ITEM_WORDS) -> DataFrame:
    """One row per row of docs: id_col, contaminated, item_id (of the longest stretch), n_items, word_start, word_end,
    agreeing."""
    rows, _ = numbered(docs.select(F.col(id_col).alias("own"), F.col(text_col).cast("string").alias("text")), "numbered")
    found = find_overlaps(rows.select("row", "text"), benchmark, item_col, least_item_words=least_item_words)
    # one row for each item first, so that what is counted comes to no more than the items
    each = found.groupBy("row", "item").agg(F.max(F.struct("agreeing", (-F.col("word_start")).alias("from"), "word_end")).alias("s"), F.max("copies").alias("copies"))
    best = each.groupBy("row").agg(F.max_by(F.struct("item", (-F.col("s.from")).alias("word_start"), "s.word_end", "s.agreeing"), F.struct("s.agreeing", "item", "s.from")).alias("best"), F.sum("copies").alias("n_items"))
    names = fresh([id_col], "contaminated", "item_id", "n_items", "word_start", "word_end", "agreeing")
    told = [F.col("best").isNotNull(), F.col("best.item"), F.coalesce("n_items", F.lit(0)), F.col("best.word_start"), F.col("best.word_end"), F.col("best.agreeing")]
    return rows.select("row", "own").join(best, "row", "left").select(F.col("own").alias(id_col), *[c.alias(n) for c, n in zip(told, names, strict=True)])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", least_item_words: int = LEAST_ITEM_WORDS) -> DataFrame:
    """The rows of docs, with all their columns, whose text has no verified overlap with the benchmark."""
    rows, row = numbered(docs, "numbered")
    found = find_overlaps(rows.select(F.col(row).alias("row"), F.col(text_col).cast("string").alias("text")), benchmark, item_col, least_item_words=least_item_words)
    return without_rows(rows, row, found.select("row").distinct()).select(*docs.columns)
