"""Alignment of the tokens of two tokenizers over whole texts, as joins and windows on their byte offsets.

A byte-level BPE tokenizer (A) and a SentencePiece BPE model (B) cut a space and the text into tokens that cover the same bytes.
Offsets where tokens of both end cut these into groups; two tokens that end together are linked.

Both tokenizers always cut before a space that follows a letter, a digit or a visible sign, so a text is a sequence of words (the
stretches between such places) whose tokens, groups and links are the same wherever they occur. Each task replaces the words of its
documents by numbers of a dictionary of its own, and every distinct word is encoded and aligned once, with the number of its
occurrences: its tokens are exploded with their positions, their ends are windowed sums of their lengths, A meets B on word and
end, and the running count of such cuts numbers the groups. A pair's count is the sum over words, a B token's best count a maximum over its
pairs. What a word comes to goes back to the tasks' dictionaries by a join, and documents add up their words.

A word's tokens must give back its bytes, else the job fails: A has to be byte-level BPE without a normaliser, B a BPE model with byte
fallback that adds a space and doesn't otherwise normalise, which is checked on the driver. Such a B reads U+2581 as a space, so a
text with that sign differs from its tokens' bytes.

Defined cases: null and empty texts, and texts with U+2581, have no tokens, zeros and an empty groups_sha256, and take no part in
counts; strings of special tokens inside texts are plain text; a text of any length is aligned whole, and one without spaces is one word;
every row gives one row and counts, repeated ones too; ids pass as they are, null ones too; an empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import atexit
import json
import re
import uuid
from contextlib import contextmanager
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import _delete as delete
from tidewright.llm.common import drop_staged, new_path, release, stage
from tidewright.llm.sentencepiece_codec import BPE, BYTE, MARK, parse_model, read_model

#: Where the public tokenizer files are; parameters of every function that reads one.
DEFAULT_A = "/opt/tokenizers/byte_bpe_50k.json"
DEFAULT_B = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text after which a task begins another dictionary.
DICTIONARY_BYTES = 1 << 25
#: Pairs of ids that are broadcast.
FREQUENT = 1 << 17
#: Input partitions that share a dictionary.
_SHARED = 4
#: A space at which a text isn't cut: not after a letter, a digit or a visible ASCII sign, before another space, or the last sign.
_INNER_SPACE = re.compile(r" (?:(?<![\w!-~] )|(?= |\Z))")
#: Fixed value: how byte-level BPE of this kind splits a text before it merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def words_of(text: str) -> list[str]:
    """The words of a text without U+2581, without the space before each; joined by spaces they are the text."""
    marked = _INNER_SPACE.sub(MARK, text)
    if MARK not in marked:
        return text.split(" ")
    return [w.replace(MARK, " ") for w in marked.split(" ")]


def byte_alphabet() -> dict[str, int]:
    """The sign of each byte in byte-level vocabularies: visible Latin-1 signs stand for themselves, the others follow from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def token_bytes(vocab: dict[str, int]) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    alphabet = byte_alphabet()
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(map(alphabet.__getitem__, token))
    return out


class Pair:
    """Both tokenizers, with the bytes of each token."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        import tiktoken

        self.a = token_bytes(json.loads(a)["model"]["vocab"])
        self.tokenizer = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(self.a)}, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.b = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in parse_model(b).pieces]
        self.a_sizes, self.b_sizes = np.array([len(x) for x in self.a], np.int32), np.array([len(x) for x in self.b], np.int32)

    def encode(self, words: list[str]) -> list[list[list[int]]]:
        """The ids of both tokenizers for a space and each word."""
        ours, theirs = [self.tokenizer.encode_ordinary(" " + w) for w in words], self.model.encode(words, num_threads=1)
        for w, x, y in zip(words, ours, theirs, strict=True):
            if not b"".join(map(self.a.__getitem__, x)) == b"".join(map(self.b.__getitem__, y)) == b" " + w.encode():
                raise ValueError(f"tokens of {w!r} don't give back its bytes")
        return [ours, theirs]


@lru_cache(maxsize=1)
def _pair(a: bytes, b: bytes) -> Pair:
    return Pair(a, b)


def check_models(a: bytes, b: bytes) -> bool:
    """Whether B cuts before a space between two other signs, as A does; models that change a text's bytes are refused."""
    spec, model = json.loads(a), parse_model(b)
    bpe, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError("A must be byte-level BPE that leaves texts as they are")
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in bpe["merges"]]
    if any(bpe.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")) or [bpe["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
        raise ValueError("A's ids must be in the order of its merges, after the 256 bytes")
    if model.kind != BPE or model.charsmap or model.squeeze or not model.dummy_prefix or not model.byte_fallback:
        raise ValueError("B must be a BPE model with byte fallback that adds a space and changes nothing else")
    return not any(MARK in p.lstrip(MARK) for p, _, _ in model.pieces)


@contextmanager
def _joins_by_part_of_keys(spark: SparkSession):
    """While it lasts, tables that are dealt by one of a join's keys are joined as they lie."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _drop_table(spark: SparkSession, name: str) -> None:
    if spark.sparkContext._jsc is not None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _stage_by(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """Like stage(), in a table that is dealt out by a key and sorted by it, so that what is grouped or joined by it needs no shuffle, and rows
    of one key lie together and are stored in less."""
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", new_path(spark, label)).saveAsTable(name)
    atexit.register(_drop_table, spark, name)
    del df
    release(spark)
    return spark.table(name)


def _bytes_to_numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4")[:, 0]


class _Numbers(dict):
    """Numbers words in the order in which they are asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = k = len(self)
        return k


def _dictionaries(docs: DataFrame, id_col: str, text_col: str, cut: bool) -> DataFrame:
    """A row for each document: dictionary, id and words (numbers in it, by planes of bytes, compressed; null without tokens); and one
    for each entry of a dictionary: dictionary, number, word, n (its occurrences)."""
    id_field = T.StructField("id", docs.schema[id_col].dataType)
    schema = T.StructType([T.StructField("dictionary", T.LongType()), id_field, *T._parse_datatype_string("words binary, number int, word string, n long").fields])

    def rows(key, n, ids, words=None, number=None, word=None, count=None):
        arrays = [pa.array([key] * n, pa.int64()), ids, pa.nulls(n, pa.binary()) if words is None else words]
        arrays += [pa.nulls(n, kind) if v is None else pa.array(v, kind) for v, kind in ((number, pa.int32()), (word, pa.string()), (count, pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def run(batches):
        key, numbers, counts, size, id_type, pack = TaskContext.get().partitionId() << 33, _Numbers(), np.zeros(0, np.int64), 0, None, zstandard.ZstdCompressor(level=1)

        def entries():
            words = list(numbers)
            for k in range(0, len(words), 50_000):
                some = words[k : k + 50_000]
                yield rows(key, len(some), pa.nulls(len(some), id_type), None, range(k, k + len(some)), some, counts[k : k + 50_000])

        for batch in batches:
            id_type, packed, used = batch.column(0).type, [], []
            for text in batch.column(1):
                text = text.as_py()
                if not text or MARK in text:
                    packed.append(None)
                    continue
                own = np.array(list(map(numbers.__getitem__, words_of(text) if cut else [text])), "<u4")
                size += len(text)
                used.append(own)
                packed.append(pack.compress(own.view(np.uint8).reshape(-1, 4).T.tobytes()))
            if used:
                more = np.bincount(np.concatenate(used), minlength=len(numbers))
                more[: len(counts)] += counts
                counts = more
            yield rows(key, len(packed), batch.column(0), pa.array(packed, pa.binary()))
            if size >= DICTIONARY_BYTES:
                yield from entries()
                key, size, counts = key + 1, 0, np.zeros(0, np.int64)
                numbers.clear()
                pa.default_memory_pool().release_unused()
        yield from entries()

    rows_in = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = max(rows_in.rdd.getNumPartitions() // _SHARED, rows_in.sparkSession.sparkContext.defaultParallelism)
    return rows_in.coalesce(parts).mapInArrow(run, schema)


def _encoded(words: DataFrame, a: bytes, b: bytes) -> DataFrame:
    """words (h, word, n) with the ids and sizes of their tokens."""
    schema = T._parse_datatype_string("h long, word string, n long, a array<int>, a_size array<int>, b array<int>, b_size array<int>")

    def lists(ids, sizes):
        flat = np.fromiter((i for x in ids for i in x), np.int32)
        at = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        return [pa.ListArray.from_arrays(at, pa.array(v, pa.int32())) for v in (flat, sizes[flat])]

    def run(batches):
        pair = _pair(a, b)
        for batch in batches:
            ours, theirs = pair.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists(ours, pair.a_sizes), *lists(theirs, pair.b_sizes)], names=schema.names)

    return words.select("h", "word", "n").mapInArrow(run, schema)


def _tokens(words: DataFrame, side: str) -> DataFrame:
    """h, w, end, the token's id, named as the side, and its position for every token of every word."""
    each = words.select("h", "w", F.posexplode(F.arrays_zip(F.col(side).alias("id"), F.col(f"{side}_size").alias("size"))).alias(f"{side}_at", "t"))
    so_far = Window.partitionBy("h", "w").orderBy(f"{side}_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return each.select("h", "w", F.sum("t.size").over(so_far).alias("end"), F.col("t.id").alias(side), f"{side}_at")


def align_words(words: DataFrame) -> DataFrame:
    """h, w, word, n, the word's groups as text, and its links (a, b) for encoded words. Where tokens of both end is a cut; the running
    count of cuts numbers the groups, and a group holds the tokens after the cut before it."""
    cuts = _tokens(words, "a").join(_tokens(words, "b"), ["h", "w", "end"])
    running = Window.partitionBy("h", "w").orderBy("end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = cuts.select("h", "w", F.struct(F.count(F.lit(1)).over(running).cast("int").alias("g"), "a", "b", "a_at", "b_at").alias("cut"))
    each = cuts.groupBy("h", "w").agg(F.sort_array(F.collect_list("cut")).alias("cuts"))

    def ids(side):
        at = f"{side}_at"
        before = lambda x: F.when(x["g"] == 1, -1).otherwise(F.get("cuts", x["g"] - 2)[at])
        return lambda x: F.array_join(F.slice(side, before(x) + 2, x[at] - before(x)).cast("array<string>"), ",")

    a, b = ids("a"), ids("b")
    groups = F.array_join(F.transform("cuts", lambda x: F.concat(a(x), F.lit("|"), b(x))), ";")
    links = F.transform("cuts", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))
    return words.join(each, ["h", "w"]).select("h", "w", "word", "n", groups.alias("groups"), links.alias("links"))


def pair_counts(links: DataFrame) -> DataFrame:
    """a, b, count (of the pair's links, over links with their n) and best, whether it is its b's highest."""
    counts = stage(links.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))


def _with_sums(words: DataFrame, links: DataFrame, pairs: DataFrame, buckets: int) -> DataFrame:
    """words (h, w, ...) with best and total of their links (h, w, a, b). The most frequent pairs, FREQUENT at most, are broadcast and looked
    up where the links lie; the others are joined by the pair and dealt back."""
    frequent = F.broadcast(stage(pairs.orderBy(F.desc("count"), "a", "b").limit(FREQUENT), "frequent-pairs"))
    met = links.join(frequent, ["a", "b"], "left")
    sums = lambda rows, k: rows.groupBy("h", "w").agg(F.sum("best").alias(f"best_{k}"), F.sum("count").alias(f"total_{k}"))
    near = sums(met.filter("count IS NOT NULL"), 1)
    far = sums(met.filter("count IS NULL").select("h", "w", "a", "b").join(pairs, ["a", "b"]).select("h", "w", "best", "count").repartition(buckets, "h"), 2)
    plus = lambda x: (F.coalesce(f"{x}_1", F.lit(0)) + F.coalesce(f"{x}_2", F.lit(0))).alias(x)
    return words.join(near, ["h", "w"], "left").join(far, ["h", "w"], "left").select(*words.columns, plus("best"), plus("total"))


def _added_up(schema: T.StructType):
    def run(docs: pa.Table, entries: pa.Table) -> pa.Table:
        order = np.argsort(entries.column("number").to_numpy())  # all numbers from 0 on
        best, total = entries.column("best").to_numpy()[order], entries.column("total").to_numpy()[order]
        texts = entries.column("groups").combine_chunks().take(pa.array(order))
        del entries, order
        groups = pc.count_substring(texts, "|").to_numpy()
        commas = pc.count_substring(texts, ",").to_numpy()
        ours = pc.count_substring(pc.replace_substring_regex(texts, r"\|[0-9,]*", ""), ",").to_numpy() + groups
        theirs = commas + 2 * groups - ours
        texts, made = texts.to_pylist(), []
        pa.default_memory_pool().release_unused()
        unpack = zstandard.ZstdDecompressor()
        for packed in docs.column("words"):
            packed = packed.as_py()
            if packed is None:
                made.append((0, 0, 0, 0, 0, 0, ""))
                continue
            at = _bytes_to_numbers(unpack.decompress(packed))
            g = int(groups[at].sum())
            digest = sha256(";".join(map(texts.__getitem__, at.tolist())).encode()).hexdigest()
            made.append((int(ours[at].sum(dtype=np.int64)), int(theirs[at].sum(dtype=np.int64)), g, g, int(best[at].sum()), int(total[at].sum()), digest))
        columns = list(zip(*made, strict=True)) if made else [[]] * 7
        arrays = [pa.array(c, pa.string() if k == 6 else pa.int64()) for k, c in enumerate(columns)]
        return pa.table([docs.column("id").combine_chunks(), *arrays], names=schema.names)

    return run


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str = DEFAULT_A, b_path: str = DEFAULT_B) -> DataFrame:
    """One row per row of docs: id_col, n_a and n_b (tokens), n_groups, n_links, n_best (links whose pair is the most frequent of its
    B token), count_sum (of the links' pairs), groups_sha256."""
    spark, a, b = docs.sparkSession, read_model(a_path), read_model(b_path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([docs.schema[id_col], *T._parse_datatype_string("n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string").fields])
    path = new_path(spark, "dictionaries")
    made = _dictionaries(docs, id_col, text_col, check_models(a, b)).withColumn("is_entry", F.col("word").isNotNull())
    made.write.partitionBy("is_entry").parquet(path)
    read = spark.read.schema(made.schema).parquet
    entries = read(path).filter("is_entry").select(F.xxhash64("word").alias("h"), "word", "dictionary", "number", "n")
    entries = _stage_by(entries.repartition(buckets, "h"), "entries", "h", buckets)
    delete(spark, f"{path}/is_entry=true")
    with _joins_by_part_of_keys(spark):
        words = _encoded(entries.groupBy("h", "word").agg(F.sum("n").alias("n")), a, b).withColumn("w", F.monotonically_increasing_id())
        words = _stage_by(words, "words", "h", buckets)
        aligned = _stage_by(align_words(words), "aligned", "h", buckets)
        drop_staged(words)
        links = aligned.select("h", "w", "n", F.inline("links"))
        pairs = stage(pair_counts(links), "pairs")
        release(spark)
        told = _with_sums(aligned.select("h", "w", "word", "groups"), links.drop("n"), pairs, buckets)
        answers = entries.select("h", "word", "dictionary", "number").join(told, ["h", "word"]).select("dictionary", "number", "groups", "best", "total")
        texts = read(path).filter("NOT is_entry").select("dictionary", "id", "words")
        out = texts.groupBy("dictionary").cogroup(answers.groupBy("dictionary")).applyInArrow(_added_up(schema), schema)
        return stage(out, "alignment")
