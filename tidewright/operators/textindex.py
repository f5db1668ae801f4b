"""Search in texts through a stored index of their trigrams.

An index has segments, one for each append: its rows by parts of their key's hash, the distinct trigrams of each text (in lower case, the
text's end being filled up, so that every place begins one), laid out by trigram so that few files and row groups hold one, and how many rows each trigram has.
A trigram is one whole number, 21 bits a sign, and stands with lists of the keys whose texts hold it: a list for each few million signs of
texts, so that lists are moved and sorted rather than single keys, and a trigram that most texts have is still many rows.
A segment counts once its manifest is there, so an append that dies leaves nothing that is read; appends under a number are written once.

A search for a LIKE pattern takes the trigrams of the stretches between its wildcards. The rarest few are looked up, rarest first, each
meeting leaving fewer rows; then only the parts that hold candidates are read, and the candidates' texts are compared with the pattern
itself. A stretch of one or two characters takes all trigrams that begin with it; a pattern without any stretch reads all rows. Where
candidates are too many to be sent to every task, all texts of their parts are compared, which gives the same rows.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators.files import Folder

_GRAM = 3
#: Stands for what is not there after a text's end.
_END = "\x00"
#: Bits of a sign in a trigram's number.
_BITS = 21
#: The form of stored trigrams, which manifests name.
_FORM = 2
#: How many bytes of texts share lists (one text more at most).
_STRETCH = 1 << 22
#: How many of a pattern's trigrams are looked up, rarest first; the comparison of texts does the rest.
MOST_GRAMS = 4
#: How many candidates are sent to every task; where there are more, all texts of their parts are compared.
MOST_SENT = 100_000


def number_of(signs: str) -> int:
    """A trigram as a number; of fewer signs the first number of those that begin with them."""
    out = 0
    for sign in signs.ljust(_GRAM, _END):
        out = out << _BITS | ord(sign)
    return out


def grams_of(text: bytes) -> np.ndarray:
    """The distinct trigrams of a text in UTF-8, as numbers in order."""
    signs = np.frombuffer((text.decode("utf-8", "replace") + _END * (_GRAM - 1)).encode("utf-32-le"), "<u4").astype(np.int64)
    places = len(signs) - _GRAM + 1
    numbers = signs[:places]
    for k in range(1, _GRAM):
        numbers = numbers << _BITS | signs[k : k + places]
    return np.unique(numbers)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, key, text (bytes) -> gram, part, n, keys: the keys of a stretch of rows whose texts hold a trigram."""
    for batch in batches:
        sizes = pc.binary_length(batch["text"]).fill_null(0).to_numpy()
        ends = np.cumsum(sizes)
        cuts = np.searchsorted(ends, np.arange(_STRETCH, ends[-1] if len(ends) else 0, _STRETCH)) + 1
        for rows in np.split(np.arange(len(sizes)), cuts):
            rows = rows[sizes[rows] > 0]
            parts = batch["part"].take(pa.array(rows)).to_numpy()
            for part in np.unique(parts):
                own = rows[parts == part]
                found = [grams_of(t.as_py()) for t in batch["text"].take(pa.array(own))]
                grams = np.concatenate(found)
                order = np.argsort(grams)
                keys = batch["key"].take(pa.array(np.repeat(own, [len(g) for g in found])[order]))
                grams = grams[order]
                starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
                bounds = np.append(starts, len(grams)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), keys)
                yield pa.RecordBatch.from_arrays([pa.array(grams[starts]), pa.array(np.full(len(starts), part, np.int32)), pa.array(np.diff(bounds)), lists], names=["gram", "part", "n", "keys"])


def stretches(pattern: str) -> list[str]:
    """The texts between the wildcards of a LIKE pattern; a backslash takes the next sign as it is."""
    out, own = [], ""
    for sign in re.findall(r"\\.|.", pattern, re.S):
        if sign in ("%", "_"):
            out.append(own)
            own = ""
        else:
            own += sign[-1]
    return [s for s in (*out, own) if s]


def straight_regex(pattern: str) -> str | None:
    """A LIKE pattern of two pieces and more between its %, as a regular expression that takes each piece where it first fits and never
    looks for another place, as pieces have fixed lengths; null where the pattern has fewer pieces or is no valid one."""
    if not re.fullmatch(r"(\\[%_\\]|[^\\])*", pattern, re.S):
        return None
    pieces = [""]
    for sign in re.findall(r"\\.|.", pattern, re.S):
        if sign == "%":
            pieces.append("")
        else:
            pieces[-1] += "." if sign == "_" else re.sub(r"[^\w\s]", r"\\\g<0>", sign[-1], flags=re.A) if sign[-1].isascii() else sign[-1]
    first, *middle, last = pieces if len(pieces) > 1 else (*pieces, "")
    if sum(p != "" for p in pieces) < 2:
        return None
    return "(?s)^" + first + "".join(f"(?>.*?{p})" for p in middle if p) + (f".*{last}\\z" if last else "")


class TextIndex:
    def __init__(self, spark: SparkSession, path: str, key: str, text: str, parts: int = 64):
        self.spark, self.path, self.key, self.text = spark, path.rstrip("/"), key, text
        self.folder = Folder(spark, self.path)
        segments = self.segments()
        self.parts = segments[0]["parts"] if segments else parts

    def segments(self) -> list[dict]:
        out = [json.loads(self.folder.read(f"segments/{n}")) for n in self.folder.names("segments") if n.endswith(".json")]
        if any(s.get("form") != _FORM for s in out):
            raise ValueError(f"{self.path} has segments of another form: append their rows to a new index")
        return out

    def append(self, rows: DataFrame, number: int | None = None) -> bool:
        """Add rows (with any columns beside key and text) as a segment; false if the segment of that number is there already. Keys are
        rows' own: a key that comes again is a row of its own."""
        numbers = [s["number"] for s in self.segments()]
        number = max(numbers, default=-1) + 1 if number is None else number
        if number in numbers:
            return False
        place = f"data/{number}-{uuid.uuid4().hex}"
        part = F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")
        rows.withColumn("_part", part).hint("rebalance", "_part").sortWithinPartitions("_part", self.key).write.partitionBy("_part").parquet(f"{self.path}/{place}/rows")
        written = self.spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType())])).parquet(f"{self.path}/{place}/rows")
        texts = written.select(F.col("_part").alias("part"), F.col(self.key).alias("key"), F.lower(self.text).cast("binary").alias("text"))
        key = T.StructField("key", texts.schema["key"].dataType)
        postings = texts.mapInArrow(_lists, self._form_of_postings(key.dataType))
        # a trigram that most texts have is split over several files, each in order
        postings.hint("rebalance", "gram").sortWithinPartitions("gram", "part").write.parquet(f"{self.path}/{place}/postings")
        stored = self.spark.read.schema(postings.schema).parquet(f"{self.path}/{place}/postings")
        stored.groupBy("gram").agg(F.sum("n").alias("rows")).sortWithinPartitions("gram").write.parquet(f"{self.path}/{place}/counts")
        told = {"number": number, "place": place, "parts": self.parts, "schema": rows.schema.jsonValue(), "key": key.dataType.jsonValue(), "form": _FORM}
        return self.folder.create(f"segments/{number}.json", json.dumps(told))

    @staticmethod
    def _form_of_postings(key: T.DataType) -> T.StructType:
        return T.StructType([T.StructField("gram", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("keys", T.ArrayType(key))])

    def _read(self, what: str, schema: T.StructType | str) -> DataFrame:
        kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        paths = [f"{self.path}/{s['place']}/{what}" for s in self.segments()]
        if not paths:
            return self.spark.createDataFrame([], kind)
        out = None
        for p in paths:
            one = self.spark.read.schema(kind).parquet(p)
            out = one if out is None else out.unionByName(one)
        return out

    def rows(self) -> DataFrame:
        """Every row, with the part that it lies in."""
        segments = self.segments()
        if not segments:
            raise ValueError(f"no segment of {self.path}")
        fields = T.StructType.fromJson(segments[-1]["schema"]).fields
        return self._read("rows", T.StructType([*fields, T.StructField("_part", T.IntegerType())]))

    def postings(self) -> DataFrame:
        """gram, part, n, keys; a trigram has a row for each stretch of texts and part."""
        return self._read("postings", self._form_of_postings(T._parse_datatype_json_value(self.segments()[0]["key"])))

    def _lowered(self, pattern: str) -> str:
        """As Spark lowers both sides of ILIKE, the pattern as a whole."""
        return self.spark.sql("SELECT lower(:p)", {"p": pattern}).first()[0]

    def candidates(self, pattern: str) -> DataFrame | None:
        """key, part of the rows that hold the pattern's rarest trigrams; null where the pattern has no stretch to look up."""
        found = stretches(self._lowered(pattern))
        whole = sorted({number_of(s[k : k + _GRAM]) for s in found for k in range(len(s) - _GRAM + 1)})
        short = sorted({s for s in found if len(s) < _GRAM}, key=len)
        counts, postings = self._read("counts", "gram long, rows long"), self.postings()
        keys_where = lambda held: postings.filter(held).select(F.explode("keys").alias("key"), "part").distinct()
        if whole:
            # a row for each trigram of the pattern at most
            known = {r.gram: r.rows for r in counts.filter(F.col("gram").isin(whole)).groupBy("gram").agg(F.sum("rows").alias("rows")).collect()}
            rarest = sorted(whole, key=lambda g: (known.get(g, 0), g))[:MOST_GRAMS]
            lists = [keys_where(F.col("gram") == g) for g in rarest]
        elif short:
            low = number_of(short[-1])
            lists = [keys_where((F.col("gram") >= low) & (F.col("gram") < low + (1 << _BITS * (_GRAM - len(short[-1])))))]
        else:
            return None
        out = lists[0]
        for other in lists[1:]:
            out = out.intersect(other)  # as null keys meet, too
        return out

    def _matches(self, pattern: str) -> Column:
        """Whether the text is ILIKE the pattern. With several pieces, the regular expression of LIKE tries every place of each one."""
        straight = straight_regex(self._lowered(pattern))
        return F.col(self.text).ilike(pattern) if straight is None else F.lower(self.text).rlike(straight)

    def search(self, pattern: str) -> DataFrame:
        """The rows whose text is ILIKE the pattern, read from the parts that hold candidates alone."""
        rows, found, match = self.rows(), self.candidates(pattern), self._matches(pattern)
        if found is None:
            return rows.filter(match).drop("_part")
        found = found.withColumn("_hit", F.lit(True)).persist()
        held = {r["part"]: r["count"] for r in found.groupBy("part").count().collect()}  # at most as many as parts
        near = rows.filter(F.col("_part").isin(list(held))) if held else rows.limit(0)
        if sum(held.values()) > MOST_SENT:
            found.unpersist()
            return near.filter(match).drop("_part")
        keyed = F.broadcast(found.select(F.col("key").alias("_key"), F.col("part").alias("_in"), "_hit"))
        both = near.join(keyed, (near["_part"] == keyed["_in"]) & near[self.key].eqNullSafe(keyed["_key"]))
        # the condition names a column of the other side, so that only candidates' texts are compared
        return both.filter(F.when(F.col("_hit"), match)).drop("_part", "_key", "_in", "_hit")

    def compact(self) -> None:
        """All segments as one; the old ones stay readable until the new manifest is there."""
        before = self.segments()
        rows, number = self.rows().drop("_part"), max(s["number"] for s in before) + 1
        self.append(rows, number)
        for s in before:
            self.folder.remove(f"segments/{s['number']}.json")
            self.folder.remove(s["place"])
