"""Language identification with error-correcting output codes.

Every language gets a codeword; each bit of it is predicted by a binary classifier over hashed character bigrams and
trigrams (smoothed log-odds of the languages whose bit is 1 against the others). Decoding adds up, for each language,
the loss of every bit's margin under its codeword, weighted by how well that bit did for that language in training,
and takes the nearest codeword. A text whose two nearest codewords are about as near is flagged as ambiguous.

Defined cases: a text that is null or has no letter is `und` with score 0 and is not ambiguous; with no labelled row
everything is `und`; with one language every text with a letter gets it; of languages equally near the first by name is taken.
Every row of the input gives one row, repeated ones too, and an empty table none; ids pass as they are, null ones too; other
columns, whatever their names, don't matter. Whole texts are read, however long. Training takes at most about MAX_PER_LANG texts
a language (a documented sample, drawn by a hash of the id) of at most MAX_LANGS languages; the counts that leave the executors
are bounded by languages x buckets.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import fresh, slices, stage, unit_hash

#: Labelled texts for each language that the classifiers are fitted on, about.
MAX_PER_LANG = 2000
#: Languages that are learned at most: those with the most labelled texts.
MAX_LANGS = 400
BUCKETS = 1 << 14  # for each of the two gram lengths
UNDETERMINED = "und"
_PIECE = 1 << 17  # code points handled at once
_ASCII_LETTER = re.compile("[A-Za-z]")
_SHARPNESS = 6.0


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text)


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1. Up to 6 classes: every way to part them. Beyond: the best separated of some fixed draws."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 6:
        parts = np.arange(1, 1 << (n - 1))
        return np.where((parts[None, :] >> np.arange(n)[:, None]) & 1, -1, 1).astype(np.int8)
    rng, best, far = np.random.default_rng(7), None, -1
    for _ in range(64):
        code = rng.choice(np.array([-1, 1], np.int8), (n, math.ceil(10 * math.log2(n))))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = (code.shape[1] - code.astype(int) @ code.T.astype(int)) // 2
        least = int((apart + np.eye(n, dtype=int) * 10**6).min())
        if least > far:
            best, far = code, least
    return best


def _gram_buckets(text: str) -> np.ndarray:
    """Buckets of the bigrams and trigrams of a text, lower-cased, with everything that isn't a letter in ASCII as space."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where((c < 128) & ((c < 97) | (c > 122)), 32, c).astype(np.uint32)
    two = c[:-1] * np.uint32(0x9E3779B1) ^ (c[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(3)
    three = two[:-1] * np.uint32(0xC2B2AE35) ^ c[2:] * np.uint32(0x27D4EB2F)
    mix = lambda h: ((h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(18)).astype(np.int32)
    return np.concatenate([mix(two), mix(three) + BUCKETS])


def _pieces(text: str):
    for at in range(0, max(len(text), 1), _PIECE):
        yield text[max(0, at - 2) : at + _PIECE]


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    scale: np.ndarray  # of each bit's margin
    trust: np.ndarray  # languages x bits, rows sum to 1

    def margins(self, texts: list[str]) -> np.ndarray:
        """The mean log-odds of each bit for each text, in units of the training texts' own."""
        out = np.zeros((len(texts), self.code.shape[1]))
        for a, b in slices([len(t) for t in texts], _PIECE):
            if b - a > 1:
                grams = [_gram_buckets(t) for t in texts[a:b]]
                sizes = np.array([len(g) for g in grams])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                out[a:b] = np.add.reduceat(self.weights[np.concatenate(grams)], starts, axis=0) / sizes[:, None]
            else:
                total = n = 0
                for piece in _pieces(texts[a]):
                    g = _gram_buckets(piece)
                    total, n = total + self.weights[g].sum(axis=0, dtype=np.float64), n + len(g)
                out[a] = total / n
        return out / self.scale

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest language, score and ambiguity of each row."""
        loss = np.log1p(np.exp(-2 * np.clip(self.code[None] * margins[:, None, :], -15, 15)))
        near = np.exp(-_SHARPNESS * (d := (loss * self.trust[None]).sum(axis=2)) + _SHARPNESS * d.min(axis=1, keepdims=True))
        near /= near.sum(axis=1, keepdims=True)
        best = near.argmax(axis=1)
        first = near.max(axis=1)
        second = np.sort(near, axis=1)[:, -2] if near.shape[1] > 1 else np.zeros(len(near))
        return best, first, second > 0.5 * first


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_per_lang: int = MAX_PER_LANG, max_langs: int = MAX_LANGS) -> Model:
    """Fit on the rows of labelled whose language isn't null."""
    known = labelled.filter(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()}
    langs = sorted(sizes)
    code = codewords(len(langs))
    bits = code.shape[1]
    if not langs:
        return Model([], np.ones((0, 1)), np.zeros((2 * BUCKETS, 1), np.float32), np.ones(1), np.ones((0, 1)))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, max_per_lang / n))])
    sample = stage(known.filter(unit_hash("id") < share[F.col("lang")]).select("text", "lang"), "langid-sample")

    def count(batches):
        counts = {}
        for pdf in batches:
            for text, lang in zip(pdf["text"], pdf["lang"], strict=True):
                for piece in _pieces(text or ""):
                    counts[lang] = counts.get(lang, 0) + np.bincount(_gram_buckets(piece), minlength=2 * BUCKETS)
        for lang, n in counts.items():
            (at,) = n.nonzero()
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})

    grams = sample.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(langs), 2 * BUCKETS))
    counts[grams["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy(int), grams["bucket"].to_numpy(int)] = grams["n"]
    weights = np.zeros((2 * BUCKETS, bits), np.float32)
    share_of = np.stack([(counts[:, half] + 0.2) / (counts[:, half].sum(axis=1, keepdims=True) + 0.2 * BUCKETS) for half in (slice(0, BUCKETS), slice(BUCKETS, None))], axis=1).reshape(len(langs), -1)
    for b in range(bits):
        one, other = code[:, b] > 0, code[:, b] < 0
        if one.any() and other.any():
            weights[:, b] = np.log(share_of[one].mean(axis=0)) - np.log(share_of[other].mean(axis=0))
    model = Model(langs, code, weights, np.ones(bits), np.ones((len(langs), bits)) / bits)

    def measure(batches):
        for pdf in batches:
            m = model.margins([t or "" for t in pdf["text"]])
            yield pd.DataFrame({"lang": np.repeat(pdf["lang"].to_numpy(), bits), "bit": np.tile(np.arange(bits), len(pdf)), "margin": m.ravel()})

    seen = sample.mapInPandas(measure, "lang string, bit int, margin double").groupBy("lang", "bit").agg(F.avg(F.abs("margin")).alias("size"), F.avg((F.col("margin") > 0).cast("double")).alias("up")).toPandas()
    size, right = np.ones((len(langs), bits)), np.full((len(langs), bits), 0.5)
    for r in seen.itertuples():
        i = langs.index(r.lang)
        size[i, r.bit] = r.size
        right[i, r.bit] = r.up if code[i, r.bit] > 0 else 1 - r.up
    trust = np.maximum(right, 0.01)
    return Model(langs, code, weights, np.maximum(size.mean(axis=0), 1e-6), trust / trust.sum(axis=1, keepdims=True))


def predictor(model: Model):
    """A pandas UDF: text -> struct(lang_pred, score, ambiguous)."""

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        lang, score, doubt = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts)), np.zeros(len(texts), bool)
        at = [i for i, t in enumerate(texts) if isinstance(t, str) and has_letter(t)] if model.langs else []
        if at:
            values = texts.to_numpy(object)
            best, score[at], doubt[at] = model.decode(model.margins([values[i] for i in at]))
            lang[at] = np.array(model.langs, object)[best]
        return pd.DataFrame({"lang_pred": lang, "score": score, "ambiguous": doubt})

    return predict


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """One row per row of docs: id_col, the columns in more, lang_pred, score, ambiguous."""
    (p,) = fresh(docs.columns, "predicted")
    return docs.select(F.col(id_col), *more, predictor(model)(F.col(text_col).cast("string")).alias(p)).select(F.col(id_col), *[F.col(c) for c in _names(docs, more)], f"{p}.*")


def _names(docs: DataFrame, columns) -> list[str]:
    return docs.select(*columns).columns if columns else []


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text has a language: what is `und` goes. A model without languages
    can't judge, so texts with a letter then stay."""
    text = F.col(text_col).cast("string")
    if not model.langs:
        lettered = F.pandas_udf(lambda texts: texts.map(lambda t: isinstance(t, str) and has_letter(t)), "boolean")
        return docs.filter(lettered(text))
    (p,) = fresh(docs.columns, "predicted")
    return docs.withColumn(p, predictor(model)(text)).filter(F.col(p)["lang_pred"] != UNDETERMINED).drop(p)
