"""SentencePiece models on the tokenizers library: encoding and decoding.

The model file (a protobuf) is parsed here: pieces with their scores and kinds, the trainer's kind of model and the
normaliser. From these a tokenizer is rebuilt: the precompiled normaliser, squeezing of spaces, the dummy prefix and the marker
in place of spaces as the tokenizer's own normaliser, the pieces (with scores for a unigram model, with merges in order of score
for a BPE model) and byte fallback. Whole texts are encoded in multithreaded batches. Every text is encoded whole
with the SentencePiece library too and compared, id by id; a smaller share, drawn by a hash of the text, may be asked for.

The model file is read once, on the driver, and its bytes go with the tasks. Models with user-defined pieces, which cut a text
before it is normalised, are refused. The default model is BPE; unigram models are tested on one that is made by hand.

Defined cases: null and empty texts have no tokens and decode to the empty text; a text of any length is encoded whole; every
row gives one row, repeated ones too, and an empty table none; ids pass as they are, null ones too; other columns, whatever
their names, are not read; a text decodes to its normalised form, which `exact` compares with the text itself.
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import fresh, text_slices

#: Where the public tokenizer files are; a parameter of every function that reads one.
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Kinds of pieces and of models, as the public protobuf definition numbers them.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: The share of texts that are compared with the SentencePiece library.
PARITY_SHARE = 1.0
_BYTES_AT_ONCE = 1 << 19
_CONTROL_TEXT = "\0"  # stands before control pieces, which no text has


def _fields(data: bytes):
    """(number, value) of each field of a protobuf message; a nested message or string is bytes."""

    def varint(at):
        value = shift = 0
        while True:
            b = data[at]
            value, shift, at = value | (b & 127) << shift, shift + 7, at + 1
            if b < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        elif key & 7 == 2:
            n, at = varint(at)
            value, at = data[at : at + n], at + n
        else:
            n = {1: 8, 5: 4}[key & 7]
            value, at = struct.unpack("<d" if n == 8 else "<f", data[at : at + n])[0], at + n
        yield key >> 3, value


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]]  # text, score, kind
    kind: int
    charsmap: bytes
    dummy_prefix: bool
    squeeze: bool  # runs of spaces become one, none at the ends
    byte_fallback: bool

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def parse_model(data: bytes) -> PieceModel:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            x = dict(_fields(value))
            pieces.append((x.get(1, b"").decode(), x.get(2, 0.0), x.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    return PieceModel(pieces, trainer.get(3, UNIGRAM), normalizer.get(2, b""), bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1)), bool(trainer.get(35, 0)))


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """The pairs that make up each piece, best score first."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = [(-model.pieces[i][1], i, k, p[:k], p[k:]) for p, i in ids.items() if model.pieces[i][2] != UNUSED for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
    return [(a, b) for *_, a, b in sorted(found)]


def build(model: PieceModel):
    """The tokenizer of a model, which takes whole texts."""
    from tokenizers import Regex, Tokenizer, models, normalizers

    if any(kind == USER_DEFINED for *_, kind in model.pieces):
        raise ValueError("models with user-defined pieces are not supported")
    if model.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        out = Tokenizer(models.BPE(vocab=vocab, merges=_merges(model), unk_token=model.pieces[model.unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback))
    else:
        out = Tokenizer(models.Unigram([(_CONTROL_TEXT + p if kind in (CONTROL, UNUSED) else p, s) for p, s, kind in model.pieces], model.unknown, model.byte_fallback))
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex(" +"), " "), normalizers.Replace(Regex("^ | $"), "")]
    steps += [normalizers.Prepend(MARK)] if model.dummy_prefix else []
    out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    return out


def is_compared(text: str, share: float) -> bool:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) < share * (1 << 32)


class Codec:
    def __init__(self, data: bytes, threads: int = 2):
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.model = parse_model(data)
        self.tokenizer = build(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.threads = threads
        self.pieces = [p for p, _, _ in self.model.pieces]
        self.kinds = [k for _, _, k in self.model.pieces]
        self.texts = [chr(b) if k == BYTE and (b := int(p[3:5], 16)) < 128 else "" if k == CONTROL else " ⁇ " if k == UNKNOWN else p for p, _, k in self.model.pieces]
        self.high = {i for i, (p, _, k) in enumerate(self.model.pieces) if k == BYTE and int(p[3:5], 16) > 127}

    def encode_batch(self, texts: list[str], share: float = PARITY_SHARE) -> list[tuple[list[int], bool | None]]:
        """(ids, parity) of each text; parity is None for a text that is not compared."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        compared = [i for i, t in enumerate(texts) if is_compared(t, share)]
        theirs = self.reference.encode([texts[i] for i in compared], num_threads=self.threads)
        same = dict(zip(compared, (ids[i] == x for i, x in zip(compared, theirs, strict=True)), strict=True))
        return [(x, same.get(i)) for i, x in enumerate(ids)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes put together (what isn't UTF-8 becomes U+FFFD), markers as spaces, the first one off."""
        if self.high.isdisjoint(ids):
            text = "".join(map(self.texts.__getitem__, ids))
        else:
            raw = b"".join(bytes([int(self.pieces[i][3:5], 16)]) if i in self.high else self.texts[i].encode() for i in ids)
            text = raw.decode("utf-8", "replace")
        text = text.replace(MARK, " ")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def _codec(data: bytes, threads: int) -> Codec:
    return Codec(data, threads)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = DEFAULT_MODEL, threads: int = 2, with_tokens: bool = False, parity_share: float = PARITY_SHARE) -> DataFrame:
    """One row per row of docs: id_col, n_tokens, token_sha256 (of the ids as 32-bit little-endian numbers), parity (whether the
    ids are those of the SentencePiece library; null where not compared), exact (the ids decode to the text itself), and tokens
    if asked."""
    added = T._parse_datatype_string("n_tokens long, token_sha256 string, parity boolean, exact boolean" + ", tokens array<int>" * with_tokens)
    schema = T.StructType([docs.schema[id_col], *[T.StructField(n, f.dataType) for n, f in zip(fresh([id_col], *added.names), added.fields, strict=True)]])
    data = read_model(model_path)

    def encoded(batches):
        codec = _codec(data, threads)
        for batch in batches:
            for a, b in text_slices(batch.column(1), _BYTES_AT_ONCE):
                texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                found = codec.encode_batch(texts, parity_share)
                ids = [np.array(x, "<i4") for x, _ in found]
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]),
                    pa.array([same for _, same in found], pa.bool_()),
                    pa.array([codec.decode(x) == t for (x, _), t in zip(found, texts, strict=True)]),
                ]
                if with_tokens:
                    columns.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32), pa.array(np.concatenate(ids))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(encoded, schema)


def decode(rows: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens", model_path: str = DEFAULT_MODEL, threads: int = 2) -> DataFrame:
    """id_col and the text of each row's tokens; null tokens give the empty text, unknown ids are an error."""
    data = read_model(model_path)

    @F.pandas_udf(T.StringType())
    def texts(lists: pd.Series) -> pd.Series:
        codec = _codec(data, threads)
        return pd.Series([codec.decode([] if x is None else list(x)) for x in lists])

    return rows.select(F.col(id_col), texts(F.col(tokens_col)).alias("text"))
