"""Token alignment against whole texts encoded by both libraries and walked through in order."""

import random
from collections import Counter
from hashlib import sha256

import pandas as pd
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewright.llm import alignment, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(alignment.DEFAULT_A)
    a.encode_special_tokens = True
    signs = alignment.byte_alphabet()
    a_bytes = {i: bytes(signs.get(c, 63) for c in t) for t, i in a.get_vocab().items()}
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.DEFAULT_B)
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    return a, a_bytes, b, b_bytes


def tokens(text, both):
    a, a_bytes, b, b_bytes = both
    if not text:
        return [], []
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    want = (" " + text).encode()
    if b"".join(a_bytes[i] for i in x) != want or b"".join(b_bytes[i] for i in y) != want:
        return [], []
    return x, y


def brute(rows, both):
    _, a_bytes, _, b_bytes = both
    found, counts = [], Counter()
    for i, text in rows:
        x, y = tokens(text, both)
        ends, at = {}, 0
        for t in x:
            at += len(a_bytes[t])
            ends.setdefault(at, [[], []])[0].append(t)
        at = 0
        for t in y:
            at += len(b_bytes[t])
            ends.setdefault(at, [[], []])[1].append(t)
        groups, links, own = [], [], [[], []]
        for end in sorted(ends):
            p, q = ends[end]
            own[0] += p
            own[1] += q
            if p and q:
                links.append((p[-1], q[-1]))
                groups.append(own)
                own = [[], []]
        counts.update(links)
        found.append((i, len(x), len(y), groups, links))
    best = Counter()
    for (_, q), n in counts.items():
        best[q] = max(best[q], n)
    for i, n_a, n_b, groups, links in found:
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        yield i, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha256(text.encode()).hexdigest() if groups else ""


CASES = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "tab\t x", "\n", "é è naïve café x", "x  y", "▁ mark ▁x", "<|endoftext|> <s> </s> <unk> <0x0A> x", "日本語 の テスト", "👍 ok 👍🏽 ok",
    "word " * 3000, "w" * 20_000, "don't we're x's", "a.b,c; d-e (f) 'g'", "\0 nul \0", "12 345 6,789.00", "  x \u0085 y", "x　 y", "﻿ bom", "#include <a>  \n\treturn  0;\n}", "a" * 30 + " " * 70 + "b", "٣ ४ x", "ß̀ x‍ y",
    "a\x1c b \x1d c", "a\u2009 b\u202f c", "x\u00a0 y \u00a0z", "_ _x -- '' \u2028 q", "I'll 'S 'LL we'VE ''s",
]


def test_every_case(spark, both):
    rows = [(k, t) for k, t in enumerate(CASES)] + [(3, "again again"), (3, "again again"), (None, "a b c"), (None, None)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, words string, n_a long")
    assert sorted(map(tuple, alignment.align(docs).collect()), key=str) == sorted(brute(rows, both), key=str)


def test_random_texts(spark, both, monkeypatch):
    monkeypatch.setattr(alignment, "DICTIONARY_BYTES", 2000)
    rng = random.Random(5)
    monkeypatch.setattr(alignment, "FREQUENT", 20)
    signs = "ab eE é日 \n\t.,'-1   ▁xyz the The ing ed 's" * 3
    rows = [(k, "".join(rng.choice(signs if k % 9 else signs.replace("▁", "")) for _ in range(rng.randrange(200))).replace("▁", "" if k % 7 else "▁")) for k in range(400)]
    got = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, both))


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_words_join_to_the_text():
    for t in CASES:
        assert not t or "▁" in t or " ".join(alignment.words_of(t)) == t


def test_query(spark, both):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    rows = [(int(i), t if isinstance(t, str) else None) for i, t in zip(docs.doc_id, docs.text, strict=True)]
    got = queries.queries()["op12_token_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, both))
