"""Removal of repeated 100-byte strings against a dictionary of all of them."""

import random
from hashlib import sha256

import numpy as np
import pandas as pd
import pytest

from tidewright.llm import queries, repeats

SF = "/root/testdata/sf0.001"


def brute(rows):
    """rows of different (id, text), in the order of documents."""
    seen = set()
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            gone[s : s + 100] |= window in seen
            seen.add(window)
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) > 0))
        kept = bytes(b for b, g in zip(data, gone.tolist(), strict=True) if not g)
        yield i, len(data), int(gone.sum()), runs, sha256(kept).hexdigest()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


WORDS = [f"w{k}é" if k % 7 == 0 else f"word{k}" for k in range(300)]


def documents(seed):
    rng = random.Random(seed)
    shared = [prose(rng, 30) for _ in range(6)]
    line = "a common line that stands in many texts, of eighty bytes or so, and is no match."
    texts = []
    for k in range(120):
        parts = [prose(rng, rng.randrange(1, 60)), rng.choice(shared)[: rng.randrange(80, 200)], line, prose(rng, rng.randrange(20))]
        rng.shuffle(parts)
        texts.append(rng.choice([" ", "", "\n"]).join(parts))
    texts += [texts[3], texts[3], texts[5][:150], texts[5] + "x", "x" * 99, "x" * 100, "x" * 101, "y" * 500, "ab" * 300, "ab" * 40, "", None, "\0" * 250, "同じ" * 60, "🙂" * 80]
    texts += [prose(rng, 20) + texts[9][:120] + prose(rng, 20) + texts[9][:120]]
    return list(enumerate(texts, 10))


CASES = [(1, prose(random.Random(1), 4000)), (2, "x" + prose(random.Random(1), 4000)[5000:9000]), (3, None)]


@pytest.mark.parametrize("hot", [1 << 16, 3])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = [(None, "null id " + prose(random.Random(8), 40)), *CASES, *documents(4), (500, "null id " + prose(random.Random(8), 40))]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, spans string, n_bytes long")
    assert sorted(map(tuple, repeats.remove_repeats(docs).collect()), key=str) == sorted(brute(rows), key=str)


def test_parts_of_a_long_text(monkeypatch):
    """Read in parts, a text's windows still have a piece each, with the same anchors."""
    data = np.frombuffer(CASES[0][1].encode(), np.uint8)

    def windows():
        _, start, size, at, h = repeats.runs_of(data, np.array([0, len(data)]))
        return {s + k: (s + a, v) for s, n, a, v in zip(start.tolist(), size.tolist(), at.tolist(), h.tolist(), strict=True) for k in range(n)}, int(size.sum())

    whole = windows()
    monkeypatch.setattr(repeats, "_STARTS", 700)
    assert windows() == whole and whole[1] == len(whole[0]) == len(data) - 99


def test_one_document_in_two_rows(spark):
    text = prose(random.Random(3), 60)
    got = repeats.remove_repeats(spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")).collect()
    n = len(text.encode())
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, n)]


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_columns():
    """The column-wise order of pieces alone, against all pairs."""
    rng = random.Random(2)
    base = [bytes(rng.choice(b"abc") for _ in range(168)) for _ in range(4)]
    pieces, anchors = [], []
    for _ in range(200):
        a, b = rng.randrange(0, 60), rng.randrange(130, 169)
        p = bytearray(rng.choice(base)[a:b])
        if rng.random() < 0.3:
            p[rng.randrange(len(p))] = 120
        pieces.append(bytes(p))
        anchors.append(65 - a)
    want = set()
    for i, p in enumerate(pieces):
        for s in range(len(p) - 99):
            if any(q[s - anchors[i] + anchors[j] :][:100] == p[s : s + 100] for j, q in enumerate(pieces[:i]) if s - anchors[i] + anchors[j] >= 0):
                want.add((i, s))
    got = set(zip(*(x.tolist() for x in repeats.repeats_in_columns(pieces, anchors)), strict=True))
    assert got == want


def test_query(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    rows = [(int(i), t if isinstance(t, str) else None) for i, t in zip(docs.doc_id, docs.text, strict=True)]
    got = queries.queries()["op13_suffix_dedup"](spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows))
