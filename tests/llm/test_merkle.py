"""The Merkle manifest on every defined case, against a tree built level by level."""

import random
import zlib
from hashlib import sha256

import pytest

from tidewright.llm import merkle


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def up(levels, i, h):
    """(siblings, root that h leads to) from place i."""
    siblings = []
    for nodes in levels[:-1]:
        run = list(range(i - i % 8, min(i - i % 8 + 8, len(nodes))))
        siblings += [nodes[k] for k in run if k != i]
        h, i = H(*(h if k == i else nodes[k] for k in run)), i // 8
    return siblings, h


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            own = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                own = leaf((*r[:4], None if r[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            a, sub = up(trees[g], i, own)
            b, root = up(top, k, sub)
            yield r[0], leaf(r), trees[g][-1][0], top[-1][0], H(*a, *b), root, root == top[-1][0]


LANGS = ["en", None, "", "é", "zz", *[f"l{k}" for k in range(9)]]


def rows_of(n, seed):
    rng = random.Random(seed)
    texts = [None, "", "Aé Z", "a", "x" * 200_000 + "Q", "同じ", "ABC\n"]
    rows = [(rng.choice([None, *range(n)]), rng.choice(["s", None]), "en" if rng.random() < 0.7 else rng.choice(LANGS), rng.choice([None, 3]), rng.choice(texts)) for _ in range(n)]
    return rows + rows[: n // 10]


@pytest.mark.parametrize("n", [0, 1, 7, 70, 900])
def test_manifest(spark, n):
    rows = rows_of(n, n)
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, h string, path string")
    got = merkle.check(merkle.manifest(docs, tampered=merkle.is_tampered())).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_many_groups_and_blocks(spark, monkeypatch):
    """Blocks of 8 leaves, so that several distributed walks follow each other for leaves and for groups."""
    monkeypatch.setattr(merkle, "DEPTH", 1)
    rows = [(k, "s", f"g{k % 70}" if k % 3 else "hot", k, f"Text {k}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.check(merkle.manifest(docs, tampered=merkle.is_tampered())).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_untampered_leaves_verify(spark):
    docs = spark.createDataFrame([(k, "s", "en", k, "T") for k in range(20)], "doc_id long, source string, lang string, n_chars long, text string")
    assert all(r.verified and r.folded_root == r.root for r in merkle.check(merkle.manifest(docs)).collect())
