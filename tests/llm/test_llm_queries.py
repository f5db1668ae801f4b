"""The registered corpus queries and the pipeline on the smallest tables, against SQL or a brute-force version."""

import hashlib
import math
import re
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pandas as pd
import pytest
import sentencepiece

from tidewright.llm import decontam, langid, licenses, queries, sentencepiece_codec

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def tables():
    return {t: pd.read_parquet(f"{SF}/{t}.parquet") for t in TABLES}


@pytest.fixture(scope="module")
def texts(tables):
    d = tables["documents"]
    return {int(i): t if isinstance(t, str) else "" for i, t in zip(d.doc_id, d.text, strict=True)}


def run(spark, name):
    return queries.queries()[name](spark, SF).collect()


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(queries.oracle_sql()[name])
    rows = run(spark, name)
    plain = lambda r: tuple(str(r[c]) for c in sorted(want.columns))
    assert sorted(rows[0].asDict()) == sorted(want.columns)
    assert sorted(plain(r.asDict()) for r in rows) == sorted(plain(dict(zip(want.columns, r, strict=True))) for r in want.fetchall())


def test_op1(spark, texts, tables):
    rows = {r.doc_id: r for r in run(spark, "op1_quality_classifier")}
    assert rows.keys() == texts.keys() and all(r.held_out == held_out(i) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for i, r in rows.items())
    assert {i: r.score for i, r in rows.items()} == {r.doc_id: r.score for r in run(spark, "op1_quality_classifier")}
    marked = tables["labels"][["doc_id", "quality"]].itertuples(index=False)
    seen = [(rows[i].predicted, q, rows[i].held_out) for i, q in marked]
    assert np.mean([p == q for p, q, held in seen if not held]) >= 0.9


def test_op2(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.DEFAULT_MODEL)
    for r in run(spark, "op2_sentencepiece"):
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.token_sha256, r.parity, r.exact) == (len(ids), hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest(), True, library.decode(ids) == texts[r.doc_id])


def test_op5(spark, texts, tables):
    langs = dict(zip(tables["documents"].doc_id, tables["documents"].lang, strict=True))
    rows = {r.doc_id: r for r in run(spark, "op5_language_id")}
    learned = {v for i, v in langs.items() if isinstance(v, str) and not held_out(i)}
    assert rows.keys() == texts.keys() and all(r.held_out == held_out(i) and 0 <= r.score <= 1 for i, r in rows.items())
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in texts[i])) and r.lang_pred in learned | {"und"} for i, r in rows.items())
    tested = [r.lang_pred == langs[i] for i, r in rows.items() if r.held_out and isinstance(langs[i], str) and r.lang_pred != "und"]
    assert np.mean(tested) >= 0.9


def leaks_of(texts, items):
    """Brute force: for each text the items that it holds, at any lag, by word lists; only pairs with too few shared words are
    passed over."""
    split = lambda t: re.findall(r"[^\W_]+", t.lower())
    cut = {k: split(t) for k, t in items.items()}
    found = {}
    for i, t in texts.items():
        words = split(t)
        for k, item in cut.items():
            least = min(12, math.ceil(0.8 * len(item) - 1e-9))
            if len(item) < decontam.LEAST_ITEM_WORDS or sum(w in set(item) for w in words) < least:
                continue
            for lag in range(1 - len(item), len(words)):
                same = np.array([words[lag + q] == item[q] for q in range(len(item)) if 0 <= lag + q < len(words)])
                if same.sum() >= least and any(s >= least and s >= 0.8 * (b - a) - 1e-9 for a in np.flatnonzero(same) for b in np.flatnonzero(same) + 1 if b > a for s in [same[a:b].sum()]):
                    found.setdefault(i, set()).add(k)
                    break
    return found


def test_op6(spark, texts, tables):
    items = {int(k): t for k, t in zip(tables["benchmark"].item_id, tables["benchmark"].text, strict=True)}
    expected = leaks_of(texts, items)
    rows = run(spark, "op6_decontamination")
    assert len(rows) == len(texts) and len(expected) >= 3
    for r in rows:
        assert (r.contaminated, r.n_items) == (r.doc_id in expected, len(expected.get(r.doc_id, ())))
        assert not r.contaminated or r.item_id in expected[r.doc_id]


def notices():
    for name, wording in licenses.WORDINGS:
        words = wording.split(" ")
        yield name, wording
        yield name, wording.upper()
        yield name, "\n * ".join(" ".join(words[k : k + 6]) for k in range(0, len(words), 6))


def test_op9_finds_planted_notices(spark, texts):
    """Every wording in three shapes at the start, in the middle and at the end of a text without licences."""
    prose = next(t for t in sorted(texts.values()) if 200 < len(t.split()) < 600 and not licenses.licenses_in(t) and not licenses._CUE.search(t)).split(" ")
    planted = missed = 0
    for name, notice in notices():
        for at in (0, len(prose) // 2, len(prose)):
            found = licenses.licenses_in(" ".join([*prose[:at], notice, *prose[at:]]))
            planted += 1
            missed += not any(x[2] == name and x[5] for x in found)
    assert missed <= 0.05 * planted, (missed, planted)
    assert all(r.doc_id in texts and texts[r.doc_id][r.block_start : r.block_end].strip() and (r.exact or r.differences) for r in run(spark, "op9_license_scan"))


def naive_spans(text):
    """The base kinds as the contract states them."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def test_op10(spark, texts):
    for r in run(spark, "op10_secret_scan"):
        base = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in naive_spans(texts[r.doc_id])]
        counts = tuple(sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex"))
        assert ((r.n_assign, r.n_access, r.n_hex), r.base_sha256) == (counts, hashlib.sha256(",".join(base).encode()).hexdigest())
        assert set(base) <= set(r.spans.split(","))


def test_pipeline(spark, texts, tables):
    """Every stage by brute force."""
    kept = {i: t for i, t in texts.items() if langid.has_letter(t)}
    last = {}
    for i in sorted(kept):
        last[kept[i]] = i
    kept = {i: t for t, i in last.items()}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for i, t in kept.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)} for i, w in words.items()}
    root = {i: i for i in kept}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in kept:
        for j in kept:
            if i < j and 100 * min(len(sets[i]), len(sets[j])) >= 75 * max(len(sets[i]), len(sets[j])) and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    kept = {i: kept[i] for i in kept if find(i) == i}
    leaks = leaks_of(kept, {int(k): t for k, t in zip(tables["benchmark"].item_id, tables["benchmark"].text, strict=True)})
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.DEFAULT_MODEL)
    expected = {i: library.encode(t) for i, t in kept.items() if i not in leaks}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: list(r.tokens) for r in rows} == expected and len(rows) == len(expected)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "SentencePiece encoding"]
