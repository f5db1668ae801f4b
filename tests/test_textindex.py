"""Search through the trigram index against a scan."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidewright.operators import textindex
from tidewright.operators.textindex import TextIndex, grams_of, number_of, straight_regex, stretches

FORM = "id long, text string, code string"


def texts():
    rng = random.Random(6)
    words = ["Alpha", "beta", "ΓΆΜΜΑ", "売上高", "純利益", "İstanbul", "ab", "a", "100%", "x_y", "straße", "\\path", "é"]
    rows = [(k, rng.choice([" ", ""]).join(rng.choice(words) for _ in range(rng.randrange(12))), f"c{k % 3}") for k in range(300)]
    return [*rows, (300, None, "c"), (301, "", "c"), (302, "a", "c"), (303, "ab", "c"), (304, "x" * 50_000 + "needle", "c"), (7, "again the same key, needle", "c"), (305, "nul \x00 inside", "c")]


PATTERNS = ["%alpha%", "%ALPHAbeta%", "%売上高%", "%高%", "%ab%", "%a%", "%", "", "alpha%", "%beta", "%al_ha%", "%100\\%%", "%x\\_y%", "%γάμμα%", "%nothing like it%", "%needle%", "%İstan%", "%straße%", "a", "%é%", "%利益%売上%", "%\\\\path%"]


def test_search_finds_what_a_scan_finds(spark, tmp_path):
    rows = texts()
    df = spark.createDataFrame(rows, FORM)
    index = TextIndex(spark, str(tmp_path / "i"), "id", "text", 8)
    assert index.append(df.filter("id % 2 = 0"), 0) and index.append(df.filter("id % 2 = 1"), 1) and not index.append(df, 1)
    for pattern in PATTERNS:
        want = sorted((r.id, r.code) for r in df.filter(F.col("text").ilike(pattern)).collect())
        assert sorted((r.id, r.code) for r in index.search(pattern).collect()) == want, pattern
    index.compact()
    assert [s["number"] for s in index.segments()] == [2]
    assert index.search("%needle%").count() == 2


def test_texts_are_not_scanned(spark, tmp_path):
    df = spark.range(2000).select("id", F.concat(F.lit("row "), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    index = TextIndex(spark, str(tmp_path / "i"), "id", "text", 50)
    index.append(df)
    (wanted,) = df.filter("id = 1234").select("text").first()
    found = index.search(f"%{wanted[10:40]}%")
    assert [r.id for r in found.collect()] == [1234]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(_part" in plan or "PartitionFilters: [isnotnull(_part" in plan or "_part#" in plan
    assert len({f.split("_part=")[1].split("/")[0] for f in found.inputFiles() if "_part=" in f}) <= 50
    # postings of one trigram are read by a filter that reaches the files
    assert "PushedFilters: [IsNotNull(gram), EqualTo(gram" in index.candidates(f"%{wanted[10:40]}%")._jdf.queryExecution().executedPlan().toString()


def test_stretches():
    assert stretches("%a_bc%\\%d%") == ["a", "bc", "%d"] and stretches("%%") == [] and stretches("abc") == ["abc"]


SEVERAL = ["%the%of_the%", "%beta%ab%", "alpha%ab", "%a%_", "%a%b%a%", "_l%\\%%", "%x\\_y%\\\\%", "%ΟΔΟΣ%", "%ΓΆΜΜΑ_%売%", "%nul \x00%e", "%(%.%", "a%a", "%ß%e%_%", "%İ%a%"]


@pytest.mark.parametrize("most", [100_000, 0])
def test_null_keys_and_patterns_of_several_pieces(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(textindex, "MOST_SENT", most)
    odd = [(None, "THE end of the\nthe (a.b) needle", "n"), (None, "of the the", "m"), (900, "οδος ΟΔΟΣΑ", "c"), (901, "a", "c"), (902, "aa", "c"), (903, "😀 a😀b İa", "c")]
    df = spark.createDataFrame([*texts(), *odd], FORM)
    index = TextIndex(spark, str(tmp_path / "i"), "id", "text", 8)
    index.append(df.filter("id % 2 = 0"), 0)
    index.append(df.filter("id % 2 = 1 OR id IS NULL"), 1)
    for pattern in [*SEVERAL, "%needle%", "%of%"]:
        want = sorted((r.id or -1, r.code) for r in df.filter(F.col("text").ilike(pattern)).collect())
        assert sorted((r.id or -1, r.code) for r in index.search(pattern).collect()) == want, pattern


def test_keys_lie_in_lists(spark, tmp_path):
    df = spark.range(500).select("id", F.concat(F.lit("row "), F.col("id")).alias("text"))
    index = TextIndex(spark, str(tmp_path / "i"), "id", "text", 4)
    index.append(df.repartition(1))
    own = index.postings().filter(F.col("gram") == number_of("row"))
    assert own.count() <= 8 and sorted(r.key for r in own.select(F.explode("keys").alias("key")).collect()) == list(range(500))
    assert index.postings().filter("n <> size(keys)").count() == 0
    assert grams_of("aaaé".encode()).tolist() == sorted(number_of(g) for g in ("aaa", "aaé", "aé", "é"))


def test_lists_end_with_their_stretch_of_texts(spark, tmp_path, monkeypatch):
    batch = textindex.pa.RecordBatch.from_pydict({"part": textindex.pa.array([0, 0, 1, 0, 0, 0], "int32"), "key": [1, 2, 3, None, 5, 6], "text": [b"abc", None, b"abc", b"abc", b"", b"abcabc"]})
    monkeypatch.setattr(textindex, "_STRETCH", 6)
    found = [(r["part"], r["n"], sorted(map(str, r["keys"]))) for b in textindex._lists(iter([batch, batch.slice(0, 0)])) for r in b.to_pylist() if r["gram"] == number_of("abc")]
    assert sorted(found) == [(0, 1, ["1"]), (0, 2, ["6", "None"]), (1, 1, ["3"])]


def test_candidates_alone_are_compared(spark, tmp_path):
    df = spark.range(100).select("id", F.concat(F.lit("row "), "id").alias("text"))
    index = TextIndex(spark, str(tmp_path / "i"), "id", "text", 4)
    index.append(df)
    node = index.search("%row 7%")._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().apply(0)
    assert "row 7" in node.condition().get().toString() and "row 7" not in node.children().apply(0).toString()


def test_pieces_are_not_tried_again(spark):
    assert straight_regex("%the%of_the%") == "(?s)^(?>.*?the)(?>.*?of.the)" and straight_regex("a.%b") == "(?s)^a\\..*b\\z"
    assert straight_regex("%the%") is None and straight_regex("a\\") is None and straight_regex("%%") is None


def test_other_forms_are_refused(spark, tmp_path):
    index = TextIndex(spark, str(tmp_path / "i"), "id", "text", 4)
    index.folder.create("segments/0.json", json.dumps({"number": 0, "place": "data/0", "parts": 4}))
    with pytest.raises(ValueError, match="another form"):
        index.segments()
