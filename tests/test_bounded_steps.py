"""Steps whose largest task must not take in more than its share of the rows."""

import pyarrow as pa
from pyspark.sql import functions as F

from tidewright.operators import documents, facts, serving
from tidewright.sources import tidy


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_all_facts_are_searched_without_a_page_of_them(spark):
    rows = spark.range(30).select(F.col("id").cast("string").alias("doc_id"), F.lit("a:T").alias("element"), F.lit("c").alias("context_ref"), F.when(F.col("id") % 3 == 0, "x 1997").otherwise("y").alias("value"), F.lit(True).alias("is_text_block"))
    found = serving.search_facts(serving.facts(rows, element="a:", text_only=True, limit=None), "1997", limit=4)
    assert [r.doc_id for r in found.collect()] == ["0", "12", "15", "18"]
    assert plan_of(found).count("GlobalLimit") == 1 and plan_of(found).count("Sort") == 1


def test_fact_search_sorts_what_it_finds_alone(spark):
    from tidewright.plans import registry

    assert plan_of(registry.queries()["q86_fact_search"](spark, "/root/testdata/sf0.001")).count("GlobalLimit") == 1


def test_disclosures_meet_by_digests_of_their_titles(spark):
    columns = "doc_id long, title string, disclosed_at string, doc_type string, has_xbrl boolean, code string, source_url string, split_ratio string, split_factor double, effective_date date"
    row = lambda k, title: (k, title, "2024-05-01T09:00:00+09:00", "x", True, None, None, None, None, None)
    new = spark.createDataFrame([row(1, "a" * 2500), row(2, "b"), row(3, None), row(4, None), row(5, ""), row(6, "f"), row(6, "g"), row(7, "h")], columns)
    old = spark.createDataFrame([row(1, "a" * 1990 + "…(省略)"), row(2, "B"), row(3, None), row(4, ""), row(5, None), row(6, "f")], columns)
    found = documents.disclosures_to_write(old, new)
    assert sorted((r.doc_id, r.title or "") for r in found.collect()) == [(2, "b"), (4, ""), (5, ""), (6, "g"), (7, "h")]
    node = documents.disclosures_to_write(old, new).select("doc_id")._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().apply(0)
    kinds = [(x.name(), x.dataType().typeName()) for k in (0, 1) for x in [node.children().apply(k).output().apply(i) for i in range(node.children().apply(k).output().size())]]
    assert ("_title", "binary") in kinds and "title" not in dict(kinds)


def test_summaries_are_grouped_once(spark):
    scopes = {"a": ["連結", "単体"], "b": ["単体", "単体"], "c": ["単体", ""], "d": ["単体", None], "e": [None, None], "f": ["", None]}
    rows = [(d, "x:FiscalYearEnd", "CurrentYearDuration", "", s, "2024-03-31", k) for d, both in scopes.items() for k, s in enumerate(both)]
    found = facts.summarize(spark.createDataFrame(rows, "doc_id string, element string, context_ref string, period_end string, consolidated string, value string, ord long"))
    assert {r.doc_id: r.consolidated for r in found.collect()} == {"a": "連結", "b": "単体", "c": None, "d": "単体", "e": None, "f": None}
    assert found._jdf.queryExecution().sparkPlan().toString().count("Aggregate(") == 2


def test_batches_become_rows_in_parts(monkeypatch):
    batch, asked = pa.RecordBatch.from_pydict({"a": list(range(450)), "b": [str(k) if k % 2 else None for k in range(450)]}), []
    part = pa.RecordBatch.from_pydict({"a": [1], "b": ["x"]})

    class Watched:
        num_rows = batch.num_rows

        def slice(self, at, rows):
            asked.append((at, rows))
            return batch.slice(at, rows)

    assert list(tidy.rows_in_parts(Watched())) == [(k, str(k) if k % 2 else None) for k in range(450)]
    assert asked == [(0, 200), (200, 200), (400, 200)]
    assert list(tidy.rows_in_parts(part)) == [(1, "x")] and list(tidy.rows_in_parts(part.slice(0, 0))) == []
