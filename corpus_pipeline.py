"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Language identification drops documents without a language, if it has one to learn from; exact deduplication, the Jaccard join and benchmark
decontamination drop copies, near copies and leaks; the last stage gives every document left its tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm import decontam, exact_dedup, langid, ngram_join, sentencepiece_codec
from tidewright.llm.common import bound_batches, drop_staged, stage, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return langid.keep_identified(docs, langid.fit(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return ngram_join.keep_one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return sentencepiece_codec.encode(docs, with_tokens=True)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("SentencePiece encoding", tokenize),
]

#: Language identification, the benchmark's spaced seeds and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, step) in enumerate(STAGES[:-1]):
        made = stage(step(spark, docs, sf_dir), f"pipeline-{k}")
        if k:
            drop_staged(docs)
        docs = made
    return STAGES[-1][1](spark, docs, sf_dir)


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
