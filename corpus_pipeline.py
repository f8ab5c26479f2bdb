"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next stage's docs. All stages but the last return the columns of documents.

1. language: documents whose language can't be told (no letter, or too far from every centroid) go.
2. exact: of documents that are equal up to white space, the one with the smallest doc_id stays.
3. near: of each group of near duplicates (5-word shingles, similarity 0.75 or more), one document stays.
4. mix: sources are visited by temperature weights, at most 1.5 times each; no document is dropped, some
   come twice.
5. tokens: doc_id, n_tokens and input_ids of each visit.

Null and empty texts, and texts without letters, leave in stage 1; rows without doc_id leave in stage 2;
extra columns pass through stages 1 to 4 unread; empty tables pass through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexigraph.llm import bpe, exact_dedup, language_id, mixing, near_dedup
from lexigraph.llm.common import table, written
from lexigraph.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.predicted(docs, language_id.learned(docs), carry=docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.token_lists(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [("language", language), ("exact", exact), ("near", near), ("mix", mix), ("tokens", tokens)]

#: Several stages (a trained classifier, min-hashing, BPE) are beyond SQL; tests hold the run against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
