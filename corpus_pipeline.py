"""Corpus pipeline: documents in, clean tokenised documents out, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on every row it is given and
returns a DataFrame; :func:`run` writes each result as Parquet in the shared
folder and reads it back as the next stage's ``docs``.

1. ``toxicity`` (operator 1): documents that score 0.5 or more go.
2. ``language`` (operator 3): documents without a determined language, or with
   a probability below :data:`LEAST_LANGUAGE`, go.
3. ``near_duplicates`` (operator 4): of each component one row stays, that of
   the least ``doc_id``, then of the least hash of the text.
4. ``decontamination`` (operator 8): rows whose text holds a benchmark item go.
5. ``tokens`` (operator 9): ``doc_id, n_tokens, ids, round_trip, decoded_crc32``.

The models of stages 1 and 2 learn from the stage's own documents (and
``labels``), outside the held-out folds of the operators' queries.  Decisions are
taken on ``doc_id`` and text: rows of one ``doc_id`` with different texts are judged
each.  An empty table passes through every stage; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sameitem.llm import decontamination, jaccard_join, language_id, sentencepiece_codec, toxicity
from sameitem.llm.common import stage, table

#: Clean texts score far above this even when short; noise between languages doesn't.
LEAST_LANGUAGE = 0.4


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.scored(spark, docs, table(spark, sf_dir, "labels"), ~toxicity.held_out(), docs.columns)
    return scored.where(F.col("predicted") == 0).select("row.*")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    predicted = language_id.predicted(spark, docs, docs.columns)
    known = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE)
    return predicted.where(known).select("row.*")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.representatives(spark, docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(spark, docs, table(spark, sf_dir, "benchmark"), text_hash=True)
    bad = stage(spark, found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "leaking-documents")
    same = docs["doc_id"].cast("long").eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_hash"])
    return docs.join(bad, same, "left_anti")


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_checked(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("tokens", tokens_stage),
]

#: Models decide in stages 1 and 2, so no SQL gives run()'s rows; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(spark, apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
