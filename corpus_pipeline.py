"""A training corpus from documents, in five stages; each works on all that the one before kept.

toxicity         documents that score as toxic go
line_dedup       lines on many sites stay in one document only; no document goes, its n_chars follows
near_dedup       of documents alike in five-word shingles (0.8 or more), the one with the smallest doc_id stays
decontamination  documents that hold ten consecutive words of a benchmark item go
mixing           the rest is repeated and shuffled to the target weights of its sources

Rows with nulls in any column, empty and very long texts, and rows that repeat go through all stages as their operators
state: a null or empty text isn't toxic, holds no line, shingle or benchmark word, and stays; repeated rows are one
document for near_dedup, which keeps the rows of the smallest doc_id. An empty table stays empty. Columns of documents
keep their names and order, and columns besides those five are carried along; mixing adds replica and shuffle_key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from girder.llm import decontaminate, line_dedup, mixing, near_dup, toxicity
from girder.llm.common import passed_on, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.without_spread_lines(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast("long")
    return cleaned.select(*[n_chars.alias(c) if c == "n_chars" else c for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.deduplicated(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]
#: A trained classifier can't be expressed in SQL; tests/llm compares the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus of documents; each stage's result is written to the shared folder, and what it was made from goes."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = passed_on(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
