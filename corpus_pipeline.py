"""The corpus pipeline: quality classifier, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of
``documents``; the last one returns the mixed documents, repeats included. ``run`` writes
each stage's rows to the shared folder, reads them again as the next one's input, and deletes
the tables that the stage stored on the way.

Nulls: a null text is empty for every stage and stays null; the classifier and the near-dedup
keep it, mixing takes it as size 0. A null id is never trusted or near-duplicate; a null
language or source is one of its own. Rows that share an id but not their text are judged
each by its own text. Rows that repeat id and text stay or go together, and share the draw of the mix.
Of equal lines and documents the one of the smallest id stays; a value at a limit is kept.
Empty tables give an empty result: without ``labels`` the classifier keeps all, without
``benchmark`` the decontamination does. Extra columns of any name are passed on;
n_chars, where there is one, follows the text. Texts are taken whole at any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontaminate, line_dedup, lm_quality, mixing, near_dup
from gridloom.llm.common import settled, table


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where a stage has changed it."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lm_quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(line_dedup.dedup_lines(docs))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs, k=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("minhash_near_dedup", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing", source_mixing),
]

#: The model's stage has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
