"""Corpus pipeline: language, quality, near duplicates, decontamination, segmentation.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its
predecessor kept and returns a DataFrame; ``run`` writes every stage's rows
as Parquet in the shared folder and reads them back for the next one.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.llm import decontaminate, langid, nbest, neardup, quality  # noqa: E402
from tessera.llm.shared import written  # noqa: E402
from tessera.session import ship_package  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised; null and letterless texts go."""
    ship_package(spark)
    return langid.identified(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that no quality rule rejects."""
    return quality.apply_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each near-duplicate class."""
    ship_package(spark)
    return neardup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of ``benchmark``."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the N best segmentations of every remaining document, checked by decoding."""
    ship_package(spark)
    return nbest.segmented(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
    ("decontamination", decontamination), ("segmentation", segmentation),
]

#: Trained classifiers, sampled signatures and lattice search have no SQL form; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; an empty table gives an empty result of the last stage's columns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
