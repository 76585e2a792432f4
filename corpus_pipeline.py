"""The corpus pipeline: quality rules, near duplicates, decontamination, sanitisation, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettera.llm import decontaminate, near_duplicates, packing, quality, sanitise
from lettera.llm.common import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and the decision list learned from ``labels``."""
    rows, _ = quality.judged(docs, table(spark, sf_dir, "labels"), whole_rows=True)
    return rows.filter(F.col("kept")).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each class of near copies."""
    return near_duplicates.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of ``benchmark`` was found."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def take_out_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without personal data and the terms that disclose it."""
    return sanitise.sanitised(docs, "text", "n_chars" if "n_chars" in docs.columns else None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences."""
    return packing.packed(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("pii", take_out_private),
    ("packing", pack),
]
#: Learned rules, signatures and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
