"""The corpus pipeline: documents in, packed training pieces out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trajloom.llm import stages
from trajloom.llm.common import stored

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", stages.quality),
    ("MinHash near-dedup", stages.near_dedup),
    ("benchmark decontamination", stages.decontaminate),
    ("PII", stages.redact),
    ("best-fit packing", stages.pack),
]
#: Trained models and packing are not expressible in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over what the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
