"""Stages of the corpus pipeline; each takes (spark, docs, sf_dir) and works on all of ``docs``.

All but the last return the columns of ``docs``. Verdicts come back to the rows by
``doc_id``: rows that share an id share the verdict, and a row without id stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import near_dedup as near
from . import packing, pii
from . import quality as classifier
from .decontamination import contamination
from .queries import END, table, vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among them.

    Where they are not labelled in both classes nothing can be learned, and all stay.
    """
    net = classifier.train(docs, table(spark, sf, "labels"))
    if net is None:
        return docs
    verdict = classifier.scored(docs, table(spark, sf, "labels"), net=net)
    bad = verdict.where("predicted = 0").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8; the smallest id stays."""
    gone = near.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Documents that the contamination rule clears; a document without words is clear."""
    marked = contamination(docs, table(spark, sf, "benchmark"))
    bad = marked.where("contaminated").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """All documents, personal data in their text replaced by its kind."""
    return pii.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 1024 ids."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), END)
