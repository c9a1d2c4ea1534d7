"""Corpus preparation: five stages over ``documents``, each applying one operator to what its
predecessor kept. Every stage but the last returns the columns of its input.

Defined results. Rows are told apart by ``doc_id`` and text, so rows that
share an id or have none go or stay by their own text. Null and empty texts are
documents: the exact stage keeps one of them all, and none is contaminated. Of
equal rows one stays. A stage on an empty table returns an empty table; without
labels or benchmark nothing is rejected or contaminated. All columns, whatever
their names, are carried along; only the last stage sets ``size``,
``source_size``, ``target``, ``taken`` and ``shards``, replacing any columns so named.

``run`` writes each stage's result as Parquet in the shared folder and rereads it as the next
stage's documents, so a lost executor or a restarted stage recomputes one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierone.llm import decontam, exact_dedup, mixing, quality, simhash
from tierone.llm.common import documents, materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows the quality classifier keeps; labels come from the input folder."""
    return quality.keep_good(docs, quality.labels_of(spark, sf_dir))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest row of each group of equal texts."""
    return exact_dedup.keep_exact(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate component."""
    return simhash.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontam.drop_contaminated(docs, decontam.benchmark_of(spark, sf_dir))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's target, the words taken and its shards."""
    return mixing.mix(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash", near_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Classifier, fingerprints and draws have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
