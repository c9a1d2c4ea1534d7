"""Registered queries: one per operator, each over its whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierone.llm import (
    ball_codes, decontam, exact_dedup, fim, langid, licenses, mixing, packing, pii, quality, secrets, simhash,
    substring,
)
from tierone.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(documents(spark, sf)).drop("rid")


def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.scan(documents(spark, sf))


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(documents(spark, sf))


def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.contamination(documents(spark, sf), decontam.benchmark_of(spark, sf)).drop("rid", "key")


def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf)).drop("rid")


def op6_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.digest(secrets.scan(documents(spark, sf)))


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = simhash.near_groups(documents(spark, sf))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                         "component_id")


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf).select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "shards",
                        mixing.places(F.col("shards"), F.col("doc_id")).alias("places"))


def op9_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring.passages(documents(spark, sf))


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    return (quality.select(documents(spark, sf), quality.labels_of(spark, sf))
            .select("doc_id", "n_grams", "log_weight", "harm", "kept"))


def op11_fim(spark: SparkSession, sf: str) -> DataFrame:
    made = fim.transform(documents(spark, sf))
    text = fim.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


def op12_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers        # the vocabulary files; only this query needs them

    return packing.pack(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.json")).drop("rid")


def op13_ball_codes(spark: SparkSession, sf: str) -> DataFrame:
    return ball_codes.compress(spark.read.parquet(f"{sf}/embeddings.parquet"))


QUERIES: dict[str, Query] = {
    "op1_licenses": op1_licenses,
    "op2_pii": op2_pii,
    "op3_language_id": op3_language_id,
    "op4_decontamination": op4_decontamination,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_secrets": op6_secrets,
    "op7_simhash": op7_simhash,
    "op8_mixing": op8_mixing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality": op10_quality,
    "op11_fim": op11_fim,
    "op12_packing": op12_packing,
    "op13_ball_codes": op13_ball_codes,
}
