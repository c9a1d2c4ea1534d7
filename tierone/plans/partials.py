"""Reports from maintained partial aggregates.

``health_partials`` holds, for each (year, quarter, state, class), the counts
and sums that the averages of the reports are made of, and ``bank_sets`` the
distinct institutions of each quarter as bitmaps. Both are partitioned by
(year, quarter); a run replaces the quarters it loaded and nothing else, and
the reports merge what is stored: they read a few thousand small rows however
large the facts are.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierone import schemas as S
from tierone.functions.rounding import round_half_up
from tierone.operators.bitmaps import distinct_numbers, number_sets
from tierone.sources.parquet import read_dataset, write_dataset

PERIOD = ["year", "quarter"]
GROUP = ["stalp", "capital_adequacy_flag"]


def health_partials(health: DataFrame) -> DataFrame:
    return (health.groupBy(*PERIOD, *GROUP)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count("rbct1").alias("n_rbct1"), F.sum("rbct1").alias("sum_rbct1"),
                 F.count("npl_ratio_pct").alias("n_npl"), F.sum("npl_ratio_pct").alias("sum_npl"))
            .select(*S.HEALTH_PARTIALS.fieldNames()))


def bank_sets(health: DataFrame) -> DataFrame:
    return number_sets(health, "cert", PERIOD).select(*S.BANK_SETS.fieldNames())


def maintain(spark: SparkSession, health: DataFrame, base: str,
             periods: Collection[tuple[int, int]] | None = None) -> None:
    """Bring the stored partials up to date with ``health``, the facts of ``periods`` (None: of all).

    A period without facts is left empty.
    """
    for name, schema, rows in (("health_partials", S.HEALTH_PARTIALS, health_partials(health)),
                               ("bank_sets", S.BANK_SETS, bank_sets(health))):
        path = f"{base}/{name}"
        seen = Observation(name)
        rows = (rows.repartition(*PERIOD)           # one file for each quarter
                .observe(seen, F.collect_set(F.struct(*PERIOD)).alias("periods")))
        if periods is None:
            write_dataset(rows, path, partition_by=PERIOD, replace_all=True)
            continue
        write_dataset(rows, path, partition_by=PERIOD)
        full = {(p["year"], p["quarter"]) for p in seen.get.get("periods", [])}
        none = spark.createDataFrame([], T.StructType([f for f in schema.fields if f.name not in PERIOD]))
        for year, quarter in sorted(set(periods) - full):
            write_dataset(none, f"{path}/year={year}/quarter={quarter}")


def read_partials(spark: SparkSession, base: str) -> DataFrame:
    return read_dataset(spark, f"{base}/health_partials", S.HEALTH_PARTIALS)


def read_bank_sets(spark: SparkSession, base: str) -> DataFrame:
    return read_dataset(spark, f"{base}/bank_sets", S.BANK_SETS)


def _mean(total: str, n: str, scale: int) -> Column:
    return round_half_up(F.sum(total) / F.nullif(F.sum(n), F.lit(0)), scale)


def capital_distribution(partials: DataFrame, year: int = 2024) -> DataFrame:
    return (partials.filter(F.col("year") == F.lit(year)).groupBy("capital_adequacy_flag")
            .agg(F.sum("n").alias("bank_quarters"), _mean("sum_rbct1", "n_rbct1", 2).alias("avg_t1_ratio"),
                 _mean("sum_npl", "n_npl", 3).alias("avg_npl_pct"))
            .orderBy("capital_adequacy_flag"))


def regional_summary(partials: DataFrame, year: int = 2024, quarter: int = 4) -> DataFrame:
    return (partials.filter((F.col("year") == F.lit(year)) & (F.col("quarter") == F.lit(quarter)))
            .groupBy("stalp")
            .agg(F.sum("n").alias("bank_count"), _mean("sum_rbct1", "n_rbct1", 2).alias("avg_t1"))
            .orderBy(F.col("bank_count").desc(), F.col("stalp").asc_nulls_first()))


def quarter_trend(partials: DataFrame, sets: DataFrame) -> DataFrame:
    means = partials.groupBy(*PERIOD).agg(
        _mean("sum_rbct1", "n_rbct1", 2).alias("avg_tier1_ratio"), _mean("sum_npl", "n_npl", 3).alias("avg_npl_pct"))
    return (means.join(distinct_numbers(sets, PERIOD, "bank_count"), PERIOD, "left")
            .select(*PERIOD, F.coalesce("bank_count", F.lit(0)).alias("bank_count"), "avg_tier1_ratio", "avg_npl_pct")
            .orderBy(*PERIOD))


def banks_by_year(sets: DataFrame) -> DataFrame:
    """Distinct institutions of each year: a bank in several quarters counts once."""
    return distinct_numbers(sets, ["year"], "bank_count")
