"""Data-quality scorecard rows: counts and pass rate per (run, dataset, stage).

Counts come from one global aggregate over the tagged rows (partial counts per
task, one tiny final merge), or — inside the write path — from metrics
observed on the writes themselves, so no extra scan is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierone.config import RUN_ID_PATTERN, RunContext
from tierone.functions.rounding import round_half_up
from tierone.operators.quality import REASON

def pass_pct(clean: Column, total: Column) -> Column:
    """clean / total in percent, 4 dp; NULL when nothing was processed."""
    return round_half_up(clean * F.lit(100.0) / F.nullif(total, F.lit(0)), 4)


def _finish(counts: DataFrame, dataset: str, stage: str, run: RunContext) -> DataFrame:
    created_at = F.lit(run.run_ts_sql).cast("timestamp_ntz")
    return counts.select(
        # The run id is the run time formatted YYYYMMDD_HHMMSS (= run.run_id).
        F.date_format(created_at, RUN_ID_PATTERN).alias("run_id"),
        F.lit(run.run_date).alias("run_date"),
        F.lit(dataset).alias("dataset"),
        F.lit(stage).alias("pipeline_stage"),
        F.col("total_records").cast("bigint").alias("total_records"),
        F.col("clean_records").cast("bigint").alias("clean_records"),
        (F.col("total_records") - F.col("clean_records")).cast("bigint").alias("quarantine_records"),
        pass_pct(F.col("clean_records"), F.col("total_records")).alias("dq_pass_pct"),
        created_at.alias("created_at"),
    )


def counts_from_tagged(tagged: DataFrame, dataset: str, stage: str,
                       run: RunContext) -> DataFrame:
    counts = tagged.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count(F.when(F.col(REASON) == F.lit(""), F.lit(1))).alias("clean_records"),
    )
    return _finish(counts, dataset, stage, run)


def counts_from_observed(spark: SparkSession, dataset: str, stage: str,
                         total: int, clean: int, run: RunContext) -> DataFrame:
    counts = spark.createDataFrame([(int(total), int(clean))],
                                   "total_records bigint, clean_records bigint")
    return _finish(counts, dataset, stage, run)


def pipeline_row(per_dataset: DataFrame, dataset: str, stage: str,
                 run: RunContext) -> DataFrame:
    """One row totalling the per-dataset rows given."""
    counts = per_dataset.agg(
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("clean_records"), F.lit(0)).alias("clean_records"),
    )
    return _finish(counts, dataset, stage, run)
