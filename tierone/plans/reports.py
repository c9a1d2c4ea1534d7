"""Reports over the gold tables.

Aggregates use partial (map-side) aggregation, so a state or class holding a
large share of the rows is combined inside each task before the shuffle.
Outputs are small (one row per class / quarter / state); the final ordering is
a sort of that small result. Averages round through the pinned decimal rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierone.functions.rounding import round_half_up
from tierone.operators.history import with_previous_quarter
from tierone.operators.joins import key_lookup
from tierone.operators.quality import REASON
from tierone.operators.scorecard import pass_pct


def capital_distribution(health: DataFrame, year: int = 2024) -> DataFrame:
    return (health.filter(F.col("year") == F.lit(year))
            .groupBy("capital_adequacy_flag")
            .agg(F.count(F.lit(1)).alias("bank_quarters"),
                 round_half_up(F.avg("rbct1"), 2).alias("avg_t1_ratio"),
                 round_half_up(F.avg("npl_ratio_pct"), 3).alias("avg_npl_pct"))
            .orderBy("capital_adequacy_flag"))


def quarter_trend(health: DataFrame) -> DataFrame:
    return (health.groupBy("year", "quarter")
            .agg(F.count_distinct("cert").alias("bank_count"),
                 round_half_up(F.avg("rbct1"), 2).alias("avg_tier1_ratio"),
                 round_half_up(F.avg("npl_ratio_pct"), 3).alias("avg_npl_pct"))
            .orderBy("year", "quarter"))


def quarter_change(health: DataFrame) -> DataFrame:
    """Quarter trend plus the change against the previous calendar quarter."""
    trend = quarter_trend(health).drop("bank_count")
    both = with_previous_quarter(trend, ["avg_tier1_ratio", "avg_npl_pct"])
    return (both.select(
        "year", "quarter", "avg_tier1_ratio", "prev_avg_tier1_ratio",
        round_half_up(F.col("avg_tier1_ratio") - F.col("prev_avg_tier1_ratio"), 2)
        .alias("tier1_change"),
        "avg_npl_pct", "prev_avg_npl_pct",
        round_half_up(F.col("avg_npl_pct") - F.col("prev_avg_npl_pct"), 3)
        .alias("npl_change"))
        .orderBy("year", "quarter"))


def regional_summary(health: DataFrame, year: int = 2024, quarter: int = 4) -> DataFrame:
    return (health.filter((F.col("year") == F.lit(year)) & (F.col("quarter") == F.lit(quarter)))
            .groupBy("stalp")
            .agg(F.count(F.lit(1)).alias("bank_count"),
                 round_half_up(F.avg("rbct1"), 2).alias("avg_t1"))
            .orderBy(F.col("bank_count").desc(), F.col("stalp").asc_nulls_first()))


def dim_current_sample(dim: DataFrame, n: int = 5) -> DataFrame:
    """A fixed-size sample of current versions (the limit is the report)."""
    return (dim.filter(F.col("is_current"))
            .select("cert", "name", "effective_date", "expiry_date", "is_current")
            .orderBy("cert")
            .limit(n))


def scorecard_audit(scorecard: DataFrame) -> DataFrame:
    return (scorecard.select("run_id", "dataset", "total_records", "clean_records", "dq_pass_pct")
            .orderBy("dataset", "run_id"))


def dq_pass_trend(tagged_fin: DataFrame) -> DataFrame:
    """Pass rate of each quarterly financials load and its change on the last.

    Every quarterly run lands one (year, quarter) of financials, so the
    per-run trend of the scorecard is the pass rate grouped by period.
    """
    per_period = (tagged_fin.groupBy("year", "quarter")
                  .agg(F.count(F.lit(1)).alias("total_records"),
                       F.count(F.when(F.col(REASON) == F.lit(""), F.lit(1)))
                       .alias("clean_records"))
                  .withColumn("dq_pass_pct", pass_pct(F.col("clean_records"),
                                                      F.col("total_records"))))
    both = with_previous_quarter(per_period, ["dq_pass_pct"])
    return (both.select(
        "year", "quarter",
        F.col("total_records").cast("bigint").alias("total_records"),
        F.col("clean_records").cast("bigint").alias("clean_records"),
        "dq_pass_pct", "prev_dq_pass_pct",
        round_half_up(F.col("dq_pass_pct") - F.col("prev_dq_pass_pct"), 4)
        .alias("pass_pct_change"))
        .orderBy("year", "quarter"))


def dq_run_trend(unit_counts: DataFrame) -> DataFrame:
    """State of each dataset after every run that validated some of it, and the change of its pass rate.

    A unit counts as its last validation found it: when one is validated again
    its earlier counts are taken back, so a correction does not count twice.
    Both windows run over counts, per unit and per dataset: as many rows as runs.
    """
    run = ["created_at", "run_date", "run_id"]
    clean = F.when(F.col("rule_mask") == 0, F.col("n_rows")).otherwise(F.lit(0))
    units = unit_counts.groupBy("dataset", "run_key", *run).agg(
        F.sum("n_rows").alias("total"), F.sum(clean).alias("clean"))
    of_unit = Window.partitionBy("dataset", "run_key").orderBy("created_at", "run_id")
    added = [(F.col(c) - F.lag(c, 1, 0).over(of_unit)).alias(f"{c}_added") for c in ("total", "clean")]
    runs = (units.select("*", *added).groupBy("dataset", *run)
            .agg(F.sum("total").alias("processed_records"), F.sum("total_added").alias("total_added"),
                 F.sum("clean_added").alias("clean_added")))
    by_run = Window.partitionBy("dataset").orderBy("created_at", "run_id")
    so_far = by_run.rowsBetween(Window.unboundedPreceding, 0)
    states = (runs.select("dataset", *run, "processed_records",
                          F.sum("total_added").over(so_far).alias("total_records"),
                          F.sum("clean_added").over(so_far).alias("clean_records"))
              .withColumn("dq_pass_pct", pass_pct(F.col("clean_records"), F.col("total_records")))
              .withColumn("prev_dq_pass_pct", F.lag("dq_pass_pct").over(by_run)))
    return (states.select("dataset", "run_id", "run_date", "processed_records", "total_records", "clean_records",
                          "dq_pass_pct", "prev_dq_pass_pct",
                          round_half_up(F.col("dq_pass_pct") - F.col("prev_dq_pass_pct"), 4).alias("pass_pct_change"))
            .orderBy("dataset", "run_id"))


def clustered_lookup(dim: DataFrame, latest: DataFrame, flag: str) -> DataFrame:
    """Current dimension rows of institutions carrying ``flag`` in ``latest``,
    the health rows of one quarter."""
    flagged = latest.filter(F.col("capital_adequacy_flag") == F.lit(flag))
    return (key_lookup(dim.filter(F.col("is_current")), flagged, "cert")
            .select("cert", "name", "city", "stalp", "instcat", "charterclass", "active"))


def bank_history(health: DataFrame, banks: DataFrame) -> DataFrame:
    """Every quarter of the institutions in ``banks``: the table lies by year and state, so the lookup
    goes by the Bloom filters of ``cert``."""
    return key_lookup(health, banks, "cert")
