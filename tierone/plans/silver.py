"""Silver stage: validate bronze rows, write clean rows and quarantined rows.

A run validates what it was given: all of bronze, or only the quarters it
landed (a partition filter, so older quarters are not read at all) and the
institution master only when it was (re)landed.

Per dataset a first scan, of the rules' columns only, counts the landed rows by
unit, period named and failed rules: the scorecard, the counts kept per unit
and the routing of misfiled rows (:mod:`tierone.operators.routing`) all come
from these few rows. The two outputs are a scan each. Nothing is cached: at
scale another columnar scan is cheaper than holding the dataset in memory.

* clean institutions   -> overwrite (unpartitioned)
* clean financials     -> partitioned by the (year, quarter) that ``repdte``
                          names, dynamic overwrite: a run replaces the quarters
                          it carries and those its misfiled rows belong to
* quarantine, each     -> partitioned by ``_run_id``: every run keeps its own
                          rejects, a re-run of the same run id replaces them,
                          and an empty quarantine still leaves a readable
                          (schema-declared) dataset
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierone import config as C
from tierone import schemas as S
from tierone.config import RunContext
from tierone.functions.period import in_periods
from tierone.operators.quality import (
    REASON,
    clean_rows,
    failed_mask,
    financials_rules,
    institution_rules,
    quarantined_rows,
    tag,
)
from tierone.operators.routing import NO_PERIOD, Period, Route, closure, to_target, with_target
from tierone.operators.scorecard import counts_from_observed
from tierone.sources.parquet import observed_rows, read_dataset, write_dataset

PERIOD = ["year", "quarter"]


def tag_institutions(bronze: DataFrame) -> DataFrame:
    return tag(bronze, institution_rules())


def tag_financials(bronze: DataFrame) -> DataFrame:
    return tag(bronze, financials_rules())


def silver_institutions(tagged: DataFrame, run: RunContext) -> DataFrame:
    return (clean_rows(tagged).withColumn("_transformed_at", F.lit(run.run_id))
            .select(*S.SILVER_INSTITUTIONS.fieldNames()))


def silver_financials(tagged: DataFrame, run: RunContext) -> DataFrame:
    return (clean_rows(tagged).withColumn("_transformed_at", F.lit(run.run_id))
            .select(*S.SILVER_FINANCIALS.fieldNames()))


def quarantine_institutions(tagged: DataFrame, run: RunContext) -> DataFrame:
    return (quarantined_rows(tagged).withColumn("_run_id", F.lit(run.run_id))
            .select(*S.QUARANTINE_INSTITUTIONS.fieldNames()))


def quarantine_financials(tagged: DataFrame, run: RunContext) -> DataFrame:
    return (quarantined_rows(tagged).withColumn("_run_id", F.lit(run.run_id))
            .select(*S.QUARANTINE_FINANCIALS.fieldNames()))


@dataclass(frozen=True)
class SilverPaths:
    base: str

    @property
    def institutions(self) -> str:
        return f"{self.base}/silver/institutions"

    @property
    def financials(self) -> str:
        return f"{self.base}/silver/financials"

    @property
    def quarantine_institutions(self) -> str:
        return f"{self.base}/quarantine/institutions"

    @property
    def quarantine_financials(self) -> str:
        return f"{self.base}/quarantine/financials"

    @property
    def routes(self) -> str:
        return f"{self.base}/checkpoints/silver_routes"

    @property
    def unit_counts(self) -> str:
        return f"{self.base}/audit/unit_counts"


# ------------------------------------------------------------------ counts by failed rules

def institution_rule_names() -> list[str]:
    return [r.name for r in institution_rules()]


def financials_rule_names() -> list[str]:
    return [*(r.name for r in financials_rules()), NO_PERIOD]


def institution_masks(bronze: DataFrame) -> DataFrame:
    """``rule_mask, n_rows``: one row for each combination of failed rules."""
    return bronze.groupBy(failed_mask(institution_rules()).alias("rule_mask")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def financials_masks(targeted: DataFrame) -> DataFrame:
    """The same per filed period and, for clean rows, period named by the report date."""
    rules = financials_rules()
    lost = F.when(F.col(REASON) == F.lit(NO_PERIOD), F.lit(1 << len(rules))).otherwise(F.lit(0))
    mask = failed_mask(rules) + lost
    rows = targeted.select(*PERIOD, mask.alias("rule_mask"), "to_year", "to_quarter")
    named = [F.when(F.col("rule_mask") == 0, F.col(c)).alias(c) for c in ("to_year", "to_quarter")]
    return (rows.groupBy(*PERIOD, *named, "rule_mask")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def _totals(masks: list[Row]) -> tuple[int, int]:
    """(rows, clean rows)"""
    return sum(m.n_rows for m in masks), sum(m.n_rows for m in masks if m.rule_mask == 0)


def record_unit_counts(spark: SparkSession, path: str, counts: Collection[tuple[str, str, int, int]],
                       run: RunContext) -> None:
    """Keep ``(dataset, run_key, rule_mask, n_rows)`` for the run; a unit it validates again is replaced."""
    if counts:
        rows = spark.createDataFrame(
            [(dataset, run.run_date, run.run_ts, mask, n, run.run_id, key) for dataset, key, mask, n in counts],
            S.DQ_UNIT_COUNTS)
        write_dataset(rows.coalesce(1), path, partition_by=["run_id", "run_key"])


def read_unit_counts(spark: SparkSession, path: str) -> DataFrame:
    return read_dataset(spark, path, S.DQ_UNIT_COUNTS)


# ------------------------------------------------------------------ writes

def _write_rejects(bad: DataFrame, path: str, schema: T.StructType, run: RunContext, n_bad: int) -> None:
    write_dataset(bad, path, partition_by=["_run_id"])
    if not n_bad:
        # Without rejects a dynamic overwrite replaces nothing: empty the run's own folder.
        fields = [f for f in schema.fields if f.name != "_run_id"]
        write_dataset(bad.sparkSession.createDataFrame([], T.StructType(fields)),
                      f"{path}/_run_id={run.run_id}")


def read_routes(spark: SparkSession, path: str) -> set[Route]:
    """All routes recorded: at most one for each pair of quarters."""
    spark.createDataFrame([], S.SILVER_ROUTES).write.mode("append").parquet(path)
    rows = read_dataset(spark, path, S.SILVER_ROUTES).distinct().collect()
    return {((r.year, r.quarter), (r.to_year, r.to_quarter)) for r in rows}


def _record_routes(spark: SparkSession, path: str, routes: set[Route]) -> None:
    if routes:
        rows = spark.createDataFrame([(*filed, *to) for filed, to in sorted(routes)], S.SILVER_ROUTES)
        rows.coalesce(1).write.mode("append").parquet(path)


def _stored_periods(spark: SparkSession, path: str) -> set[Period]:
    """Quarters silver has folders for: bounded by the calendar."""
    (spark.createDataFrame([], S.SILVER_FINANCIALS).write.mode("append").partitionBy(*PERIOD).parquet(path))
    return {(r.year, r.quarter) for r in
            read_dataset(spark, path, S.SILVER_FINANCIALS).select(*PERIOD).distinct().collect()}


def _write_clean(targeted: DataFrame, path: str, run: RunContext, targets: set[Period] | None) -> int:
    """Write the clean rows that belong to ``targets`` (None: all rows there are).

    Dynamic overwrite replaces only quarters that receive rows; the quarters
    written are observed on the same pass (a set bounded by the calendar), and
    every other target is cleared with an empty overwrite of its own folder.
    """
    spark = targeted.sparkSession
    clean = silver_financials(to_target(targeted), run)
    stale = _stored_periods(spark, path) if targets is None else targets
    if targets is not None:
        clean = clean.filter(in_periods(sorted(targets)))
    written = Observation("financials_out")
    clean = clean.observe(written, F.count(F.lit(1)).alias("rows"),
                          F.collect_set(F.struct(*PERIOD)).alias("periods"))
    write_dataset(clean, path, partition_by=PERIOD)
    none = spark.createDataFrame([], T.StructType(
        [f for f in S.SILVER_FINANCIALS.fields if f.name not in PERIOD]))
    full = {(p["year"], p["quarter"]) for p in written.get.get("periods", [])}
    for year, quarter in sorted(stale - full):
        write_dataset(none, f"{path}/year={year}/quarter={quarter}")
    return observed_rows(written)


def write_silver_financials(tagged: DataFrame, path: str, run: RunContext,
                            targets: Collection[Period] | None = None) -> int:
    """Replace the quarters ``targets`` of silver by the clean rows of ``tagged`` that belong there.

    ``tagged`` holds every row of those quarters, wherever it is filed; without
    ``targets`` it holds every row there is.
    """
    return _write_clean(with_target(tagged), path, run, None if targets is None else set(targets))


def settle_financials(bronze_fin: DataFrame, path: str, routes_path: str, run: RunContext,
                      periods: Collection[Period] | None = None) -> tuple[list[Row], DataFrame]:
    """Bring silver up to date with the filed ``periods`` of bronze (None: with all of it).

    Returns the counts of :func:`financials_masks` over those periods, a list
    bounded by the calendar and the rules, and their tagged rows. Routes are
    recorded before silver is written, so a run that dies in between is
    repeated over the same quarters.
    """
    spark = bronze_fin.sparkSession
    targeted = with_target(tag_financials(bronze_fin))
    landed = targeted if periods is None else targeted.filter(in_periods(periods))
    masks = financials_masks(landed).collect()
    new = {((m.year, m.quarter), (m.to_year, m.to_quarter)) for m in masks
           if m.rule_mask == 0 and (m.year, m.quarter) != (m.to_year, m.to_quarter)}
    known = read_routes(spark, routes_path)
    _record_routes(spark, routes_path, new - known)
    if periods is None:
        _write_clean(targeted, path, run, None)
    else:
        targets, sources = closure(periods, known | new)
        rows = landed if sources == set(periods) else targeted.filter(in_periods(sorted(sources)))
        _write_clean(rows, path, run, targets)
    return masks, landed.drop("to_year", "to_quarter")


def run_silver(spark: SparkSession, bronze_inst: DataFrame, bronze_fin: DataFrame,
               paths: SilverPaths, run: RunContext,
               periods: list[Period] | None = None,
               institutions: bool = True) -> DataFrame:
    """Write the silver outputs and the run's counts per unit; return its scorecard rows.

    ``periods`` limits financials to those quarters (``None`` = all) and
    ``institutions=False`` skips the master, so a quarterly run validates what
    it landed instead of re-reading the whole history.
    """
    rows, counts = spark.createDataFrame([], S.DQ_SCORECARD), []
    if institutions:
        masks = institution_masks(bronze_inst).collect()        # one row per combination of rules
        total, clean = _totals(masks)
        tagged = tag_institutions(bronze_inst)
        write_dataset(silver_institutions(tagged, run), paths.institutions)
        _write_rejects(quarantine_institutions(tagged, run), paths.quarantine_institutions,
                       S.QUARANTINE_INSTITUTIONS, run, total - clean)
        counts += [(C.DATASET_INSTITUTIONS, C.MASTER_RUN_KEY, m.rule_mask, m.n_rows) for m in masks]
        rows = rows.unionByName(counts_from_observed(
            spark, C.DATASET_INSTITUTIONS, C.STAGE_SILVER, total, clean, run))

    if periods is None or periods:
        masks, landed = settle_financials(bronze_fin, paths.financials, paths.routes, run, periods)
        total, clean = _totals(masks)
        _write_rejects(quarantine_financials(landed, run), paths.quarantine_financials,
                       S.QUARANTINE_FINANCIALS, run, total - clean)
        by_unit: dict[tuple[str, int], int] = {}
        # A quarter without rows still counts: as none.
        empty = set(periods or ()) - {(m.year, m.quarter) for m in masks}
        for period, mask, n in [*((p, 0, 0) for p in sorted(empty)),
                                *(((m.year, m.quarter), m.rule_mask, m.n_rows) for m in masks)]:
            key = (C.FINANCIALS_RUN_KEY_FORMAT % period, mask)
            by_unit[key] = by_unit.get(key, 0) + n
        counts += [(C.DATASET_FINANCIALS, *key, n) for key, n in by_unit.items()]
        rows = rows.unionByName(counts_from_observed(
            spark, C.DATASET_FINANCIALS, C.STAGE_SILVER, total, clean, run))
    record_unit_counts(spark, paths.unit_counts, counts, run)
    return rows


def read_silver(spark: SparkSession, paths: SilverPaths) -> tuple[DataFrame, DataFrame]:
    return (read_dataset(spark, paths.institutions, S.SILVER_INSTITUTIONS),
            read_dataset(spark, paths.financials, S.SILVER_FINANCIALS))


def read_quarantine(spark: SparkSession, paths: SilverPaths) -> tuple[DataFrame, DataFrame]:
    return (read_dataset(spark, paths.quarantine_institutions, S.QUARANTINE_INSTITUTIONS),
            read_dataset(spark, paths.quarantine_financials, S.QUARANTINE_FINANCIALS))
