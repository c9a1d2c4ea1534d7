"""End-to-end run: bronze ingest -> silver validation -> gold load.

Each stage raises on failure, so nothing downstream runs on a failed stage.
Silver is materialised before gold reads it: besides being the layer
boundary, that keeps derivations on validated rows only.

    python -m tierone.plans.pipeline /root/testdata/sf0.01 [base_dir]
"""

from __future__ import annotations

import sys
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from tierone import schemas as S
from tierone.config import MASTER_RUN_KEY, RunContext
from tierone.operators.routing import closure
from tierone.plans import bronze, silver, warehouse
from tierone.session import scratch_path
from tierone.sources import ledger
from tierone.sources.catalog import ensure_database
from tierone.sources.frames import Source


@dataclass
class PipelineResult:
    base: str
    database: str
    pending_units: int
    scorecard: list


SCORECARD_STAGING = "silver_scorecard"


def staged_rows(spark: SparkSession, base: str) -> DataFrame:
    """Scorecard rows of every silver run, kept until (and after) gold appends them."""
    path = f"{base}/{SCORECARD_STAGING}"
    spark.createDataFrame([], S.DQ_SCORECARD).write.mode("append").parquet(path)
    return spark.read.schema(S.DQ_SCORECARD).parquet(path)


def _pending(spark: SparkSession, paths: bronze.BronzePaths, upstream: str, stage: str) -> list[Row]:
    # At most one row per quarter and the master: bounded by the calendar.
    return ledger.stage_pending(ledger.read_ledger(spark, upstream),
                                ledger.read_ledger(spark, paths.stage_ledger(stage))).collect()


def _commit(spark: SparkSession, paths: bronze.BronzePaths, stage: str, done: list[Row]) -> None:
    if done:
        ledger.record_versions(spark.createDataFrame(
            [(u.run_key, u.completed_at, u.landing) for u in done],
            "run_key string, completed_at string, landing bigint"),
            paths.stage_ledger(stage))


def silver_stage(spark: SparkSession, base: str, run: RunContext, full_refresh: bool = False) -> None:
    """Validate every landed unit that silver has not done, whichever run landed it."""
    paths = bronze.BronzePaths(base)
    todo = _pending(spark, paths, paths.ledger, "silver")
    full = full_refresh or any(u.run_key == MASTER_RUN_KEY for u in todo)
    if full or todo:
        inst, fin = bronze.read_bronze(spark, paths)
        periods = sorted({(u.year, u.quarter) for u in todo if u.year is not None})
        rows = silver.run_silver(spark, inst, fin, silver.SilverPaths(base), run,
                                 periods=None if full else periods, institutions=full)
        staged = staged_rows(spark, base)
        key = warehouse.SCORECARD_KEY
        rows.join(staged.select(*key), key, "left_anti").checkpoint().write.mode("append").parquet(
            f"{base}/{SCORECARD_STAGING}")
    _commit(spark, paths, "silver", todo)


def gold_stage(spark: SparkSession, base: str, run: RunContext, database: str,
               full_refresh: bool = False) -> None:
    """Load the years of every silver unit that gold has not done."""
    paths, spaths = bronze.BronzePaths(base), silver.SilverPaths(base)
    todo = _pending(spark, paths, paths.stage_ledger("silver"), "gold")
    full = full_refresh or any(u.run_key == MASTER_RUN_KEY for u in todo)
    # Misfiled rows of a unit lie in other quarters of silver.
    periods, _ = closure({(u.year, u.quarter) for u in todo if u.year is not None},
                         silver.read_routes(spark, spaths.routes))
    warehouse.gold_load(spark, database, database_path(base, database), spaths.institutions,
                        spaths.financials, staged_rows(spark, base), run,
                        periods=None if full else sorted(periods), rebuild_dim=full)
    _commit(spark, paths, "gold", todo)


def database_path(base: str, database: str) -> str:
    return f"{base}/warehouse/{database}.db"


def register_tables(spark: SparkSession, base: str, database: str) -> None:
    """Make the tables of an earlier process known to this one's catalog."""
    ensure_database(spark, database, database_path(base, database))
    warehouse.register_serving(spark, database)


def run_pipeline(spark: SparkSession, source: str | Source, run: RunContext,
                 base: str | None = None, database: str = "tierone_gold",
                 full_refresh: bool = False, force: Collection[str] = ()) -> PipelineResult:
    """One run over the fixture tables in a folder, or another ``source``.

    Each stage does what the stage before has completed and it has not, so a
    run that follows one that died between two stages picks up its units. A
    quarterly run validates and loads only what is new; a new institution
    master, and ``full_refresh`` (which also lands everything again), process
    all. ``force`` names units to land again (``financials_2024_Q4``).
    """
    base = base or scratch_path(spark, "pipeline")
    units = bronze.ingest(spark, source, bronze.BronzePaths(base), run,
                          ["*"] if full_refresh else force)
    silver_stage(spark, base, run, full_refresh)
    gold_stage(spark, base, run, database, full_refresh)
    audit: DataFrame = spark.table(f"{database}.dq_scorecard").filter(
        f"run_id = '{run.run_id}'")
    # The audit rows of this run: at most three rows, safe to bring back.
    return PipelineResult(base, database, len(units), [r.asDict() for r in audit.collect()])


if __name__ == "__main__":
    from tierone.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    res = run_pipeline(spark, sf, RunContext.now(), sys.argv[2] if len(sys.argv) > 2 else None)
    print(res)
