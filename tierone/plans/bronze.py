"""Bronze stage: land the two datasets, resumably.

Work units are derived from the data (the master plus every (year, quarter)
present), never from a hard-coded calendar, and come with a fingerprint of
their source rows, taken in one aggregate. Pending are the units that the
ledger does not have, those whose fingerprint differs from their last landing
and, for a complete source, those it no longer has. They are brought to the
driver once: at most one per quarter plus the master, a list bounded by the
calendar, and fixed before any completion is recorded. Pending quarters are
written in groups of about ``COMMIT_ROWS`` source rows, each by one
partitioned job (dynamic overwrite — a retried or repeated quarter is
replaced, not duplicated); a group's ledger rows are appended after its job
has committed, so a load that dies has lost one group at most.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierone import schemas as S
from tierone.config import MASTER_RUN_KEY, RunContext
from tierone.functions.period import in_periods
from tierone.sources import ledger
from tierone.sources.frames import FixtureSource, Source
from tierone.sources.parquet import cluster, read_dataset, write_dataset


# Source rows landed by one commit, about: a quarter is never split.
COMMIT_ROWS = 500_000_000


@dataclass(frozen=True)
class BronzePaths:
    base: str

    @property
    def institutions(self) -> str:
        return f"{self.base}/bronze/institutions"

    @property
    def financials(self) -> str:
        return f"{self.base}/bronze/financials"

    @property
    def ledger(self) -> str:
        return f"{self.base}/checkpoints/run_ledger"

    def stage_ledger(self, stage: str) -> str:
        return f"{self.base}/checkpoints/{stage}_ledger"


def land_financials(fin: DataFrame, path: str) -> None:
    # Range-partition on the period (then cert) so each task writes few files
    # and one large quarter still spreads over many tasks.
    # Rows without a cert tie on all three keys; the hash of the row spreads them.
    spread = fin.withColumn("_spread", F.xxhash64(*fin.columns))
    laid_out = cluster(spread, ["year", "quarter"], ["cert"], ["_spread"]).drop("_spread")
    write_dataset(laid_out, path, partition_by=["year", "quarter"])


def ingest(spark: SparkSession, source: str | Source, paths: BronzePaths, run: RunContext,
           force: Collection[str] = (), commit_rows: int = COMMIT_ROWS) -> list[Row]:
    """Land every pending unit and those named in ``force`` (``["*"]``: all);
    return the units this run landed. A ``source`` given as a path is the
    folder of the fixture tables."""
    if isinstance(source, str):
        source = FixtureSource(spark, source)
    # The source is summed up once; the list is bounded by the calendar.
    found = ledger.work_units(spark, source.periods(), source.master())
    units = spark.createDataFrame(found.collect(), found.schema)
    done = ledger.read_ledger(spark, paths.ledger)
    todo = ledger.pending_units(units, done, force)
    if source.complete:
        todo = todo.unionByName(ledger.removed_units(units, done))
    pending = todo.collect()

    def commit(landed: list[Row]) -> None:
        ledger.record(spark.createDataFrame(landed, todo.schema), paths.ledger, run.ingested_at)

    master = [u for u in pending if u.run_key == MASTER_RUN_KEY]
    if master:
        write_dataset(source.institutions(run), paths.institutions)
        commit(master)
    for group in commit_groups([u for u in pending if u.year is not None], commit_rows):
        _land(spark, source, paths, run, group)
        commit(group)
    return pending


def commit_groups(units: list[Row], commit_rows: int) -> list[list[Row]]:
    """Quarters in order, in groups that reach ``commit_rows`` source rows with their last quarter."""
    groups, rows = [], commit_rows
    for u in sorted(units, key=lambda u: (u.year, u.quarter)):
        if rows >= commit_rows:
            groups.append([])
            rows = 0
        groups[-1].append(u)
        rows += u.n_rows or 0
    return groups


def _land(spark: SparkSession, source: Source, paths: BronzePaths, run: RunContext, units: list[Row]) -> None:
    periods = [(u.year, u.quarter) for u in units if u.n_rows != 0]
    if periods:
        # A source may return more than asked for; the filter keeps the result exact.
        land_financials(source.financials(run, periods).filter(in_periods(periods)), paths.financials)
    none = spark.createDataFrame([], T.StructType(
        [f for f in S.BRONZE_FINANCIALS.fields if f.name not in ("year", "quarter")]))
    for u in units:
        if u.n_rows == 0:                   # removed at the source
            write_dataset(none, f"{paths.financials}/year={u.year}/quarter={u.quarter}")


def read_bronze(spark: SparkSession, paths: BronzePaths) -> tuple[DataFrame, DataFrame]:
    return (read_dataset(spark, paths.institutions, S.BRONZE_INSTITUTIONS),
            read_dataset(spark, paths.financials, S.BRONZE_FINANCIALS))
