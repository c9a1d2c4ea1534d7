"""Run ledger: which units of ingest work have committed, and what they held.

A unit is the institution master or one (year, quarter) of financials. The
ledger is a Parquet table that only grows: a unit's row is appended after the
write that produced it has committed, so a crash loses at most the units in
flight, and they are simply redone (partition writes are idempotent). A row
holds the unit's fingerprint (:mod:`tierone.operators.fingerprint`) at its
source; a unit whose source differs from its last landing is pending again,
and the landings of a unit are numbered. Bronze, silver and gold each keep a
ledger; what a stage has to do is the difference to the stage before it, so a
run that died between two stages is completed by the next one.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierone.config import FINANCIALS_RUN_KEY_FORMAT, MASTER_RUN_KEY
from tierone.operators.fingerprint import FINGERPRINT
from tierone.schemas import LEDGER


def _fingerprinted(df: DataFrame) -> DataFrame:
    """``df`` with the fingerprint columns in the ledger's types; NULL where it has none."""
    return df.withColumns({
        c: (F.col(c) if c in df.columns else F.lit(None)).cast(LEDGER[c].dataType) for c in FINGERPRINT})


def work_units(spark: SparkSession, periods: DataFrame, master: DataFrame | None = None) -> DataFrame:
    """``run_key, year, quarter`` and fingerprint of every unit the data calls for.

    ``periods`` has ``year`` and ``quarter``, and may have the fingerprint
    columns (one row for each period then); ``master`` is the master's fingerprint.
    """
    if not set(FINGERPRINT) <= set(periods.columns):
        periods = periods.select("year", "quarter").distinct()
    fin_units = _fingerprinted(periods).select(
        F.format_string(FINANCIALS_RUN_KEY_FORMAT, "year", "quarter").alias("run_key"),
        "year", "quarter", *FINGERPRINT)
    head = spark.range(1) if master is None else master
    no_period = F.lit(None).cast("int")
    return _fingerprinted(head).select(
        F.lit(MASTER_RUN_KEY).alias("run_key"), no_period.alias("year"), no_period.alias("quarter"),
        *FINGERPRINT).unionByName(fin_units)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; an empty one is created at the first use of ``path``."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def _version() -> Column:
    """What orders a unit's rows; ledgers written before landings were numbered have none."""
    return F.struct(F.coalesce("landing", F.lit(0)).alias("landing"), "completed_at")


def last_landings(ledger: DataFrame) -> DataFrame:
    """``run_key`` and its last row as ``last``."""
    return ledger.groupBy("run_key").agg(
        F.max_by(F.struct("landing", *FINGERPRINT), _version()).alias("last"))


def pending_units(units: DataFrame, ledger: DataFrame, force: Collection[str] = ()) -> DataFrame:
    """Units never landed, changed since, or named in ``force`` (``"*"``: all), with the ``landing`` to come.

    A unit recorded without a fingerprint counts as unchanged.
    """
    both = units.join(last_landings(ledger), "run_key", "left")
    changed = F.lit(False)
    for c in FINGERPRINT:
        changed = changed | F.coalesce(F.col(c) != F.col(f"last.{c}"), F.lit(False))
    forced = F.lit(True) if "*" in force else F.col("run_key").isin(*force)
    return (both.filter(F.col("last").isNull() | changed | forced)
            .select(*units.columns, _next_landing()))


def _next_landing() -> Column:
    first = F.when(F.col("last").isNull(), F.lit(1).cast("bigint"))
    return F.coalesce(first, F.coalesce("last.landing", F.lit(1)) + F.lit(1)).alias("landing")


def removed_units(units: DataFrame, ledger: DataFrame) -> DataFrame:
    """Financials units landed with rows that the source no longer has, as units without rows."""
    had_rows = F.coalesce("last.n_rows", F.lit(1)) > F.lit(0)
    gone = (last_landings(ledger).filter(had_rows & (F.col("run_key") != F.lit(MASTER_RUN_KEY)))
            .join(units.select("run_key"), "run_key", "left_anti"))
    return _fingerprinted(gone.withColumns({c: F.lit(0) for c in FINGERPRINT})).select(
        "run_key", *period_of(F.col("run_key")), *FINGERPRINT, _next_landing())


def record(units: DataFrame, path: str, completed_at: str) -> None:
    """Append ``units``: ``run_key`` and, as far as known, landing and fingerprint."""
    landing = F.col("landing") if "landing" in units.columns else F.lit(1)
    (_fingerprinted(units).withColumns({"completed_at": F.lit(completed_at), "landing": landing.cast("bigint")})
     .select(*LEDGER.fieldNames()).write.mode("append").format("parquet").save(path))


def stage_pending(upstream: DataFrame, own: DataFrame) -> DataFrame:
    """``run_key, completed_at, landing`` and period of units whose last upstream landing this stage has not done.

    A stage's ledger holds, per unit, the upstream version it processed, so a
    unit that is landed again is pending again downstream.
    """
    def latest(ledger: DataFrame, name: str) -> DataFrame:
        return ledger.groupBy("run_key").agg(F.max(_version()).alias(name))

    both = latest(upstream, "new").join(latest(own, "done"), "run_key", "left")
    return (both.filter(F.col("done").isNull() | (F.col("done") < F.col("new")))
            .select("run_key", "new.completed_at", "new.landing", *period_of(F.col("run_key"))))


def period_of(run_key: Column) -> tuple[Column, Column]:
    """(year, quarter) in a financials key; NULL for the master."""
    digits = FINANCIALS_RUN_KEY_FORMAT.replace("%d", "([0-9]+)")
    parts = [F.nullif(F.regexp_extract(run_key, digits, i), F.lit("")).cast("int") for i in (1, 2)]
    return parts[0].alias("year"), parts[1].alias("quarter")


def record_versions(versions: DataFrame, path: str) -> None:
    (_fingerprinted(versions).select(*LEDGER.fieldNames())
     .write.mode("append").format("parquet").save(path))


def completed(ledger: DataFrame) -> DataFrame:
    """One row per unit: its first completion."""
    return ledger.groupBy("run_key").agg(F.min("completed_at").alias("completed_at"))
