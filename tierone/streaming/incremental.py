"""Incremental silver validation with Structured Streaming.

The file source records every bronze file it has consumed in the query
checkpoint; ``trigger(availableNow=True)`` works off whatever has landed since
the last run, in micro-batches bounded by ``maxFilesPerTrigger``, and stops.

A micro-batch only says which quarters have new files. Each such quarter is
validated whole from bronze and replaces its silver rows and its rejects, the
same overwrite the batch path does, misfiled rows included. So a quarter that is landed again replaces
its old rows, a quarter split over two batches ends complete, and a batch that
is run again after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierone import schemas as S
from tierone.config import RunContext
from tierone.plans.silver import quarantine_financials, settle_financials
from tierone.sources.parquet import read_dataset, write_dataset

# Files per micro-batch: with ~128 MB Parquet files, about 1.3 TB per batch.
DEFAULT_MAX_FILES_PER_TRIGGER = 10_000

_REJECT_PARTS = ["_run_id", "year", "quarter"]


def _quarters(df: DataFrame) -> set[tuple[int, int]]:
    """Distinct periods: bounded by the calendar."""
    return {(r.year, r.quarter) for r in df.select("year", "quarter").distinct().collect()}


def _replace_rejects(bad: DataFrame, path: str, run: RunContext,
                     periods: set[tuple[int, int]]) -> None:
    spark = bad.sparkSession
    write_dataset(bad, path, partition_by=_REJECT_PARTS)
    own = read_dataset(spark, path, S.QUARANTINE_FINANCIALS).filter(F.col("_run_id") == run.run_id)
    none = spark.createDataFrame([], T.StructType(
        [f for f in S.QUARANTINE_FINANCIALS.fields if f.name not in _REJECT_PARTS]))
    for year, quarter in sorted((_quarters(own) & periods) - _quarters(bad)):
        write_dataset(none, f"{path}/_run_id={run.run_id}/year={year}/quarter={quarter}")


def incremental_silver_financials(spark: SparkSession, bronze_path: str, silver_path: str,
                                  quarantine_path: str, checkpoint: str, run: RunContext,
                                  max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
                                  timeout_s: int | None = None) -> str:
    """Validate every quarter with unprocessed bronze files; return the silver path.

    Runs until the backlog is done; ``timeout_s`` is for callers that want a limit.
    """
    def validate(batch: DataFrame, batch_id: int) -> None:
        periods = _quarters(batch)
        if not periods:
            return
        whole = read_dataset(batch.sparkSession, bronze_path, S.BRONZE_FINANCIALS)
        _, landed = settle_financials(whole, silver_path, f"{checkpoint}/routes", run, sorted(periods))
        _replace_rejects(quarantine_financials(landed, run), quarantine_path, run, periods)

    reader = spark.readStream.schema(S.BRONZE_FINANCIALS).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    query = (reader.load(bronze_path).writeStream.foreachBatch(validate)
             .option("checkpointLocation", f"{checkpoint}/clean")
             .trigger(availableNow=True).start())
    try:
        if timeout_s is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_s):
            raise TimeoutError(f"streaming query {query.id} did not finish in {timeout_s}s")
    finally:
        query.stop()
    return silver_path
