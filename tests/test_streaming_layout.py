"""Incremental (streaming) silver and the clustered gold layout."""

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tierone import schemas as S
from tierone.config import FIXED_RUN
from tierone.plans import bronze, gold
from tierone.queries import _bronze, _health
from tierone.session import scratch_path
from tierone.sources.parquet import read_dataset
from tierone.streaming import incremental_silver_financials


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def test_stream_processes_each_bronze_file_once(spark, sf):
    base = scratch_path(spark, "stream-test")
    _, fin = _bronze(spark, sf)
    src, out, bad, ckpt = (f"{base}/bronze", f"{base}/silver", f"{base}/quarantine",
                           f"{base}/ckpt")
    early = fin.filter(F.col("year") < 2023)
    late = fin.filter(F.col("year") >= 2023)
    bronze.land_financials(early, src)
    incremental_silver_financials(spark, src, out, bad, ckpt, FIXED_RUN)
    n_early = read_dataset(spark, out, S.SILVER_FINANCIALS).count()

    incremental_silver_financials(spark, src, out, bad, ckpt, FIXED_RUN)   # nothing new
    assert read_dataset(spark, out, S.SILVER_FINANCIALS).count() == n_early

    late.write.mode("append").partitionBy("year", "quarter").parquet(src)  # new quarters land
    incremental_silver_financials(spark, src, out, bad, ckpt, FIXED_RUN)
    silver = read_dataset(spark, out, S.SILVER_FINANCIALS)
    quarantine = read_dataset(spark, bad, S.QUARANTINE_FINANCIALS)
    assert silver.count() == 1237 and quarantine.count() == 26
    assert silver.groupBy("cert", "year", "quarter").count().filter("count > 1").count() == 0


def test_relanded_quarter_replaces_its_rows(spark, sf):
    base = scratch_path(spark, "stream-again")
    _, fin = _bronze(spark, sf)
    paths = [f"{base}/{p}" for p in ("bronze", "silver", "quarantine", "ckpt")]
    bronze.land_financials(fin, paths[0])
    incremental_silver_financials(spark, *paths, FIXED_RUN)
    bronze.land_financials(fin.filter("year = 2024 AND quarter = 4"), paths[0])
    incremental_silver_financials(spark, *paths, FIXED_RUN)
    assert read_dataset(spark, paths[1], S.SILVER_FINANCIALS).count() == 1237
    assert read_dataset(spark, paths[2], S.QUARANTINE_FINANCIALS).count() == 26


def test_health_files_sorted_by_state_within_year(spark, sf):
    path = scratch_path(spark, "layout")
    gold.write_bank_health(_health(spark, sf), path)
    files = glob.glob(os.path.join(_local(path), "year=*", "*.parquet"))
    assert files
    for f in files:
        states = [s for s in pq.read_table(f, columns=["stalp"]).column("stalp").to_pylist()
                  if s is not None]
        assert states == sorted(states), f


def test_stream_backlog_in_bounded_batches(spark, sf):
    base = scratch_path(spark, "stream-batches")
    _, fin = _bronze(spark, sf)
    bronze.land_financials(fin, f"{base}/bronze")
    incremental_silver_financials(spark, f"{base}/bronze", f"{base}/silver", f"{base}/q",
                                  f"{base}/ckpt", FIXED_RUN, max_files_per_trigger=3)
    assert read_dataset(spark, f"{base}/silver", S.SILVER_FINANCIALS).count() == 1237
    commits = glob.glob(os.path.join(_local(f"{base}/ckpt"), "clean", "commits", "[0-9]*"))
    files = glob.glob(os.path.join(_local(f"{base}/bronze"), "year=*", "quarter=*", "*.parquet"))
    assert len(commits) == -(-len(files) // 3) > 1
