"""Gold serving tables.

``bank_health_metrics``
    Clean financials left-joined to clean institutions on ``cert`` (the fact
    side's ``repdte`` / ``asset`` win), three ratios and the capital class.
    Unmatched facts keep NULL name / city / state. The institution side is
    broadcast only after a bounded row count; otherwise it is a shuffle join
    on ``cert`` with adaptive skew splitting. Stored partitioned by ``year``
    and clustered by ``stalp``.

``dim_institution``
    One current version per institution from a single snapshot. The table keeps
    versions: later snapshots are merged (:mod:`tierone.operators.merge`); a
    history from snapshots at hand is :func:`tierone.operators.history.scd2_versions`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierone.config import OPEN_EXPIRY, RunContext
from tierone.functions.metrics import capital_class, pct_of_assets
from tierone.functions.period import derive_quarter, derive_year
from tierone.operators.asof import as_of_join
from tierone.operators.joins import DEFAULT_BROADCAST_ROWS, lookup_join
from tierone.sources.parquet import cluster, write_dataset

HEALTH_COLUMNS = [
    "cert", "name", "city", "stalp", "repdte", "year", "quarter", "asset", "dep",
    "lnlsnet", "rbct1", "npl_ratio_pct", "roa_pct", "deposit_to_asset_pct",
    "capital_adequacy_flag", "_loaded_at",
]


def with_period(fin: DataFrame) -> DataFrame:
    """Re-derive ``year`` / ``quarter`` from ``repdte`` (replacing any present)."""
    return fin.withColumns({
        "year": derive_year(F.col("repdte")),
        "quarter": derive_quarter(F.col("repdte")),
    })


def health_facts(fin: DataFrame, run: RunContext) -> DataFrame:
    """The columns of ``bank_health_metrics`` that come from the financials.

    ``cert`` is unique among the institutions, so reports that use no
    institution column get the same rows from here without the join.
    """
    asset = F.col("asset")
    return fin.select(
        "cert", "repdte", "year", "quarter", "asset", "dep", "lnlsnet", "rbct1",
        pct_of_assets(F.col("nperfv"), asset, 2).alias("npl_ratio_pct"),
        pct_of_assets(F.col("netinc"), asset, 4).alias("roa_pct"),
        pct_of_assets(F.col("dep"), asset, 2).alias("deposit_to_asset_pct"),
        capital_class(F.col("rbct1")).alias("capital_adequacy_flag"),
        F.lit(run.run_ts_sql).cast("timestamp_ntz").alias("_loaded_at"),
    )


def bank_health_metrics(fin: DataFrame, inst: DataFrame, run: RunContext,
                        max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    dim = inst.select("cert", "name", "city", "stalp")
    return lookup_join(health_facts(fin, run), dim, "cert", "left",
                       max_broadcast_rows).select(*HEALTH_COLUMNS)


def health_as_of(fin: DataFrame, versions: DataFrame, run: RunContext) -> DataFrame:
    """Health facts with the institution as it was at their report date."""
    return as_of_join(health_facts(fin, run), versions, "cert", "repdte",
                      ["name", "city", "stalp", "instcat", "charterclass", "active", "effective_date"])


def dim_institution(inst: DataFrame, run: RunContext) -> DataFrame:
    return inst.select(
        "cert", "name", "city", "stalp", "instcat", "charterclass", "active",
        F.col("repdte").alias("effective_date"),
        F.lit(OPEN_EXPIRY).alias("expiry_date"),
        F.lit(True).alias("is_current"),
        F.lit(run.run_ts_sql).cast("timestamp_ntz").alias("row_created_at"),
    )


def write_bank_health(health: DataFrame, path: str) -> None:
    """Partition by year, cluster by state (``cert`` splits a hot state)."""
    laid_out = cluster(health, ["year"], ["stalp"], ["cert"])
    write_dataset(laid_out, path, partition_by=["year"])


def write_dim(dim: DataFrame, path: str) -> None:
    write_dataset(cluster(dim, [], ["cert", "stalp"]), path)
