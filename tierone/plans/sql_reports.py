"""The gold reports over the catalog tables of a database, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierone.plans import reports

#: report -> (table it reads, function over that table)
REPORTS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "capital_distribution": ("bank_health_metrics", reports.capital_distribution),
    "quarter_trend": ("bank_health_metrics", reports.quarter_trend),
    "regional_summary": ("bank_health_metrics", reports.regional_summary),
    "dim_current_sample": ("dim_institution", reports.dim_current_sample),
    "dq_scorecard_audit": ("dq_scorecard", reports.scorecard_audit),
}


def run_report(spark: SparkSession, db: str, name: str, **parameters: int) -> DataFrame:
    """``parameters`` go to the report: ``year``, ``quarter`` or ``n``."""
    table, report = REPORTS[name]
    return report(spark.table(f"`{db}`.{table}"), **parameters)
