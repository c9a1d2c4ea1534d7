"""Reports by name over the gold catalog tables equal the reports over their frames."""

import datetime as dt

import pytest

from tierone.config import RunContext
from tierone.plans import pipeline, reports
from tierone.plans.sql_reports import REPORTS, run_report
from tierone.session import scratch_path

DB = "tierone_test_sql"


@pytest.fixture(scope="module")
def gold(spark, sf):
    pipeline.run_pipeline(spark, sf, RunContext(dt.datetime(2024, 12, 31)),
                          scratch_path(spark, "sql-reports"), database=DB)
    return DB


def _frame_reports(spark, db):
    health = spark.table(f"{db}.bank_health_metrics")
    return {
        "capital_distribution": reports.capital_distribution(health),
        "quarter_trend": reports.quarter_trend(health),
        "regional_summary": reports.regional_summary(health),
        "dim_current_sample": reports.dim_current_sample(spark.table(f"{db}.dim_institution")),
        "dq_scorecard_audit": reports.scorecard_audit(spark.table(f"{db}.dq_scorecard")),
    }


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_by_name_equals_dataframe_report(spark, gold, name):
    expected = _frame_reports(spark, gold)[name]
    got = run_report(spark, gold, name)
    assert got.columns == expected.columns
    assert got.collect() == expected.collect()        # same order too


def test_year_filter_prunes_partitions(spark, gold):
    plan = run_report(spark, gold, "regional_summary")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
