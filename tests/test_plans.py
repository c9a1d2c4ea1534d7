"""Physical-plan checks: pruning, pushdown, join strategy, no Python in plans."""

import re

import pytest

from tierone.operators.joins import fits_broadcast, lookup_join, measure
from tierone.queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def full_plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_partition_pruning_on_clustered_health(spark, sf):
    df = QUERIES["health_partition_pruned"](spark, sf)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(year" in p and "(year" in p
    assert "PushedFilters: [" in p and "EqualTo(stalp,N3)" in p


def test_flagship_broadcasts_checked_dimension(spark, sf):
    df = QUERIES["bank_health_metrics"](spark, sf)
    assert "BroadcastHashJoin" in full_plan(df)


def test_lookup_join_falls_back_past_the_bound(spark):
    fact = spark.range(100).selectExpr("id % 10 AS k", "id AS v")
    dim = spark.range(10).selectExpr("id AS k", "repeat('x', 10) AS w")
    assert measure(dim) == (10, 10 * (8 + 10))
    for kwargs in ({"max_broadcast_rows": 5}, {"max_broadcast_bytes": 100}):
        text = full_plan(lookup_join(fact, dim, "k", "left", **kwargs))
        assert "strategy=broadcast" not in text
    text = full_plan(lookup_join(fact, dim, "k", "left", max_broadcast_rows=50))
    assert "strategy=broadcast" in text


def test_report_scan_reads_only_needed_columns(spark, sf):
    df = QUERIES["regional_summary"](spark, sf)
    p = plan(df)
    # The orders scan reads three columns, not the whole table.
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp" in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_evaluation(spark, sf, name):
    p = plan(QUERIES[name](spark, sf))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
                 "FlatMapGroupsInPandas"):
        assert node not in p, f"{name} runs Python: {node}"


def test_landing_filter_runs_before_the_aggregation(spark, sf):
    from tierone.config import FIXED_RUN
    from tierone.functions.period import in_periods
    from tierone.sources import fixtures
    fin = fixtures.financials(spark, sf, FIXED_RUN).filter(in_periods([(2024, 4)]))
    p = plan(fin)
    partial = p.index("partial_sum")
    # The period predicate sits below the partial aggregation, on the scan.
    below = p[partial:]
    assert "Filter" in below and "+ 24) = 2024)" in below and "= 4)" in below
    assert fin.count() == fixtures.financials(spark, sf, FIXED_RUN).filter(
        "year = 2024 AND quarter = 4").count()


def test_landing_quarters_skip_by_order_date_statistics(spark, sf):
    from tierone.config import FIXED_RUN
    from tierone.functions.period import in_periods
    from tierone.sources import fixtures
    periods = [(2024, 4), (2019, 3)]
    ranged = fixtures.financials(spark, sf, FIXED_RUN, periods).filter(in_periods(periods))
    full = fixtures.financials(spark, sf, FIXED_RUN).filter(in_periods(periods))
    assert sorted(map(tuple, ranged.collect()), key=str) == \
        sorted(map(tuple, full.collect()), key=str)
    p = plan(ranged)
    assert "GreaterThanOrEqual(o_orderdate,2000-10-01T00:00)" in p
    assert "LessThan(o_orderdate,2001-01-01T00:00)" in p


def test_reports_on_one_year_or_quarter_push_the_order_dates(spark, sf):
    for name, start in (("capital_distribution", "2000-01-01"), ("regional_summary", "2000-10-01")):
        p = plan(QUERIES[name](spark, sf))
        assert f"GreaterThanOrEqual(o_orderdate,{start}T00:00)" in p, name


@pytest.mark.parametrize("name", ["quarter_trend", "quarter_change", "dq_pass_trend",
                                  "capital_distribution"])
def test_financial_reports_read_orders_once_and_nothing_else(spark, sf, name):
    p = plan(QUERIES[name](spark, sf))
    assert p.count("FileScan parquet") == 1 and "orders.parquet" in p
    assert "Join" not in p


def test_lookup_pushes_the_range_of_its_keys(spark, sf):
    p = plan(QUERIES["dim_clustered_lookup"](spark, sf))
    # The scan node prints its filters cut short; the filter above it shows both bounds.
    assert "GreaterThanOrEqual(cert," in p and re.search(r"cert#\d+L <= \d+", p)


def test_sides_with_nested_columns_are_not_broadcast(spark):
    dim = spark.range(10).selectExpr("id AS k", "array(id) AS w")
    assert not fits_broadcast(dim) and fits_broadcast(dim.select("k"))
