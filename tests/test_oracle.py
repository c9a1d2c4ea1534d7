"""Differential: every registered query against its DuckDB statement (sf0.001)."""

import pytest

import __spark_entry__ as E
from tierone.oracle import oracle_sql
from tierone.queries import QUERIES
from tools.compare import duck, rows_of_duck, rows_of_spark

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, con, name):
    s_cols, s_rows = rows_of_spark(QUERIES[name](spark, sf))
    d_cols, d_rows = rows_of_duck(con, oracle_sql()[name])
    assert s_cols == d_cols
    assert s_rows == d_rows


@pytest.mark.parametrize("name", ["capital_distribution", "quarter_trend", "regional_summary",
                                  "dq_scorecard_audit", "dim_current_sample", "table_inventory"])
def test_reports_come_in_the_order_of_the_oracle(spark, sf, con, name):
    got = QUERIES[name](spark, sf)
    want = con.execute(oracle_sql()[name])
    columns = [d[0] for d in want.description]
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    keys = [i for i, c in enumerate(columns) if not isinstance(rows[0][i], float)
            and c not in ("created_at", "_loaded_at")]
    assert [[row[i] for i in keys] for row in rows] == [[row[i] for i in keys] for row in want.fetchall()]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "cert", "name", "city", "stalp", "repdte", "year", "quarter", "asset", "dep",
        "lnlsnet", "rbct1", "npl_ratio_pct", "roa_pct", "deposit_to_asset_pct",
        "capital_adequacy_flag", "_loaded_at"]
