"""Column functions: capital class, period derivation, pinned rounding."""

import pytest
from pyspark.sql import functions as F

from tierone.functions import (
    capital_class,
    derive_quarter,
    derive_year,
    pct_of_assets,
    quarter_end_repdte,
    round_half_up,
)


@pytest.mark.parametrize("rbct1,label", [
    (10.0, "Well Capitalised"),
    (9.99, "Adequately Capitalised"),
    (8.0, "Adequately Capitalised"),
    (7.99, "Undercapitalised"),
    (6.0, "Undercapitalised"),
    (5.99, "Critically Undercapitalised"),
    (0.0, "Critically Undercapitalised"),
    (None, "Critically Undercapitalised"),
])
def test_capital_class_boundaries(spark, rbct1, label):
    df = spark.createDataFrame([(rbct1,)], "rbct1 double")
    assert df.select(capital_class(F.col("rbct1"))).first()[0] == label


def test_period_derivation(spark):
    rows = [(f"2024{m:02d}15",) for m in range(1, 14)] + [("2024XX31",), ("ABCDEFGH",), (None,)]
    df = spark.createDataFrame(rows, "repdte string")
    got = df.select(derive_year(F.col("repdte")).alias("y"),
                    derive_quarter(F.col("repdte")).alias("q")).collect()
    quarters = [r.q for r in got]
    assert quarters[:12] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]
    assert quarters[12] == 5                     # month 13: no month check
    assert quarters[13] is None and quarters[14] is None and quarters[15] is None
    assert [r.y for r in got][:13] == [2024] * 13
    assert got[14].y is None


def test_quarter_end(spark):
    df = spark.createDataFrame([(2024, q) for q in range(1, 6)], "year int, quarter int")
    got = [r[0] for r in df.select(quarter_end_repdte(F.col("year"), F.col("quarter"))).collect()]
    assert got == ["20240331", "20240630", "20240930", "20241231", None]


def test_rounding_ties(spark):
    df = spark.createDataFrame([(1.005,), (11.085,), (2.675,), (-1.005,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()]
    assert got == [1.01, 11.09, 2.68, -1.01, None]


def test_average_rounding_is_order_independent(spark):
    vals = [(v / 100.0,) for v in range(1000, 1031)]
    df = spark.createDataFrame(vals, "x double")
    one = df.coalesce(1).agg(round_half_up(F.avg("x"), 2)).first()[0]
    many = df.repartition(7).agg(round_half_up(F.avg("x"), 2)).first()[0]
    assert one == many == 10.15


def test_ratio_zero_assets_is_null(spark):
    df = spark.createDataFrame([(5, 0), (5, None), (1, 3)], "n bigint, a bigint")
    got = [r[0] for r in df.select(pct_of_assets(F.col("n"), F.col("a"), 2)).collect()]
    assert got == [None, None, 33.33]


def test_scale_settings_size_partitions():
    from tierone.session import MIB, scale_settings
    tb = 1024 ** 4
    big = scale_settings(20 * tb, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 20 * tb // (128 * MIB)
    small = scale_settings(10 * MIB, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_scorecard_run_id_is_formatted_run_time(spark):
    import datetime as dt
    from tierone.config import RunContext
    from tierone.operators.scorecard import counts_from_observed
    run = RunContext(dt.datetime(2026, 6, 10, 14, 12, 34))
    row = counts_from_observed(spark, "institutions", "silver_transform", 10, 9, run).first()
    assert row.run_id == run.run_id == "20260610_141234"
    assert (row.quarantine_records, row.dq_pass_pct) == (1, 90.0)
