"""Rule truth tables: each rule alone, all together, NULL pass-through."""

import math

import pytest
from pyspark.sql import functions as F

from tierone.operators.quality import (
    REASON,
    financials_rules,
    institution_rules,
    quarantined_rows,
    split,
    tag,
)

INST_SCHEMA = "cert bigint, asset bigint, name string, active bigint"
INST_CASES = [
    ((None, 5, "a", 1), "cert_is_null"),
    ((1, 0, "a", 1), "asset_non_positive"),
    ((1, None, "a", 1), ""),
    ((1, 5, " ", 1), "name_empty"),
    ((1, 5, None, 1), "name_empty"),
    ((1, 5, "\t", 1), ""),                       # trim removes spaces only
    ((1, 5, "a", 2), "active_invalid_value"),
    ((1, 5, "a", None), ""),
    ((None, -1, "", 9), "cert_is_null; asset_non_positive; name_empty; active_invalid_value"),
]

FIN_SCHEMA = "cert bigint, asset bigint, dep bigint, rbct1 double, repdte string"
FIN_CASES = [
    ((1, 5, None, 10.0, "20240331"), ""),
    ((1, 5, 5, None, "20240331"), ""),
    ((1, 5, 5, 10.0, None), ""),
    ((1, 5, 5, 0.0, "20240331"), ""),
    ((1, 5, 5, 100.0, "20240331"), ""),
    ((1, 5, 5, -0.01, "20240331"), "rbct1_out_of_range"),
    ((1, 5, 5, 100.01, "20240331"), "rbct1_out_of_range"),
    ((1, 5, 5, math.nan, "20240331"), "rbct1_out_of_range"),
    ((1, 5, 5, 10.0, "2024033"), "repdte_invalid_format"),
    ((1, 5, 5, 10.0, "202403311"), "repdte_invalid_format"),
    ((1, 5, 5, 10.0, "ABCDEFGH"), ""),
    ((1, 5, 0, 10.0, "20240331"), "dep_non_positive"),
    ((None, 0, 0, -1.0, "x"),
     "cert_is_null; asset_non_positive; dep_non_positive; rbct1_out_of_range; "
     "repdte_invalid_format"),
]


@pytest.mark.parametrize("row,reason", INST_CASES)
def test_institution_rules(spark, row, reason):
    df = spark.createDataFrame([row], INST_SCHEMA)
    assert tag(df, institution_rules()).select(REASON).first()[0] == reason


@pytest.mark.parametrize("row,reason", FIN_CASES)
def test_financials_rules(spark, row, reason):
    df = spark.createDataFrame([row], FIN_SCHEMA)
    assert tag(df, financials_rules()).select(REASON).first()[0] == reason


def test_split_partitions_rows(spark):
    df = spark.createDataFrame([r for r, _ in INST_CASES], INST_SCHEMA)
    clean, bad = split(df, institution_rules())
    assert clean.count() + bad.count() == df.count()
    assert REASON not in clean.columns
    assert bad.filter(F.col(REASON) == "").count() == 0
    assert clean.count() == sum(1 for _, r in INST_CASES if r == "")


def test_quarantine_keeps_reason(spark):
    df = spark.createDataFrame([r for r, _ in FIN_CASES], FIN_SCHEMA)
    bad = quarantined_rows(tag(df, financials_rules()))
    assert REASON in bad.columns
    assert bad.count() == sum(1 for _, r in FIN_CASES if r)
