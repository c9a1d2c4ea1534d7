"""Per-dataset invariants of the pipeline on the sf0.001 fixture."""

from pyspark.sql import functions as F

from tierone.queries import _bronze, _health, _silver, _tagged
from tierone.operators.quality import REASON


def test_clean_plus_quarantine_is_total(spark, sf):
    for tagged in _tagged(spark, sf):
        total = tagged.count()
        clean = tagged.filter(F.col(REASON) == "").count()
        bad = tagged.filter(F.col(REASON) != "").count()
        assert clean + bad == total
        assert tagged.filter(F.col(REASON).isNull()).count() == 0


def test_fixture_counts(spark, sf):
    bi, bf = _bronze(spark, sf)
    si, sfin = _silver(spark, sf)
    assert (bi.count(), si.count()) == (150, 132)
    assert (bf.count(), sfin.count()) == (1263, 1237)


def test_silver_has_no_reason_and_unique_cert(spark, sf):
    si, sfin = _silver(spark, sf)
    assert REASON not in si.columns and REASON not in sfin.columns
    assert si.groupBy("cert").count().filter("count > 1").count() == 0


def test_health_rows_equal_clean_facts(spark, sf):
    _, sfin = _silver(spark, sf)
    health = _health(spark, sf)
    assert health.count() == sfin.count()
    # Facts of rejected or unknown institutions stay, with NULL attributes.
    assert health.filter(F.col("name").isNull()).count() == 141
    classes = {r[0]: r[1] for r in health.groupBy("capital_adequacy_flag").count().collect()}
    assert classes == {"Well Capitalised": 685, "Adequately Capitalised": 177,
                       "Undercapitalised": 188, "Critically Undercapitalised": 187}


def test_bank_quarters_sum_to_year_rows(spark, sf):
    from tierone.plans.reports import capital_distribution
    health = _health(spark, sf)
    total = capital_distribution(health, 2024).agg(F.sum("bank_quarters")).first()[0]
    assert total == health.filter("year = 2024").count() == 175


def test_derived_period_equals_partition(spark, sf):
    from tierone.plans.gold import with_period
    _, sfin = _silver(spark, sf)
    derived = with_period(sfin.select("repdte", F.col("year").alias("py"),
                                      F.col("quarter").alias("pq")))
    assert derived.filter("year <> py OR quarter <> pq OR year IS NULL").count() == 0
