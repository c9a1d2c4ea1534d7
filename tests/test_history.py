"""Version history and period-over-period invariants."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierone.config import RunContext
from tierone.operators.history import scd2_versions, with_previous_quarter
from tierone.queries import _silver
from tierone.sources.fixtures import institution_snapshots

RUN = RunContext(dt.datetime(2024, 12, 31))
SNAP_SCHEMA = ("cert bigint, name string, city string, stalp string, instcat bigint, "
               "charterclass string, active bigint, repdte string")


def test_fixture_versions(spark, sf):
    si, _ = _silver(spark, sf)
    v = scd2_versions(institution_snapshots(si), RUN)
    assert v.count() == 243
    assert v.filter("is_current").groupBy("cert").count().filter("count <> 1").count() == 0
    assert v.select("cert").distinct().count() == si.count()


def test_intervals_abut(spark, sf):
    si, _ = _silver(spark, sf)
    v = scd2_versions(institution_snapshots(si), RUN)
    w = Window.partitionBy("cert").orderBy("effective_date")
    gaps = (v.withColumn("next_eff", F.lead("effective_date").over(w))
            .filter("next_eff IS NOT NULL AND next_eff <> expiry_date"))
    assert gaps.count() == 0


def test_unchanged_snapshots_add_no_version_and_nulls_compare_equal(spark):
    rows = [
        (1, "a", None, "N1", 1, "N", None, "20230331"),
        (1, "a", None, "N1", 1, "N", None, "20230630"),   # same, NULLs included
        (1, "a", None, "N1", 1, "SM", None, "20230930"),  # change
        (1, "a", None, "N1", 1, "N", None, "20231231"),   # change back
        (1, "a", None, "N1", 1, "N", None, "20231231"),   # exact duplicate
        (2, "b", "c", "N2", 2, "NM", 1, "20230331"),
    ]
    v = scd2_versions(spark.createDataFrame(rows, SNAP_SCHEMA), RUN).orderBy("cert", "effective_date")
    got = [(r.cert, r.effective_date, r.expiry_date, r.is_current, r.charterclass)
           for r in v.collect()]
    assert got == [
        (1, "20230331", "20230930", False, "N"),
        (1, "20230930", "20231231", False, "SM"),
        (1, "20231231", "99991231", True, "N"),
        (2, "20230331", "99991231", True, "NM"),
    ]


def test_one_version_per_snapshot_date(spark):
    rows = [
        (1, "a", "c", "N1", 1, "N", 1, "20230331"),
        (1, "a", "c", "N1", 1, "SM", 1, "20230331"),      # same date: the greater variant counts
        (1, None, "z", "N9", 9, "Z", 9, "20230331"),      # NULL is least
        (1, "a", "c", "N1", 1, "SM", 1, "20230630"),
        (None, "a", "c", "N1", 1, "N", 1, "20230331"),
    ]
    v = scd2_versions(spark.createDataFrame(rows, SNAP_SCHEMA), RUN)
    assert v.filter("effective_date >= expiry_date").count() == 0
    assert {(r.cert, r.charterclass, r.effective_date, r.expiry_date) for r in v.collect()} == {
        (1, "SM", "20230331", "99991231"), (None, "N", "20230331", "99991231")}


def test_previous_quarter_crosses_years(spark):
    df = spark.createDataFrame([(2023, 4, 1.0), (2024, 1, 3.0), (2024, 3, 5.0)],
                               "year int, quarter int, v double")
    got = {(r.year, r.quarter): r.prev_v for r in with_previous_quarter(df, ["v"]).collect()}
    assert got == {(2023, 4): None, (2024, 1): 1.0, (2024, 3): None}


def test_runs_of_the_dimension_read_the_tables_once(spark, sf, monkeypatch):
    from tierone import queries
    from tierone.plans import pipeline
    sources = []
    monkeypatch.setattr(pipeline, "run_pipeline", lambda spark, source, *args, **more: sources.append(source))
    with pytest.raises(Exception, match="dim_institution"):     # no run has built it
        queries.dim_versions(spark, sf)
    assert len(sources) == 4
    for source in sources:
        for frame in (source.institutions_df, source.financials_df):
            assert frame.inputFiles() and not any(sf in f for f in frame.inputFiles())
