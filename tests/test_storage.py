"""Storage behaviour: round trips, overwrite modes, ledger, idempotent runs."""

import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from tierone import schemas as S
from tierone.config import RunContext
from tierone.plans import pipeline
from tierone.session import scratch_path
from tierone.sources import catalog, ledger
from tierone.sources.parquet import read_dataset, write_dataset

RUN1 = RunContext(dt.datetime(2024, 12, 31, 1, 2, 3))
RUN2 = RunContext(dt.datetime(2025, 3, 31, 1, 2, 3))


def test_empty_partitioned_quarantine_is_readable(spark):
    path = scratch_path(spark, "empty-q")
    empty = spark.createDataFrame([], S.QUARANTINE_INSTITUTIONS)
    write_dataset(empty, path, partition_by=["_run_id"])
    back = read_dataset(spark, path, S.QUARANTINE_INSTITUTIONS)
    assert back.count() == 0 and back.schema.fieldNames() == S.QUARANTINE_INSTITUTIONS.fieldNames()


def test_dynamic_overwrite_keeps_other_partitions(spark):
    path = scratch_path(spark, "dyn")
    df = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "v int, year int, quarter int")
    write_dataset(df, path, partition_by=["year", "quarter"])
    write_dataset(spark.createDataFrame([(9, 2024, 2)], "v int, year int, quarter int"),
                  path, partition_by=["year", "quarter"])
    got = sorted((r.v, r.quarter) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (9, 2)]


def test_missing_ledger_is_empty_but_other_errors_raise(spark):
    path = scratch_path(spark, "ledger")
    assert ledger.read_ledger(spark, path).count() == 0
    ledger.record(spark.createDataFrame([("u1", None, None)], "run_key string, year int, quarter int"),
                  path, "t1")
    assert [r.run_key for r in ledger.read_ledger(spark, path).collect()] == ["u1"]


def test_pipeline_is_idempotent(spark, sf):
    base = scratch_path(spark, "pipe")
    first = pipeline.run_pipeline(spark, sf, RUN1, base, database="tierone_test_pipe")
    assert first.pending_units == 28
    inv1 = {r.table_id: r.row_count for r in catalog.table_inventory(spark, "tierone_test_pipe").collect()}
    assert inv1 == {"bank_health_metrics": 1237, "dim_institution": 132, "dq_scorecard": 3,
                    "financials_raw": 1237, "institutions_raw": 132}

    second = pipeline.run_pipeline(spark, sf, RUN1, base, database="tierone_test_pipe")
    assert second.pending_units == 0
    inv2 = {r.table_id: r.row_count for r in catalog.table_inventory(spark, "tierone_test_pipe").collect()}
    assert inv2 == inv1                             # same run id: nothing duplicated

    # A later run with nothing new to land validates nothing and says so.
    third = pipeline.run_pipeline(spark, sf, RUN2, base, database="tierone_test_pipe")
    assert third.pending_units == 0
    assert [(r["dataset"], r["total_records"], r["dq_pass_pct"]) for r in third.scorecard] == [
        ("full_pipeline", 0, None)]
    card = spark.table("tierone_test_pipe.dq_scorecard")
    assert card.count() == 4 and card.select("run_date").distinct().count() == 2
    qi = read_dataset(spark, f"{base}/quarantine/institutions", S.QUARANTINE_INSTITUTIONS)
    assert qi.groupBy("_run_id").count().count() == 1

    # A full refresh reprocesses everything under its own run id.
    run3 = RunContext(dt.datetime(2025, 6, 30, 1, 2, 3))
    fourth = pipeline.run_pipeline(spark, sf, run3, base, database="tierone_test_pipe",
                                   full_refresh=True)
    assert {r["dataset"]: r["total_records"] for r in fourth.scorecard} == {
        "institutions": 150, "financials": 1263, "full_pipeline": 1413}
    qi = read_dataset(spark, f"{base}/quarantine/institutions", S.QUARANTINE_INSTITUTIONS)
    assert qi.groupBy("_run_id").count().count() == 2   # each run keeps its rejects
    inv4 = {r.table_id: r.row_count for r in catalog.table_inventory(spark, "tierone_test_pipe").collect()}
    assert inv4 == {**inv1, "dq_scorecard": 7}
    sizes = catalog.table_sizes(spark, "tierone_test_pipe").collect()
    assert all(r.size_kb > 0 for r in sizes) and len(sizes) == 5
    for r in sizes:
        where = catalog.table_location(spark, "tierone_test_pipe", r.table_id).removeprefix("file:")
        files = Path(where).rglob("*.parquet")
        assert r.size_kb == sum(f.stat().st_size for f in files) / 1024


def test_run_after_a_death_between_stages_completes_it(spark, sf):
    from tierone.plans import bronze
    run2 = RunContext(dt.datetime(2025, 3, 31, 1, 2, 3))
    want = {"bank_health_metrics": 1237, "dim_institution": 132,
            "financials_raw": 1237, "institutions_raw": 132}
    for stop in ("bronze", "silver"):
        base, db = scratch_path(spark, f"died-{stop}"), f"tierone_test_died_{stop}"
        bronze.ingest(spark, sf, bronze.BronzePaths(base), RUN1)
        if stop == "silver":
            pipeline.silver_stage(spark, base, RUN1)
        result = pipeline.run_pipeline(spark, sf, run2, base, database=db)
        assert result.pending_units == 0
        inv = {r.table_id: r.row_count for r in catalog.table_inventory(spark, db).collect()}
        assert {k: inv[k] for k in want} == want
        card = spark.table(f"{db}.dq_scorecard").filter("dataset = 'full_pipeline'").collect()
        assert [r.total_records for r in card] == [1413]


def test_forced_unit_lands_again_and_reaches_gold(spark, sf):
    base, db = scratch_path(spark, "forced"), "tierone_test_forced"
    pipeline.run_pipeline(spark, sf, RUN1, base, database=db)
    run2 = RunContext(dt.datetime(2025, 3, 31, 1, 2, 3))
    result = pipeline.run_pipeline(spark, sf, run2, base, database=db, force=["financials_2024_Q4"])
    assert result.pending_units == 1
    loaded = {r.year for r in spark.table(f"{db}.bank_health_metrics").filter(
        F.col("_loaded_at") == F.lit(run2.run_ts_sql).cast("timestamp_ntz")).select("year").distinct().collect()}
    assert loaded == {2024} and spark.table(f"{db}.bank_health_metrics").count() == 1237


def test_second_process_finds_the_tables_of_the_first(spark, sf):
    """Without the catalog's entries, as a new process starts; external files stay."""
    base, db = scratch_path(spark, "second"), "tierone_test_second"
    pipeline.run_pipeline(spark, sf, RUN1, base, database=db)
    catalog.drop_tables(spark, db, catalog.list_tables(spark, db))
    run2 = RunContext(dt.datetime(2025, 3, 31, 1, 2, 3))
    pipeline.run_pipeline(spark, sf, run2, base, database=db)
    assert spark.table(f"{db}.bank_health_metrics").count() == 1237
    assert spark.table(f"{db}.dq_scorecard").select("run_id").distinct().count() == 2


def test_run_validates_only_the_quarters_it_landed(spark, sf):
    from tierone.plans import silver
    from tierone.plans.bronze import BronzePaths, read_bronze
    base = scratch_path(spark, "only-landed")
    pipeline.run_pipeline(spark, sf, RUN1, base, database="tierone_test_landed")
    bi, bf = read_bronze(spark, BronzePaths(base))
    rows = silver.run_silver(spark, bi, bf, silver.SilverPaths(base), RUN2,
                             periods=[(2024, 4)], institutions=False).collect()
    assert [(r.dataset, r.total_records) for r in rows] == [
        ("financials", bf.filter("year = 2024 AND quarter = 4").count())]
    back = read_dataset(spark, f"{base}/silver/financials", S.SILVER_FINANCIALS)
    stamps = {(r.year, r.quarter): r._transformed_at
              for r in back.select("year", "quarter", "_transformed_at").distinct().collect()}
    assert stamps[(2024, 4)] == RUN2.run_id
    assert {v for k, v in stamps.items() if k != (2024, 4)} == {RUN1.run_id}
    assert back.count() == 1237


def test_append_doubles_and_replace_does_not(spark, sf):
    import __spark_entry__ as E
    rep = {r.table_id: r.row_count for r in E.queries()["raw_load_replace"](spark, sf).collect()}
    app = {r.table_id: r.row_count for r in E.queries()["raw_load_append"](spark, sf).collect()}
    assert {k: 2 * v for k, v in rep.items()} == app


def test_column_comments_reach_the_catalog(spark, sf):
    base = scratch_path(spark, "cmt")
    pipeline.run_pipeline(spark, sf, RUN1, base, database="tierone_test_cmt")
    cols = {c.name: c.description for c in spark.catalog.listColumns("tierone_test_cmt.dq_scorecard")}
    assert cols["dq_pass_pct"] == "clean / total, percent, 4 dp"
    for table in ("bank_health_metrics", "dim_institution", "dq_scorecard"):
        desc = spark.sql(f"DESCRIBE TABLE EXTENDED tierone_test_cmt.{table}").filter(
            F.col("col_name") == "Comment").collect()
        assert desc and desc[0].data_type == S.TABLE_COMMENTS[table]


def test_rerun_clears_a_quarter_whose_rows_all_fail(spark):
    from tierone.plans import silver
    path = scratch_path(spark, "emptied")
    good = [(1, "20240331", 5, 5, 1, 1, 1, 1, 10.0, 1, "t", "s", 2024, 1),
            (2, "20240630", 5, 5, 1, 1, 1, 1, 10.0, 1, "t", "s", 2024, 2)]
    df = spark.createDataFrame(good, S.BRONZE_FINANCIALS)
    assert silver.write_silver_financials(silver.tag_financials(df), path, RUN1) == 2
    # Re-run of Q2 where the only row now fails: Q2 must end up empty, Q1 untouched.
    bad = [(2, "20240630", 0, 5, 1, 1, 1, 1, 10.0, 1, "t", "s", 2024, 2)]
    rerun = silver.tag_financials(spark.createDataFrame(bad, S.BRONZE_FINANCIALS))
    assert silver.write_silver_financials(rerun, path, RUN2, [(2024, 2)]) == 0
    back = read_dataset(spark, path, S.SILVER_FINANCIALS)
    assert sorted((r.cert, r.quarter) for r in back.collect()) == [(1, 1)]


def test_external_tables_partitions_and_drop(spark):
    path = scratch_path(spark, "ext")
    df = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2), (3, 2023, 4)],
                               "v int, year int, quarter int")
    write_dataset(df, path, partition_by=["year", "quarter"])
    db = "tierone_test_ext"
    catalog.ensure_database(spark, db, scratch_path(spark, "ext-db"))
    catalog.drop_tables(spark, db, ["t"])
    schema = "v INT, year INT, quarter INT"
    spark.sql(f"CREATE TABLE {db}.t ({schema}) USING parquet PARTITIONED BY (year, quarter) "
              f"LOCATION '{path}'")
    assert spark.table(f"{db}.t").count() == 0            # partitions not yet known
    spark.catalog.recoverPartitions(f"{db}.t")
    assert spark.table(f"{db}.t").count() == 3
    assert spark.table(f"{db}.t").filter("year = 2024").count() == 2
    catalog.drop_tables(spark, db, ["t"])                  # external: files stay
    assert spark.read.parquet(path).count() == 3


def test_incremental_gold_rebuilds_only_the_given_years(spark, sf):
    from tierone.plans import warehouse
    db = "tierone_test_incr"
    pipeline.run_pipeline(spark, sf, RUN1, scratch_path(spark, "incr"), database=db)
    health = f"{db}.bank_health_metrics"
    before = {r.year: r.n for r in spark.table(health).groupBy("year")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    warehouse.build_serving(spark, db, RUN2, years=[2024], rebuild_dim=False)
    spark.catalog.refreshTable(health)
    after = spark.table(health)
    by_year = {r.year: (r.n, r.loaded) for r in after.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.max("_loaded_at").alias("loaded")).collect()}
    assert {y: n for y, (n, _) in by_year.items()} == before
    assert by_year[2024][1] == RUN2.run_ts
    assert all(loaded == RUN1.run_ts for y, (_, loaded) in by_year.items() if y != 2024)
    # A later run that lands nothing new leaves the fact table alone.
    base, db_b = scratch_path(spark, "incr2"), db + "_b"
    pipeline.run_pipeline(spark, sf, RUN1, base, database=db_b)
    second = pipeline.run_pipeline(spark, sf, RUN2, base, database=db_b)
    assert second.pending_units == 0
    loaded = spark.table(f"{db_b}.bank_health_metrics").agg(F.max("_loaded_at")).first()[0]
    assert loaded == RUN1.run_ts


def test_clean_row_in_the_wrong_period_goes_where_its_date_says(spark):
    from tierone.plans import silver
    path = scratch_path(spark, "moved")
    moved = [(1, "20240331", 5, 5, 1, 1, 1, 1, 10.0, 1, "t", "s", 2024, 1),
             (2, "20240930", 5, 5, 1, 1, 1, 1, 10.0, 1, "t", "s", 2024, 2),
             (3, "2024xx30", 5, 5, 1, 1, 1, 1, 10.0, 1, "t", "s", 2024, 2)]
    tagged = silver.tag_financials(spark.createDataFrame(moved, S.BRONZE_FINANCIALS))
    assert silver.write_silver_financials(tagged, path, RUN1) == 2
    back = read_dataset(spark, path, S.SILVER_FINANCIALS)
    assert sorted((r.cert, r.year, r.quarter) for r in back.collect()) == [(1, 2024, 1), (2, 2024, 3)]


def test_frames_of_a_user_are_landed(spark, sf):
    import pytest

    from tierone.plans import bronze
    from tierone.sources import fixtures
    from tierone.sources.frames import FrameSource

    inst = fixtures.institutions(spark, sf, RUN1).withColumn("extra", F.lit("x"))
    fin = (fixtures.financials(spark, sf, RUN1).filter("year = 2024")
           .drop("_ingested_at", "_source").withColumn("quarter", F.col("quarter").cast("string")))
    base = scratch_path(spark, "frames")
    source = FrameSource(inst, fin.filter("quarter < 4"), "bank")
    got = pipeline.run_pipeline(spark, source, RUN1, base, database="tierone_test_frames")
    assert got.pending_units == 4
    landed_inst, landed = bronze.read_bronze(spark, bronze.BronzePaths(base))
    assert landed_inst.count() == inst.count()
    assert {(r._ingested_at, r._source) for r in landed.select("_ingested_at", "_source").distinct().collect()} == {
        (RUN1.ingested_at, "bank")}
    more = FrameSource(inst, fin, "bank")
    got = pipeline.run_pipeline(spark, more, RUN2, base, database="tierone_test_frames")
    assert got.pending_units == fin.filter("quarter = 4").select("quarter").distinct().count()
    same = bronze.read_bronze(spark, bronze.BronzePaths(base))[1].select("cert", "repdte", "asset", "year", "quarter")
    want = fin.select("cert", "repdte", "asset", "year", F.col("quarter").cast("int").alias("quarter"))
    assert same.exceptAll(want).count() == want.exceptAll(same).count() == 0
    with pytest.raises(Exception, match="without a year or quarter"):
        FrameSource(inst, fin.withColumn("year", F.lit(None).cast("int")), "bank").periods().collect()


def test_run_id_round_trip():
    assert RunContext.from_id(RUN1.run_id) == RUN1
