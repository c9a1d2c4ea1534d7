"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the pipeline, each over the whole provided tables.

Pure transformations are returned lazily. Queries about storage behaviour
(round trips, partitioned / clustered layouts, overwrites, catalog tables,
the ledger) perform their writes into a fresh folder under the session's
shared checkpoint folder and return a DataFrame that reads the result back.
All of them run under :data:`tierone.config.FIXED_RUN` so their output can be
compared with :mod:`tierone.oracle`.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierone import config as C
from tierone import schemas as S
from tierone.config import FIXED_RUN, RunContext
from tierone.functions.metrics import capital_class, pct_of_assets
from tierone.operators.history import next_quarter, scd2_versions
from tierone.operators.quality import rule_counts
from tierone.operators.routing import NO_PERIOD, with_target
from tierone.operators.scorecard import counts_from_tagged
from tierone.plans import bronze, gold, partials, reports, silver, warehouse
from tierone.session import scratch_path
from tierone.sources import catalog, fixtures, ledger
from tierone.sources.frames import FrameSource
from tierone.sources.parquet import observed_rows, read_dataset, write_dataset, written
from tierone.sources.publish import publish

RUN = FIXED_RUN
EARLIER_RUN = RunContext(dt.datetime(2024, 6, 30, 0, 0, 0))
RERUN = RunContext(dt.datetime(2025, 1, 15, 0, 0, 0))
LEDGER_CUTOFF_YEAR = 2023

Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------- building blocks

def _bronze(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return fixtures.institutions(spark, sf, RUN), fixtures.financials(spark, sf, RUN)


# Financials-only queries build just that side (no institution plan, no
# broadcast size check they would not use).
def _fin_tagged(spark: SparkSession, sf: str) -> DataFrame:
    return silver.tag_financials(fixtures.financials(spark, sf, RUN))


def _fin_silver(spark: SparkSession, sf: str, periods=None) -> DataFrame:
    fin = fixtures.financials(spark, sf, RUN, periods)
    return silver.silver_financials(silver.tag_financials(fin), RUN)


def _inst_tagged(spark: SparkSession, sf: str) -> DataFrame:
    return silver.tag_institutions(fixtures.institutions(spark, sf, RUN))


def _inst_silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_institutions(_inst_tagged(spark, sf), RUN)


def _tagged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    bi, bf = _bronze(spark, sf)
    return silver.tag_institutions(bi), silver.tag_financials(bf)


def _silver(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    ti, tf = _tagged(spark, sf)
    return silver.silver_institutions(ti, RUN), silver.silver_financials(tf, RUN)


def _health(spark: SparkSession, sf: str, periods=None) -> DataFrame:
    """Health rows of all quarters, or of ``periods``: those reach the orders scan."""
    return gold.bank_health_metrics(_fin_silver(spark, sf, periods), _inst_silver(spark, sf), RUN)


def _facts(spark: SparkSession, sf: str, periods=None) -> DataFrame:
    return gold.health_facts(_fin_silver(spark, sf, periods), RUN)


def _dim(spark: SparkSession, sf: str) -> DataFrame:
    si = _inst_silver(spark, sf)
    return gold.dim_institution(si, RUN)


def _fresh_db(spark: SparkSession, name: str) -> str:
    db = f"tierone_{name}_{uuid.uuid4().hex[:10]}"
    catalog.ensure_database(spark, db, scratch_path(spark, f"db-{name}"))
    return db


# --------------------------------------------------------------------- bronze

def bronze_institutions(spark, sf):
    return fixtures.institutions(spark, sf, RUN)


def bronze_financials(spark, sf):
    return fixtures.financials(spark, sf, RUN)


def bronze_lineage(spark, sf):
    bi, bf = _bronze(spark, sf)
    both = (bi.select(F.lit(C.DATASET_INSTITUTIONS).alias("dataset"), "_source", "_ingested_at")
            .unionByName(bf.select(F.lit(C.DATASET_FINANCIALS).alias("dataset"),
                                   "_source", "_ingested_at")))
    return both.groupBy("dataset", "_source", "_ingested_at").agg(
        F.count(F.lit(1)).alias("row_count"))


def bronze_roundtrip(spark, sf):
    path = scratch_path(spark, "bronze-roundtrip")
    obs = Observation("bronze_roundtrip")
    write_dataset(fixtures.institutions(spark, sf, RUN), path, observe=obs)
    written = observed_rows(obs)
    back = read_dataset(spark, path, S.BRONZE_INSTITUTIONS)
    if written <= 0:
        raise RuntimeError("bronze round trip wrote no rows")
    return back


def bronze_write_counts(spark, sf):
    """Rows written per dataset, as counted by the writes themselves."""
    counts = []
    for dataset, df in zip((C.DATASET_INSTITUTIONS, C.DATASET_FINANCIALS), _bronze(spark, sf),
                           strict=True):
        obs = Observation(f"bronze_{dataset}")
        write_dataset(df, scratch_path(spark, f"bronze-counts-{dataset}"), observe=obs)
        counts.append((dataset, observed_rows(obs)))
    return spark.createDataFrame(counts, "dataset string, row_count bigint")


def bronze_partitioned_scan(spark, sf):
    path = scratch_path(spark, "bronze-partitioned")
    bronze.land_financials(fixtures.financials(spark, sf, RUN), path)
    return (read_dataset(spark, path, S.BRONZE_FINANCIALS)
            .filter((F.col("year") == 2024) & (F.col("quarter") == 4)))


def ingest_work_units(spark, sf):
    return ledger.work_units(spark, fixtures.financial_periods(spark, sf)).select("run_key")


def _ledger_with_earlier_run(spark, sf) -> bronze.BronzePaths:
    """A ledger in which an earlier run completed the master and every quarter
    before the cut-off year."""
    paths = bronze.BronzePaths(scratch_path(spark, "ingest"))
    units = ledger.work_units(spark, fixtures.financial_periods(spark, sf))
    done = units.filter(F.col("year").isNull() | (F.col("year") < LEDGER_CUTOFF_YEAR))
    ledger.record(done, paths.ledger, EARLIER_RUN.ingested_at)
    return paths


def ingest_pending(spark, sf):
    paths = _ledger_with_earlier_run(spark, sf)
    units = ledger.work_units(spark, fixtures.financial_periods(spark, sf))
    return ledger.pending_units(units, ledger.read_ledger(spark, paths.ledger)).select("run_key")


def ingest_ledger_after_run(spark, sf):
    paths = _ledger_with_earlier_run(spark, sf)
    bronze.ingest(spark, sf, paths, RUN)
    bronze.ingest(spark, sf, paths, RERUN)      # nothing left: adds no rows
    return ledger.completed(ledger.read_ledger(spark, paths.ledger))


# --------------------------------------------------------------------- silver

def dq_institutions(spark, sf):
    return _inst_tagged(spark, sf)


def dq_financials(spark, sf):
    return _fin_tagged(spark, sf)


def silver_institutions_q(spark, sf):
    path = scratch_path(spark, "silver-inst")
    write_dataset(_inst_silver(spark, sf), path)
    return read_dataset(spark, path, S.SILVER_INSTITUTIONS)


def silver_financials_q(spark, sf):
    path = scratch_path(spark, "silver-fin")
    write_dataset(_fin_silver(spark, sf), path, partition_by=["year", "quarter"])
    return read_dataset(spark, path, S.SILVER_FINANCIALS)


def quarantine_institutions_q(spark, sf):
    path = scratch_path(spark, "quarantine-inst")
    write_dataset(silver.quarantine_institutions(_inst_tagged(spark, sf), RUN), path,
                  partition_by=["_run_id"])
    return read_dataset(spark, path, S.QUARANTINE_INSTITUTIONS)


def quarantine_financials_q(spark, sf):
    path = scratch_path(spark, "quarantine-fin")
    write_dataset(silver.quarantine_financials(_fin_tagged(spark, sf), RUN), path,
                  partition_by=["_run_id"])
    return read_dataset(spark, path, S.QUARANTINE_FINANCIALS)


def partition_overwrite(spark, sf):
    """Silver financials after re-running one quarter: only that quarter changes."""
    path = scratch_path(spark, "silver-rerun")
    tf = _fin_tagged(spark, sf)
    silver.write_silver_financials(tf, path, RUN)
    one_quarter = tf.filter((F.col("year") == 2024) & (F.col("quarter") == 4))
    silver.write_silver_financials(one_quarter, path, RERUN, [(2024, 4)])
    return read_dataset(spark, path, S.SILVER_FINANCIALS)


def catalog_external_scan(spark, sf):
    paths = silver.SilverPaths(scratch_path(spark, "silver-catalog"))
    si, sfin = _silver(spark, sf)
    write_dataset(si, paths.institutions)
    write_dataset(sfin, paths.financials, partition_by=["year", "quarter"])
    db = _fresh_db(spark, "silver")
    catalog.drop_tables(spark, db, ["institutions", "financials"])
    catalog.register_external(spark, db, "institutions", S.SILVER_INSTITUTIONS,
                              paths.institutions)
    catalog.register_external(spark, db, "financials", S.SILVER_FINANCIALS, paths.financials,
                              partition_by=["year", "quarter"])
    return (spark.table(f"{db}.financials").groupBy("year", "quarter")
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.count_distinct("cert").alias("cert_count")))


def _raw_counts(spark, db):
    return catalog.table_inventory(spark, db)


def table_descriptions(spark, sf):
    """Descriptions of the registered dimension and its columns, with the rows that fill each."""
    path = scratch_path(spark, "descriptions")
    write_dataset(gold.dim_institution(_inst_silver(spark, sf), RUN), path)
    db = _fresh_db(spark, "described")
    catalog.register_external(spark, db, "dim_institution", S.DIM_INSTITUTION, path,
                              comment=S.TABLE_COMMENTS["dim_institution"])
    return catalog.table_dictionary(spark, db, "dim_institution")


def raw_load_replace(spark, sf):
    db = _fresh_db(spark, "raw")
    si, sfin = _silver(spark, sf)
    for _ in range(2):
        warehouse.load_raw(si, sfin, db, "overwrite")
    return _raw_counts(spark, db)


def raw_load_append(spark, sf):
    db = _fresh_db(spark, "raw")
    si, sfin = _silver(spark, sf)
    catalog.drop_tables(spark, db, ["institutions_raw", "financials_raw"])
    for _ in range(2):
        warehouse.load_raw(si, sfin, db, "append")
    return _raw_counts(spark, db)


# ----------------------------------------------------------------------- gold

def derive_period(spark, sf):
    sfin = _fin_silver(spark, sf)
    return gold.with_period(
        sfin.select("cert", "repdte", F.col("year").alias("partition_year"),
                    F.col("quarter").alias("partition_quarter")))


def _ratio(column: str, numerator: str, scale: int) -> Query:
    def q(spark, sf):
        sfin = _fin_silver(spark, sf)
        return sfin.select("cert", "year", "quarter",
                           pct_of_assets(F.col(numerator), F.col("asset"), scale).alias(column))
    q.__name__ = f"ratio_{column}"
    return q


def capital_adequacy(spark, sf):
    sfin = _fin_silver(spark, sf)
    return sfin.select("cert", "year", "quarter", "rbct1",
                       capital_class(F.col("rbct1")).alias("capital_adequacy_flag"))


def bank_health_metrics(spark, sf):
    return _health(spark, sf)


def health_partition_pruned(spark, sf):
    path = scratch_path(spark, "health")
    gold.write_bank_health(_health(spark, sf), path)
    return (read_dataset(spark, path, S.BANK_HEALTH_METRICS)
            .filter((F.col("year") == 2024) & (F.col("quarter") == 4)
                    & (F.col("stalp") == "N3")))


def dim_institution(spark, sf):
    return _dim(spark, sf)


def dim_current_sample(spark, sf):
    return reports.dim_current_sample(_dim(spark, sf))


def dim_clustered_lookup(spark, sf):
    path = scratch_path(spark, "dim")
    gold.write_dim(_dim(spark, sf), path)
    dim = read_dataset(spark, path, S.DIM_INSTITUTION)
    # Quarters from the last one back, until one has a clean row (at most the calendar's).
    periods = sorted(((p.year, p.quarter) for p in
                      fixtures.financial_periods(spark, sf).dropna().collect()), reverse=True)
    columns = ["cert", "capital_adequacy_flag"]
    latest = _facts(spark, sf, []).select(*columns)
    for period in periods:
        latest = _facts(spark, sf, [period]).select(*columns).checkpoint()      # one quarter, read once
        if not latest.isEmpty():
            break
    return reports.clustered_lookup(dim, latest, C.CAPITAL_FALLBACK)


def _scorecard_rows(spark, sf) -> DataFrame:
    ti, tf = _tagged(spark, sf)
    return (counts_from_tagged(ti, C.DATASET_INSTITUTIONS, C.STAGE_SILVER, RUN)
            .unionByName(counts_from_tagged(tf, C.DATASET_FINANCIALS, C.STAGE_SILVER, RUN)))


def _scorecard_table(spark, sf) -> str:
    db = _fresh_db(spark, "gold")
    rows = _scorecard_rows(spark, sf).checkpoint()      # two rows, counted once
    for _ in range(2):                      # a re-run must not duplicate rows
        warehouse.append_scorecard(spark, db, rows)
    warehouse.append_pipeline_row(spark, db, RUN)
    warehouse.append_pipeline_row(spark, db, RUN)
    return f"{db}.dq_scorecard"


def dq_scorecard(spark, sf):
    table = _scorecard_table(spark, sf)
    return spark.table(table).filter(F.col("pipeline_stage") == C.STAGE_SILVER)


def dq_scorecard_pipeline(spark, sf):
    table = _scorecard_table(spark, sf)
    return spark.table(table).filter(F.col("pipeline_stage") == C.STAGE_GOLD)


def dq_scorecard_audit(spark, sf):
    return reports.scorecard_audit(spark.table(_scorecard_table(spark, sf)))


def capital_distribution(spark, sf):
    return reports.capital_distribution(_facts(spark, sf, [(2024, q) for q in (1, 2, 3, 4)]))


def quarter_trend(spark, sf):
    return reports.quarter_trend(_facts(spark, sf))


def quarter_change(spark, sf):
    return reports.quarter_change(_facts(spark, sf))


def regional_summary(spark, sf):
    return reports.regional_summary(_health(spark, sf, [(2024, 4)]))


def table_inventory(spark, sf):
    """Row counts of every gold table after one full pipeline run."""
    from tierone.plans.pipeline import run_pipeline
    db = f"tierone_gold_{uuid.uuid4().hex[:10]}"
    run_pipeline(spark, sf, RUN, scratch_path(spark, "inventory"), database=db)
    return catalog.table_inventory(spark, db)


def table_inventory_sizes(spark, sf):
    """Row count of every gold table after a pipeline run, and whether its files hold data.

    The KB differ by writer, so SQL can tell only that they are above zero;
    the tests compare them with the lengths of the files.
    """
    from tierone.plans.pipeline import run_pipeline
    db = f"tierone_gold_{uuid.uuid4().hex[:10]}"
    run_pipeline(spark, sf, RUN, scratch_path(spark, "inventory-sizes"), database=db)
    return (catalog.table_inventory(spark, db).join(catalog.table_sizes(spark, db), "table_id")
            .select("table_id", "row_count", (F.col("size_kb") > 0).alias("has_size")))


def scd2_history(spark, sf):
    si = _inst_silver(spark, sf)
    return scd2_versions(fixtures.institution_snapshots(si), RUN)


def dq_pass_trend(spark, sf):
    return reports.dq_pass_trend(_fin_tagged(spark, sf))


def stream_silver_financials(spark, sf):
    from tierone.streaming.incremental import incremental_silver_financials
    base = scratch_path(spark, "stream")
    bronze.land_financials(fixtures.financials(spark, sf, RUN), f"{base}/bronze/financials")
    out = incremental_silver_financials(spark, f"{base}/bronze/financials",
                                        f"{base}/silver/financials",
                                        f"{base}/quarantine/financials",
                                        f"{base}/_stream_checkpoint", RUN)
    return read_dataset(spark, out, S.SILVER_FINANCIALS)


# ------------------------------------------- changes over several runs

def _run(day: str) -> RunContext:
    return RunContext(dt.datetime.fromisoformat(day))


def _next_quarter(df: DataFrame, moves) -> DataFrame:
    """Rows where ``moves`` filed one quarter after their own."""
    year, quarter = next_quarter(F.col("year"), F.col("quarter"))
    return df.withColumns({"year": F.when(moves, year).otherwise(F.col("year")),
                           "quarter": F.when(moves, quarter).otherwise(F.col("quarter"))})


def ingest_changed_units(spark, sf):
    """Units landed by a second run whose source has grown in some quarters and lost one."""
    inst, fin = _bronze(spark, sf)
    gone = (fin.filter((F.col("year") == 2024) & (F.col("quarter") == 4))
            .withColumns({"year": F.lit(2030), "quarter": F.lit(1)}))
    late = (F.col("cert") % 50 == 0) & (F.col("year") >= 2023)
    first = fin.filter(~F.coalesce(late, F.lit(False))).unionByName(gone)
    paths = bronze.BronzePaths(scratch_path(spark, "ingest-changed"))
    bronze.ingest(spark, FrameSource(inst, first, "bank", complete=True), paths, EARLIER_RUN)
    landed = bronze.ingest(spark, FrameSource(inst, fin, "bank", complete=True), paths, RUN)
    units = spark.createDataFrame([(u.run_key, u.year, u.quarter, u.landing) for u in landed],
                                  "run_key string, year int, quarter int, landing bigint")
    rows = (read_dataset(spark, paths.financials, S.BRONZE_FINANCIALS).groupBy("year", "quarter")
            .agg(F.count(F.lit(1)).alias("row_count")))
    return (units.join(rows, ["year", "quarter"], "left")
            .select("run_key", "landing", F.coalesce("row_count", F.lit(0)).alias("row_count")))


def _misfiled(spark, sf) -> str:
    """Silver of financials of which some are filed a quarter late and some name no period,
    after a second landing of the last quarter."""
    from tierone.plans.pipeline import silver_stage
    inst, fin = _bronze(spark, sf)
    late = F.coalesce(F.col("cert") % 7 == 0, F.lit(False))
    fin = _next_quarter(fin, late).withColumn(
        "repdte", F.when(F.col("cert") % 43 == 0, F.lit(None)).otherwise(F.col("repdte")))
    base = scratch_path(spark, "misfiled")
    source = FrameSource(inst, fin, "bank")
    for run, force in ((RUN, []), (RERUN, ["financials_2024_Q4"])):
        bronze.ingest(spark, source, bronze.BronzePaths(base), run, force)
        silver_stage(spark, base, run)
    return base


def derive_period_moved(spark, sf):
    paths = silver.SilverPaths(_misfiled(spark, sf))
    return (read_dataset(spark, paths.financials, S.SILVER_FINANCIALS)
            .select("cert", "repdte", "asset", "year", "quarter", "_transformed_at"))


def quarantine_without_period(spark, sf):
    paths = silver.SilverPaths(_misfiled(spark, sf))
    return (read_dataset(spark, paths.quarantine_financials, S.QUARANTINE_FINANCIALS)
            .filter(F.col("rejection_reason") == NO_PERIOD)
            .select("cert", "asset", "year", "quarter", "rejection_reason", "_run_id"))


def quarantine_of_clean_input(spark, sf):
    """Rejects of a run over clean rows only: none, in a readable dataset."""
    bi, bf = _bronze(spark, sf)
    clean = silver.silver_institutions(silver.tag_institutions(bi), RUN).drop("_transformed_at")
    paths = silver.SilverPaths(scratch_path(spark, "all-clean"))
    silver.run_silver(spark, clean, bf.limit(0), paths, RUN)
    return read_dataset(spark, paths.quarantine_institutions, S.QUARANTINE_INSTITUTIONS)


def dim_versions(spark, sf):
    """The dimension after runs over three snapshots, the last of which is landed twice."""
    from tierone.plans.pipeline import run_pipeline
    inst, fin = _bronze(spark, sf)
    fin = fin.filter((F.col("year") == 2024) & (F.col("quarter") == 4))
    inst, fin = (written(x, "dim-source") for x in (inst, fin))     # four runs read these, several times each
    base, db = scratch_path(spark, "dim-versions"), f"tierone_gold_{uuid.uuid4().hex[:10]}"
    for day, (x, repdte) in zip(("2024-01-31", "2024-07-31", "2025-01-31", "2025-02-28"),
                                (*fixtures.SNAPSHOTS, fixtures.SNAPSHOTS[-1]), strict=True):
        source = FrameSource(fixtures.institutions_at(inst, x, repdte), fin, "bank")
        run_pipeline(spark, source, _run(day), base, db, force=[C.MASTER_RUN_KEY])
    return spark.table(f"{db}.dim_institution")


def health_as_of(spark, sf):
    versions = scd2_versions(fixtures.institution_snapshots(_inst_silver(spark, sf)), RUN)
    return gold.health_as_of(_fin_silver(spark, sf), versions, RUN).drop("_loaded_at")


def dq_run_trend(spark, sf):
    """Four runs: some quarters, the rest, a bad correction of 2024, and back with a worse master."""
    from tierone.plans.pipeline import silver_stage
    inst, fin = _bronze(spark, sf)
    worse = fin.withColumn("asset", F.when((F.col("year") == 2024) & (F.col("cert") % 5 == 0), F.lit(0))
                           .otherwise(F.col("asset")).cast("bigint"))
    nameless = inst.withColumn("name", F.when(F.col("cert") % 4 == 0, F.lit(" ")).otherwise(F.col("name")))
    base = scratch_path(spark, "run-trend")
    for day, i, f in (("2024-03-31", inst, fin.filter(F.col("year") < 2023)), ("2024-06-30", inst, fin),
                      ("2024-09-30", inst, worse), ("2024-12-31", nameless, fin)):
        bronze.ingest(spark, FrameSource(i, f, "bank"), bronze.BronzePaths(base), _run(day))
        silver_stage(spark, base, _run(day))
    return reports.dq_run_trend(silver.read_unit_counts(spark, silver.SilverPaths(base).unit_counts))


def dq_rule_counts(spark, sf):
    bi, bf = _bronze(spark, sf)
    inst = rule_counts(silver.institution_masks(bi), silver.institution_rule_names())
    fin = rule_counts(silver.financials_masks(with_target(silver.tag_financials(bf))),
                      silver.financials_rule_names())
    return (inst.withColumn("dataset", F.lit(C.DATASET_INSTITUTIONS))
            .unionByName(fin.withColumn("dataset", F.lit(C.DATASET_FINANCIALS))))


# ------------------------------------------- maintained tables

def health_republished(spark, sf):
    """The health table after one year was replaced by a later run."""
    db = _fresh_db(spark, "republish")
    health = _health(spark, sf)
    warehouse.register_serving(spark, db)
    publish(spark, db, warehouse.HEALTH_TABLE, health, "year")
    again = gold.bank_health_metrics(_fin_silver(spark, sf, [(2024, q) for q in (1, 2, 3, 4)]),
                                     _inst_silver(spark, sf), RERUN)
    publish(spark, db, warehouse.HEALTH_TABLE, again, "year", ["2024"])
    return spark.table(f"{db}.{warehouse.HEALTH_TABLE}")


def health_point_lookup(spark, sf):
    """The history of a few institutions whose numbers lie far apart."""
    db = _fresh_db(spark, "lookup")
    warehouse.register_serving(spark, db)
    publish(spark, db, warehouse.HEALTH_TABLE, _health(spark, sf), "year",
            bloom={"cert": warehouse.CERTS_PER_GROUP})
    banks = _inst_silver(spark, sf).filter(F.col("cert") % 59 == 0)
    return reports.bank_history(spark.table(f"{db}.{warehouse.HEALTH_TABLE}"), banks)


def _partials(spark, sf) -> str:
    """Stored partials after a full build and a second one of the last quarter."""
    path = scratch_path(spark, "partials")
    partials.maintain(spark, _health(spark, sf), path)
    partials.maintain(spark, _health(spark, sf, [(2024, 4)]), path, [(2024, 4)])
    return path


def banks_by_year(spark, sf):
    return partials.banks_by_year(partials.read_bank_sets(spark, _partials(spark, sf)))


def partials_quarter_trend(spark, sf):
    path = _partials(spark, sf)
    return partials.quarter_trend(partials.read_partials(spark, path), partials.read_bank_sets(spark, path))


def partials_capital_distribution(spark, sf):
    return partials.capital_distribution(partials.read_partials(spark, _partials(spark, sf)))


def partials_regional_summary(spark, sf):
    return partials.regional_summary(partials.read_partials(spark, _partials(spark, sf)))


QUERIES: dict[str, Query] = {
    "bronze_institutions": bronze_institutions,
    "bronze_financials": bronze_financials,
    "bronze_lineage": bronze_lineage,
    "bronze_roundtrip": bronze_roundtrip,
    "bronze_write_counts": bronze_write_counts,
    "bronze_partitioned_scan": bronze_partitioned_scan,
    "ingest_work_units": ingest_work_units,
    "ingest_pending": ingest_pending,
    "ingest_ledger_after_run": ingest_ledger_after_run,
    "dq_institutions": dq_institutions,
    "dq_financials": dq_financials,
    "silver_institutions": silver_institutions_q,
    "silver_financials": silver_financials_q,
    "quarantine_institutions": quarantine_institutions_q,
    "quarantine_financials": quarantine_financials_q,
    "partition_overwrite": partition_overwrite,
    "catalog_external_scan": catalog_external_scan,
    "raw_load_replace": raw_load_replace,
    "raw_load_append": raw_load_append,
    "derive_period": derive_period,
    "ratio_npl": _ratio("npl_ratio_pct", "nperfv", 2),
    "ratio_roa": _ratio("roa_pct", "netinc", 4),
    "ratio_deposit": _ratio("deposit_to_asset_pct", "dep", 2),
    "capital_adequacy": capital_adequacy,
    "bank_health_metrics": bank_health_metrics,
    "health_partition_pruned": health_partition_pruned,
    "dim_institution": dim_institution,
    "dim_current_sample": dim_current_sample,
    "dim_clustered_lookup": dim_clustered_lookup,
    "dq_scorecard": dq_scorecard,
    "dq_scorecard_pipeline": dq_scorecard_pipeline,
    "dq_scorecard_audit": dq_scorecard_audit,
    "capital_distribution": capital_distribution,
    "quarter_trend": quarter_trend,
    "quarter_change": quarter_change,
    "regional_summary": regional_summary,
    "table_inventory": table_inventory,
    "table_descriptions": table_descriptions,
    "table_inventory_sizes": table_inventory_sizes,
    "scd2_history": scd2_history,
    "dq_pass_trend": dq_pass_trend,
    "stream_silver_financials": stream_silver_financials,
    "ingest_changed_units": ingest_changed_units,
    "derive_period_moved": derive_period_moved,
    "quarantine_without_period": quarantine_without_period,
    "quarantine_of_clean_input": quarantine_of_clean_input,
    "dim_versions": dim_versions,
    "health_as_of": health_as_of,
    "dq_run_trend": dq_run_trend,
    "dq_rule_counts": dq_rule_counts,
    "health_republished": health_republished,
    "health_point_lookup": health_point_lookup,
    "banks_by_year": banks_by_year,
    "partials_quarter_trend": partials_quarter_trend,
    "partials_capital_distribution": partials_capital_distribution,
    "partials_regional_summary": partials_regional_summary,
}
