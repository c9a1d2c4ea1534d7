"""Gold load into catalog tables.

* raw tables: in the pipeline, ``institutions_raw`` / ``financials_raw`` are
  external tables registered over the silver folders (dropped and
  re-registered each run, partitions discovered) — gold reads silver in place
  instead of copying it. The copying loads are available too: replacing
  (idempotent) or appending (each load adds a copy); the financials load is
  one partitioned read of the whole silver tree, with no per-quarter loop and
  no hard-coded calendar;
* serving tables: ``bank_health_metrics`` (partitioned by year, clustered by
  state) and ``dim_institution`` (partitioned by ``is_current``, clustered by
  cert, state). Both are replaced partition by partition without a gap for
  readers (:mod:`tierone.sources.publish`). A full build replaces every year;
  an incremental one reads silver with a partition filter on the years of its
  quarters and replaces those. The dimension keeps versions: a snapshot is
  merged, only changed keys are touched, and one without changes writes
  nothing;
* partial aggregates of the reports, replaced by quarter
  (:mod:`tierone.plans.partials`);
* ``dq_scorecard``: created once, partitioned by ``run_date``; rows are
  appended only if their (run_id, dataset, pipeline_stage) is not yet there,
  so a re-run cannot duplicate the audit trail.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierone import schemas as S
from tierone.config import DATASET_PIPELINE, STAGE_GOLD, RunContext
from tierone.functions.period import in_periods
from tierone.operators.merge import changed_states, merged_versions, untouched_versions
from tierone.operators.scorecard import pipeline_row
from tierone.plans import gold, partials
from tierone.sources.catalog import (
    drop_tables,
    ensure_database,
    ensure_external,
    register_external,
    register_partitioned,
    save_table,
)
from tierone.sources.publish import point, publish, published
from tierone.sources.parquet import cluster, written

SCORECARD_KEY = ["run_id", "dataset", "pipeline_stage"]


def load_raw(inst_silver: DataFrame, fin_silver: DataFrame, db: str, mode: str = "overwrite") -> None:
    save_table(inst_silver, db, "institutions_raw", mode)
    save_table(fin_silver, db, "financials_raw", mode)


def register_raw(spark: SparkSession, db: str, inst_path: str, fin_path: str) -> None:
    drop_tables(spark, db, ["institutions_raw", "financials_raw"])
    register_external(spark, db, "institutions_raw", S.SILVER_INSTITUTIONS, inst_path)
    register_external(spark, db, "financials_raw", S.SILVER_FINANCIALS, fin_path,
                      partition_by=["year", "quarter"])


# Institutions in a row group, at most: the Bloom filters of ``cert`` are sized for them.
CERTS_PER_GROUP = 1_000_000

HEALTH_TABLE = "bank_health_metrics"
DIM_TABLE = "dim_institution"


def table_path(spark: SparkSession, db: str, table: str) -> str:
    """Serving tables lie at explicit places under the database's folder."""
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{table}"


SERVING = {HEALTH_TABLE: (S.BANK_HEALTH_METRICS, "year"), DIM_TABLE: (S.DIM_INSTITUTION, "is_current")}


def register_serving(spark: SparkSession, db: str) -> None:
    """The serving tables at their places, with whatever earlier processes published."""
    for table, (schema, column) in SERVING.items():
        if not spark.catalog.tableExists(f"{db}.{table}"):
            register_partitioned(spark, db, table, schema, table_path(spark, db, table), column,
                                 S.TABLE_COMMENTS[table])
            point(spark, db, table, column, published(spark, db, table)[1])
    ensure_scorecard(spark, db)


def partials_path(spark: SparkSession, db: str) -> str:
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/_partials"


def build_health(spark: SparkSession, db: str, run: RunContext,
                 years: list[int] | None = None) -> None:
    """Build ``bank_health_metrics``: all years, or only ``years``."""
    inst = spark.table(f"{db}.institutions_raw")
    fin = spark.table(f"{db}.financials_raw")
    if years is not None:
        if not years:
            return
        fin = fin.filter(F.col("year").isin(*years))       # partition pruning
    laid_out = cluster(gold.bank_health_metrics(fin, inst, run), ["year"], ["stalp"], ["cert"])
    publish(spark, db, HEALTH_TABLE, laid_out, "year", None if years is None else [str(y) for y in years],
            {"cert": CERTS_PER_GROUP})


def build_dim(spark: SparkSession, db: str, run: RunContext) -> None:
    """Merge the institutions into the versions kept; nothing is written if nothing changed."""
    dim = spark.table(f"{db}.{DIM_TABLE}")
    changes = written(changed_states(dim, spark.table(f"{db}.institutions_raw")), "dim-changes")
    if changes.isEmpty():
        return
    merged = written(merged_versions(dim, changes, run), "dim-merged")
    closed = ~F.col("is_current")
    closes = not (merged.filter(closed).select("cert").isEmpty()
                  and dim.filter(closed).join(changes, "cert", "left_semi").select("cert").isEmpty())
    touched = [True, False] if closes else [True]
    rows = untouched_versions(dim.filter(F.col("is_current").isin(*touched)), changes).unionByName(merged)
    publish(spark, db, DIM_TABLE, cluster(rows, ["is_current"], ["cert", "stalp"]), "is_current",
            [str(t).lower() for t in touched], {"cert": CERTS_PER_GROUP})


def build_partials(spark: SparkSession, db: str, periods: list[tuple[int, int]] | None = None) -> None:
    health = spark.table(f"{db}.{HEALTH_TABLE}")
    if periods is not None:
        if not periods:
            return
        health = health.filter(F.col("year").isin(*{y for y, _ in periods}) & in_periods(periods))
    partials.maintain(spark, health, partials_path(spark, db), periods)


def build_serving(spark: SparkSession, db: str, run: RunContext,
                  years: list[int] | None = None, rebuild_dim: bool = True) -> None:
    """Full build by default; ``years`` limits the fact table to those years."""
    register_serving(spark, db)
    build_health(spark, db, run, years)
    if rebuild_dim:
        build_dim(spark, db, run)


def ensure_scorecard(spark: SparkSession, db: str) -> str:
    ensure_external(spark, db, "dq_scorecard", S.DQ_SCORECARD, table_path(spark, db, "dq_scorecard"),
                    ["run_date"], S.TABLE_COMMENTS["dq_scorecard"])
    return f"{db}.dq_scorecard"


def append_scorecard(spark: SparkSession, db: str, rows: DataFrame) -> None:
    table = ensure_scorecard(spark, db)
    existing = spark.table(table).select(*SCORECARD_KEY)
    fresh = rows.join(existing, SCORECARD_KEY, "left_anti")
    # insertInto is positional: table order is data columns, then run_date.
    fresh.select(*S.DQ_SCORECARD.fieldNames()).write.insertInto(table)


def append_pipeline_row(spark: SparkSession, db: str, run: RunContext) -> None:
    """Total the silver rows that no earlier pipeline row covers, whichever run made them."""
    table = ensure_scorecard(spark, db)
    card = spark.table(table)
    covered = card.filter(F.col("pipeline_stage") == F.lit(STAGE_GOLD)).agg(
        F.max("created_at").alias("covered"))
    per_dataset = (card.filter(F.col("pipeline_stage") != F.lit(STAGE_GOLD)).crossJoin(covered)
                   .filter(F.col("covered").isNull() | (F.col("created_at") > F.col("covered"))))
    # Materialise the totals first: the append must not re-read its own output.
    row = pipeline_row(per_dataset, DATASET_PIPELINE, STAGE_GOLD, run).checkpoint()
    append_scorecard(spark, db, row)


def gold_load(spark: SparkSession, db: str, db_location: str | None, inst_path: str,
              fin_path: str, silver_scorecard: DataFrame, run: RunContext,
              periods: list[tuple[int, int]] | None = None, rebuild_dim: bool = True) -> None:
    """Load everything, or the years of the silver quarters ``periods``."""
    ensure_database(spark, db, db_location)
    register_raw(spark, db, inst_path, fin_path)
    years = None if periods is None else sorted({y for y, _ in periods})
    build_serving(spark, db, run, years, rebuild_dim)
    build_partials(spark, db, periods)
    append_scorecard(spark, db, silver_scorecard)
    append_pipeline_row(spark, db, run)
