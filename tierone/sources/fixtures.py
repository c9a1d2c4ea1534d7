"""Bronze datasets derived from the provided TPC-H-like tables.

The published pipeline lands seeded random data produced on one machine. Here
the two bronze datasets are deterministic projections of the given tables,
computed by Spark at any scale, and reaching every quality rule, every
capital class, NULL pass-through and unmatched joins:

* institutions <- customer joined to nation and region (one row per customer);
* financials   <- orders aggregated per (customer, year, quarter).

Only integer arithmetic and exactly-representable double operations are used,
so other engines compute bit-identical values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierone.config import FIXTURE_SOURCE, RunContext
from tierone.functions.period import quarter_end_repdte
from tierone.operators.fingerprint import fingerprint

# Fixed values of the fixture mapping (defect injection moduli and scales).
CERT_BASE = 10001
YEAR_SHIFT = 24
CHARTER_CLASSES = ("N", "SM", "NM", "SB")
PERIOD_MIX = (7919, 104729, 1299709)   # multipliers of key, year, quarter


# Declared schemas of the columns read from the provided tables. Declaring
# them skips footer inference, reads only these columns, and reads the order
# date (a Parquet timestamp not adjusted to UTC) as TIMESTAMP_NTZ, so the
# year / quarter extracted from it never depend on a session time zone.
SOURCE_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "orders": "o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cycle(k: Column, values: tuple[str, ...]) -> Column:
    expr = None
    for i, v in enumerate(values):
        cond = (k % F.lit(len(values))) == F.lit(i)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


def lineage(df: DataFrame, run: RunContext) -> DataFrame:
    return df.withColumns({
        "_ingested_at": F.lit(run.ingested_at),
        "_source": F.lit(FIXTURE_SOURCE),
    })


def institutions(spark: SparkSession, sf_dir: str, run: RunContext) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # Spark's own size estimate of the two files decides how they are joined.
    rows = (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey))

    k = F.col("c_custkey").cast("bigint")
    cert = F.when(k % 97 == 3, F.lit(None)).otherwise(F.lit(CERT_BASE) + k)
    name = (F.when(k % 89 == 5, F.lit("   "))
            .when(k % 89 == 6, F.lit(None).cast("string"))
            .otherwise(F.col("c_name")))
    active = (F.when(k % 83 == 7, F.lit(9))
              .when(k % 83 == 8, F.lit(None))
              .when(k % 12 == 11, F.lit(0))
              .otherwise(F.lit(1)))
    out = rows.select(
        cert.cast("bigint").alias("cert"),
        name.alias("name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("stname"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("stalp"),
        F.round(F.col("c_acctbal") * F.lit(100.0)).cast("bigint").alias("asset"),
        F.lit("20241231").alias("repdte"),
        active.cast("bigint").alias("active"),
        (F.lit(1) + k % 4).cast("bigint").alias("instcat"),
        _cycle(k, CHARTER_CLASSES).alias("charterclass"),
    )
    return lineage(out, run)


def order_period(ts: Column) -> tuple[Column, Column]:
    """(year, quarter) of the report period of an order date."""
    return ((F.year(ts) + F.lit(YEAR_SHIFT)).cast("int").alias("year"),
            F.quarter(ts).cast("int").alias("quarter"))


def financial_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct report periods present in the data: one date column scanned,
    collapsed map-side to a handful of rows before its shuffle."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderdate")
    return orders.select(*order_period(F.col("o_orderdate"))).distinct()


def period_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report periods present in the data with the fingerprint of their order rows."""
    columns = ["o_custkey", "o_totalprice", "o_orderdate"]
    orders = read_table(spark, sf_dir, "orders").select(*columns, *order_period(F.col("o_orderdate")))
    return fingerprint(orders, columns, ["year", "quarter"])


def _scaled(a: Column, base: int, m: Column, modulus: int, denom: float) -> Column:
    return F.floor(a * (F.lit(base) + m % modulus) / F.lit(denom)).cast("bigint")


def order_date_range(year: int, quarter: int) -> tuple[dt.datetime, dt.datetime]:
    """[start, end) of the order dates that map to report period (year, quarter)."""
    y = year - YEAR_SHIFT
    start = dt.datetime(y, 3 * quarter - 2, 1)
    end = dt.datetime(y + 1, 1, 1) if quarter == 4 else dt.datetime(y, 3 * quarter + 1, 1)
    return start, end


def financials(spark: SparkSession, sf_dir: str, run: RunContext,
               periods: list[tuple[int, int]] | None = None) -> DataFrame:
    """Financials of all periods, or of ``periods`` only.

    With ``periods`` the orders scan gets plain order-date ranges: comparisons
    on the column itself, which Parquet can check against row-group min/max
    statistics, so row groups of other quarters are skipped rather than read.
    """
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    if periods is not None:
        in_range = F.lit(False)
        for year, quarter in periods:
            start, end = order_date_range(year, quarter)
            # Literals from text: string -> TIMESTAMP_NTZ involves no time zone.
            lo = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
            hi = F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz")
            in_range = in_range | ((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi))
        orders = orders.filter(in_range)
    # Partial (map-side) aggregation collapses a hot customer before the shuffle.
    per_period = orders.groupBy(
        F.col("o_custkey").cast("bigint").alias("k"),
        *order_period(F.col("o_orderdate")),
    ).agg(F.sum(F.round(F.col("o_totalprice") * F.lit(100.0)).cast("bigint"))
          .cast("bigint").alias("a"))

    k, a = F.col("k"), F.col("a")
    year, quarter = F.col("year"), F.col("quarter")
    m = (k * PERIOD_MIX[0] + year.cast("bigint") * PERIOD_MIX[1]
         + quarter.cast("bigint") * PERIOD_MIX[2])
    out = per_period.withColumn("m", m).select(
        F.when(F.col("m") % 211 == 0, F.lit(None)).otherwise(F.lit(CERT_BASE) + k)
        .cast("bigint").alias("cert"),
        F.when(F.col("m") % 223 == 0, F.lit("2024Q1"))
        .otherwise(quarter_end_repdte(year, quarter)).alias("repdte"),
        F.when(F.col("m") % 227 == 0, F.lit(0).cast("bigint")).otherwise(a).alias("asset"),
        F.when(F.col("m") % 229 == 0, F.lit(-1).cast("bigint"))
        .otherwise(_scaled(a, 650, F.col("m"), 201, 1000.0)).alias("dep"),
        _scaled(a, 450, F.col("m"), 251, 1000.0).alias("lnlsnet"),
        _scaled(a, 100, F.col("m"), 51, 10000.0).alias("intinc"),
        _scaled(a, 20, F.col("m"), 41, 10000.0).alias("eintexp"),
        _scaled(a, 10, F.col("m"), 31, 10000.0).alias("netinc"),
        F.when(F.col("m") % 233 == 0, F.lit(101.0))
        .when(F.col("m") % 239 == 0, F.lit(None).cast("double"))
        .otherwise((F.lit(400) + F.col("m") % 1401) / F.lit(100.0)).alias("rbct1"),
        _scaled(a, 50, F.col("m"), 251, 10000.0).alias("nperfv"),
        year.alias("year"),
        quarter.alias("quarter"),
    )
    out = lineage(out, run)
    # Partition columns last, as a partitioned scan returns them.
    cols = [c for c in out.columns if c not in ("year", "quarter")] + ["year", "quarter"]
    return out.select(*cols)


# Snapshot dates of the version-history fixture and their ordinal ``x``: in
# snapshot x an institution's charter class reads 'XX' when (cert + x) % 5 = 0.
SNAPSHOTS = ((1, "20231231"), (2, "20240630"), (3, "20241231"))
CHANGED_CHARTER = "XX"


def institutions_at(inst: DataFrame, x: int, repdte: str) -> DataFrame:
    """The master as snapshot ``x`` of ``SNAPSHOTS`` shows it."""
    changed = F.coalesce((F.col("cert") + x) % 5 == 0, F.lit(False))
    return inst.withColumns({
        "charterclass": F.when(changed, F.lit(CHANGED_CHARTER)).otherwise(F.col("charterclass")),
        "repdte": F.lit(repdte)})


def institution_snapshots(inst: DataFrame) -> DataFrame:
    """Clean institutions observed at several report dates (a generator, not a join)."""
    snaps = F.explode(F.array(*[
        F.struct(F.lit(x).alias("x"), F.lit(d).alias("d")) for x, d in SNAPSHOTS]))
    rows = inst.select("cert", "name", "city", "stalp", "instcat", "charterclass", "active",
                       snaps.alias("s"))
    changed = (F.col("cert") + F.col("s.x")) % 5 == 0
    return rows.select(
        "cert", "name", "city", "stalp", "instcat",
        F.when(changed, F.lit(CHANGED_CHARTER)).otherwise(F.col("charterclass"))
        .alias("charterclass"),
        "active",
        F.col("s.d").alias("repdte"),
    )
