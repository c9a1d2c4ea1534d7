"""Version history (slowly changing dimension, type 2) and period-over-period
comparison.

Version history
    Snapshots of a dimension (one row per key per snapshot date) collapse to
    versions: a snapshot starts a new version when its attributes differ
    (NULL-safe) from the key's previous snapshot. ``expiry_date`` is the next
    version's ``effective_date`` (half-open intervals) or the open expiry.

    A key has one state per snapshot date: of several variants the greatest
    counts, comparing the attributes in order with NULL least, so no version
    has an empty interval. The window is partitioned by key and holds one row
    per snapshot date — a calendar bound that does not grow with the number of
    keys or with the data volume. The plan has two shuffles: the choice of the
    variant, pre-aggregated, which keeps a key with many repeated rows out of
    one task, and one that both windows share.

Period-over-period
    Each (year, quarter) row of an already-aggregated table plays two roles:
    its own quarter, and the previous one of the quarter after. Grouping both
    by quarter pairs them in one pass, with neither a self-join (which would
    aggregate the input twice) nor an unpartitioned window (which would move
    every row into one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierone.config import OPEN_EXPIRY, RunContext

DIM_ATTRIBUTES = ["name", "city", "stalp", "instcat", "charterclass", "active"]


def scd2_versions(snapshots: DataFrame, run: RunContext, key: str = "cert",
                  snapshot_col: str = "repdte",
                  attributes: list[str] | None = None) -> DataFrame:
    attrs = attributes or DIM_ATTRIBUTES
    snaps = (snapshots.groupBy(key, snapshot_col)
             .agg(F.max(F.struct(*attrs)).alias("_state"))
             .select(key, snapshot_col, "_state.*"))

    by_time = Window.partitionBy(key).orderBy(snapshot_col)
    state = F.struct(*[F.col(a) for a in attrs])
    prev_state = F.lag(state).over(by_time)
    versions = (snaps
                .withColumn("_prev_state", prev_state)
                .filter(F.col("_prev_state").isNull()
                        | ~F.col("_prev_state").eqNullSafe(state))
                .drop("_prev_state"))

    next_start = F.lead(F.col(snapshot_col)).over(by_time)
    return (versions
            .withColumn("_next", next_start)
            .select(
                key, *attrs,
                F.col(snapshot_col).alias("effective_date"),
                F.coalesce(F.col("_next"), F.lit(OPEN_EXPIRY)).alias("expiry_date"),
                F.col("_next").isNull().alias("is_current"),
                F.lit(run.run_ts_sql).cast("timestamp_ntz").alias("row_created_at"),
            ))


def next_quarter(year, quarter):
    """(year, quarter) of the calendar quarter after."""
    last = quarter == F.lit(4)
    next_year = F.when(last, year + F.lit(1)).otherwise(year)
    return next_year.cast("int"), F.when(last, F.lit(1)).otherwise(quarter + F.lit(1)).cast("int")


def with_previous_quarter(df: DataFrame, value_cols: list[str],
                          prefix: str = "prev_") -> DataFrame:
    """Attach the previous calendar quarter's ``value_cols`` (NULL if absent).

    ``df`` must hold one row per (year, quarter). A row without a year or
    quarter is kept and has no previous quarter.
    """
    others = [c for c in df.columns if c not in ("year", "quarter")]
    own = F.struct(*others)
    values = F.struct(*[F.col(c).alias(prefix + c) for c in value_cols])
    never = F.lit(False)
    after_year, after_quarter = next_quarter(F.col("year"), F.col("quarter"))
    roles = F.array(
        F.struct("year", "quarter", own.alias("own"), F.when(never, values).alias("before")),
        F.struct(after_year.alias("year"), after_quarter.alias("quarter"),
                 F.when(never, own).alias("own"), values.alias("before")))
    dated = F.col("year").isNotNull() & F.col("quarter").isNotNull()
    return (df.select(F.explode(roles).alias("role")).select("role.*")
            .filter(F.col("own").isNotNull() | dated)
            .groupBy("year", "quarter")
            .agg(F.max("own").alias("own"), F.max("before").alias("before"))
            .filter(F.col("own").isNotNull())
            .select("year", "quarter", "own.*", "before.*"))
