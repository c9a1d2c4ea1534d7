"""Merging a new snapshot into a dimension that keeps versions.

Only keys that changed are touched: those whose version valid at the snapshot
date has other attributes (NULL equals NULL), or that have none. For such a
key its versions and the snapshot are one list of dated states; states equal
to the one before fall away and every version ends where the next one starts.
This covers a new key, a change (the open version is closed and another
opened), a correction under the date of an existing version, and a snapshot
that comes late, between two versions. Keys absent from the snapshot stay.

Both sides meet on the key alone; a key holds at most one version for each
snapshot date of the calendar, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierone.config import OPEN_EXPIRY, RunContext
from tierone.operators.history import DIM_ATTRIBUTES


def changed_states(versions: DataFrame, snapshot: DataFrame, key: str = "cert", date: str = "repdte",
                   attributes: Sequence[str] = tuple(DIM_ATTRIBUTES)) -> DataFrame:
    """``key, effective_date, _state`` of snapshot rows that the versions do not yet tell.

    A key with several rows on one date has the greatest, as in a full history.
    """
    state = F.struct(*attributes)
    seen = (snapshot.filter(F.col(key).isNotNull() & F.col(date).isNotNull())
            .groupBy(key, F.col(date).alias("_date")).agg(F.max(state).alias("_state")))
    known = versions.select(F.col(key).alias("_key"), "effective_date", "expiry_date", state.alias("_known"))
    valid = ((F.col(key) == F.col("_key")) & (F.col("_date") >= F.col("effective_date"))
             & (F.col("_date") < F.col("expiry_date")))
    return (seen.join(known, valid, "left")
            .filter(F.col("_known").isNull() | ~F.col("_known").eqNullSafe(F.col("_state")))
            .select(key, F.col("_date").alias("effective_date"), "_state"))


def merged_versions(versions: DataFrame, changes: DataFrame, run: RunContext, key: str = "cert",
                    attributes: Sequence[str] = tuple(DIM_ATTRIBUTES)) -> DataFrame:
    """All versions of the keys in ``changes``; a version keeps the time it was first built."""
    touched = changes.select(key).distinct()
    before = versions.join(touched, key, "left_semi").select(
        key, "effective_date", F.struct(*attributes).alias("_state"), "row_created_at", F.lit(0).alias("_new"))
    after = changes.select(
        key, "effective_date", "_state",
        F.lit(run.run_ts_sql).cast("timestamp_ntz").alias("row_created_at"), F.lit(1).alias("_new"))
    # The snapshot replaces what was known under its own date.
    states = (before.unionByName(after).groupBy(key, "effective_date")
              .agg(F.max_by(F.struct("_state", "row_created_at"), "_new").alias("_row"))
              .select(key, "effective_date", "_row.*"))
    by_time = Window.partitionBy(key).orderBy("effective_date")
    starts = (states.withColumn("_before", F.lag("_state").over(by_time))
              .filter(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col("_state"))))
    return (starts.withColumn("_next", F.lead("effective_date").over(by_time))
            .select(key, "_state.*", "effective_date",
                    F.coalesce("_next", F.lit(OPEN_EXPIRY)).alias("expiry_date"),
                    F.col("_next").isNull().alias("is_current"), "row_created_at"))


def untouched_versions(versions: DataFrame, changes: DataFrame, key: str = "cert") -> DataFrame:
    return versions.join(changes.select(key).distinct(), key, "left_anti")
