"""As-of join: every fact with the version of its key that was valid at its date.

No range condition is joined on. The distinct (key, date) pairs of the facts,
combined in each task before they are shuffled, are put in one list with the
versions of the key, sorted by date, and the last version before each pair is
carried forward by a window. A key's list holds at most one row for each date
of the calendar and one for each version, however many facts the key has, so a
hot key makes no hot task. Facts then meet their pair's version by a plain
equi-join, which adaptive execution splits where a key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierone.operators.joins import DEFAULT_BROADCAST_ROWS, lookup_join


def valid_versions(dates: DataFrame, versions: DataFrame, key: str, date: str,
                   columns: Sequence[str], start: str = "effective_date",
                   end: str = "expiry_date") -> DataFrame:
    """Each distinct (key, date) of ``dates`` that lies in a version, with the version's ``columns``.

    Versions are half-open, [start, end), and of one key do not overlap.
    """
    asked = (dates.select(key, F.col(date).alias("_at")).dropna().distinct()
             .select(key, "_at", F.lit(1).alias("_asks")))
    version = F.struct(F.col(end).alias("_end"), *columns)
    known = versions.filter(F.col(start).isNotNull()).select(
        key, F.col(start).alias("_at"), F.lit(0).alias("_asks"), version.alias("_version"))
    # A version that starts on the date counts: it sorts before the pair.
    order = Window.partitionBy(key).orderBy("_at", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    return (known.unionByName(asked, allowMissingColumns=True)
            .withColumn("_version", F.last("_version", ignorenulls=True).over(order))
            .filter((F.col("_asks") == 1) & (F.col("_at") < F.col("_version._end")))
            .select(key, F.col("_at").alias(date), *[F.col(f"_version.{c}").alias(c) for c in columns]))


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, date: str, columns: Sequence[str],
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``facts`` with the ``columns`` of the version valid at ``date``; NULL where there is none."""
    found = valid_versions(facts, versions, key, date, columns)
    return lookup_join(facts, found, [key, date], "left", max_broadcast_rows)
