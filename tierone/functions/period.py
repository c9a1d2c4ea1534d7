"""Report-period expressions.

The report date is a ``YYYYMMDD`` string. Deriving ``year`` / ``quarter`` uses
``try_cast`` so that a malformed date yields NULL instead of failing the job:
under ANSI mode Catalyst may evaluate a cast before (or beside) the filter
that would have removed the bad row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierone.config import QUARTER_END_MMDD


def quarter_end_repdte(year: Column, quarter: Column) -> Column:
    """``YYYY`` + quarter-end ``MMDD``; NULL for a quarter outside 1-4."""
    mmdd = None
    for q, md in QUARTER_END_MMDD.items():
        mmdd = (F.when(quarter == q, F.lit(md)) if mmdd is None
                else mmdd.when(quarter == q, F.lit(md)))
    return F.concat(year.cast("string"), mmdd)


def derive_year(repdte: Column) -> Column:
    return F.substring(repdte, 1, 4).try_cast("int")


def derive_quarter(repdte: Column) -> Column:
    """ceil(month / 3); months are not range-checked (13 -> 5)."""
    month = F.substring(repdte, 5, 2).try_cast("double")
    return F.ceil(month / F.lit(3.0)).try_cast("int")


def in_periods(periods) -> Column:
    """TRUE for rows whose (year, quarter) is one of ``periods``; on a
    partitioned scan this is a partition filter, and below an aggregation on
    (.., year, quarter) Catalyst pushes it under the grouping."""
    cond = F.lit(False)
    for year, quarter in periods:
        cond = cond | ((F.col("year") == F.lit(year)) & (F.col("quarter") == F.lit(quarter)))
    return cond
