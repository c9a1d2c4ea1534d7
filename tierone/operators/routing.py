"""Rows filed under another period than their report date names.

Bronze keeps a row where it was landed; silver keeps it where its ``repdte``
says. A clean row without a period in its ``repdte`` is rejected with a reason
of its own, so no row can stop a run.

A period of silver is therefore made of rows from several filed periods. Which
filed period sends rows to which other one is a *route*. When periods are
landed again, the periods of silver to rewrite are those and every period they
send rows to, now or earlier; each of these is rewritten whole, from its own
filed period and every other one that sends rows there. Routes are kept for
good (one that no longer holds costs a needless rewrite, never a row), and
there are at most as many as pairs of quarters in the calendar.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierone.functions.period import derive_quarter, derive_year
from tierone.operators.quality import REASON

#: Reason of a row that passes every rule but whose report date names no quarter.
NO_PERIOD = "repdte_without_period"

Period = tuple[int, int]
Route = tuple[Period, Period]


def with_target(tagged: DataFrame) -> DataFrame:
    """Adds ``to_year`` and ``to_quarter``; clean rows that have none get the reason ``NO_PERIOD``."""
    year, quarter = derive_year(F.col("repdte")), derive_quarter(F.col("repdte"))
    named = F.coalesce(year.isNotNull() & quarter.between(1, 4), F.lit(False))
    clean = F.col(REASON) == F.lit("")
    return tagged.withColumns({
        REASON: F.when(clean & ~named, F.lit(NO_PERIOD)).otherwise(F.col(REASON)),
        "to_year": F.when(named, year),
        "to_quarter": F.when(named, quarter),
    })


def to_target(clean: DataFrame) -> DataFrame:
    """Rows of :func:`with_target` under the period they belong to."""
    return (clean.withColumns({"year": F.col("to_year"), "quarter": F.col("to_quarter")})
            .drop("to_year", "to_quarter"))


def closure(landed: Iterable[Period], routes: Iterable[Route]) -> tuple[set[Period], set[Period]]:
    """(periods to rewrite, filed periods to read) when ``landed`` were landed."""
    landed, routes = set(landed), set(routes)
    targets = landed | {to for filed, to in routes if filed in landed}
    sources = targets | {filed for filed, to in routes if to in targets}
    return targets, sources
