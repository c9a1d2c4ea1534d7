"""Bank-health ratios and the capital-adequacy class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierone.config import CAPITAL_CLASSES, CAPITAL_FALLBACK
from tierone.functions.rounding import round_half_up


def pct_of_assets(numerator: Column, asset: Column, scale: int) -> Column:
    """``round(numerator / asset * 100, scale)``; NULL when assets are 0 or NULL."""
    ratio = numerator / F.nullif(asset, F.lit(0)) * F.lit(100.0)
    return round_half_up(ratio, scale)


def capital_class(rbct1: Column) -> Column:
    """Highest class whose threshold the ratio reaches; NULL falls through."""
    expr = None
    for threshold, label in CAPITAL_CLASSES:
        cond = rbct1 >= F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(CAPITAL_FALLBACK))
