"""Reproducible rounding of doubles.

``ROUND`` on a double is engine-specific (Spark rounds 1.005 to 1.01 through
its shortest decimal form, other engines round the binary value to 1.0), and
averages of doubles carry last-bit noise that depends on summation order.
Rounding through ``DECIMAL(38,12)`` first absorbs that noise and makes the
final half-up step exact decimal arithmetic, so every engine agrees.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PIN_DECIMAL = "decimal(38,12)"


def round_half_up(col: Column | str, scale: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast(PIN_DECIMAL), scale).cast("double")


def round_half_up_sql(expr: str, scale: int) -> str:
    """The same rounding as a SQL fragment (used by the SQL oracle)."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,12)), {scale}) AS DOUBLE)"
