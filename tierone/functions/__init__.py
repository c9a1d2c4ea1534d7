"""Column expressions — all native Spark expressions (codegen-friendly)."""

from tierone.functions.metrics import capital_class, pct_of_assets
from tierone.functions.period import derive_quarter, derive_year, in_periods, quarter_end_repdte
from tierone.functions.rounding import round_half_up

__all__ = [
    "capital_class",
    "derive_quarter",
    "derive_year",
    "in_periods",
    "pct_of_assets",
    "quarter_end_repdte",
    "round_half_up",
]
