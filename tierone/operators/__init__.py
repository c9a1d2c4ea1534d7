"""DataFrame -> DataFrame building blocks."""

from tierone.operators.history import scd2_versions, with_previous_quarter
from tierone.operators.joins import fits_broadcast, lookup_join, maybe_broadcast, measure
from tierone.operators.quality import (
    REASON,
    Rule,
    clean_rows,
    financials_rules,
    institution_rules,
    quarantined_rows,
    split,
    tag,
)
from tierone.operators.scorecard import counts_from_observed, counts_from_tagged, pipeline_row

__all__ = [
    "REASON",
    "Rule",
    "clean_rows",
    "counts_from_observed",
    "counts_from_tagged",
    "financials_rules",
    "fits_broadcast",
    "institution_rules",
    "lookup_join",
    "maybe_broadcast",
    "measure",
    "pipeline_row",
    "quarantined_rows",
    "scd2_versions",
    "split",
    "tag",
    "with_previous_quarter",
]
