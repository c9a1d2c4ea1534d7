"""Fixed values and the per-run context.

Everything a run stamps into its output (run id, timestamps) is an argument
carried by :class:`RunContext`; nothing reads the wall clock inside a plan, so
every table is reproducible and every query can be checked by another engine.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to match the
# published pipeline's semantics (labels, rule names, thresholds, formats).
# ---------------------------------------------------------------------------

# Data-quality rule names, in evaluation order.
RULE_CERT_IS_NULL = "cert_is_null"
RULE_ASSET_NON_POSITIVE = "asset_non_positive"
RULE_NAME_EMPTY = "name_empty"
RULE_ACTIVE_INVALID_VALUE = "active_invalid_value"
RULE_DEP_NON_POSITIVE = "dep_non_positive"
RULE_RBCT1_OUT_OF_RANGE = "rbct1_out_of_range"
RULE_REPDTE_INVALID_FORMAT = "repdte_invalid_format"

# Separator between rule names in ``rejection_reason``.
REASON_SEPARATOR = "; "

# Capital-adequacy classes on the Tier-1 ratio (percent), highest first;
# anything below the last threshold, and NULL, is the fallback class.
CAPITAL_CLASSES = (
    (10.0, "Well Capitalised"),
    (8.0, "Adequately Capitalised"),
    (6.0, "Undercapitalised"),
)
CAPITAL_FALLBACK = "Critically Undercapitalised"

# Quarter -> quarter-end month and day (MMDD) of the report date.
QUARTER_END_MMDD = {1: "0331", 2: "0630", 3: "0930", 4: "1231"}

# Open-ended expiry of a current dimension version.
OPEN_EXPIRY = "99991231"

# Valid values of the ``active`` flag.
ACTIVE_VALUES = (0, 1)

# Inclusive bounds of the Tier-1 ratio.
RBCT1_MIN = 0.0
RBCT1_MAX = 100.0

# Length of a well-formed report date ``YYYYMMDD``.
REPDTE_LENGTH = 8

# Run-ledger key of the institution master unit; financials units are
# ``financials_<year>_Q<quarter>``.
MASTER_RUN_KEY = "institutions_master"
FINANCIALS_RUN_KEY_FORMAT = "financials_%d_Q%d"

# Scorecard labels.
DATASET_INSTITUTIONS = "institutions"
DATASET_FINANCIALS = "financials"
DATASET_PIPELINE = "full_pipeline"
STAGE_SILVER = "silver_transform"
STAGE_GOLD = "gold_load"

# Lineage tag of data landed from the provided TPC-H-like fixture tables.
FIXTURE_SOURCE = "tpch_fixture_v1"

# Run-id format (UTC): YYYYMMDD_HHMMSS.
RUN_ID_PATTERN = "yyyyMMdd_HHmmss"


@dataclass(frozen=True)
class RunContext:
    """Identity of one pipeline run.

    ``run_ts`` is a naive UTC wall-clock time; it is written as
    ``TIMESTAMP_NTZ`` so the stored value never depends on a session time zone.
    """

    run_ts: _dt.datetime = _dt.datetime(2024, 12, 31, 0, 0, 0)

    @property
    def run_id(self) -> str:
        return self.run_ts.strftime("%Y%m%d_%H%M%S")

    @property
    def run_date(self) -> _dt.date:
        return self.run_ts.date()

    @property
    def run_ts_sql(self) -> str:
        """``YYYY-MM-DD HH:MM:SS`` — the literal form used in SQL."""
        return self.run_ts.strftime("%Y-%m-%d %H:%M:%S")

    @property
    def ingested_at(self) -> str:
        """ISO-8601 string stamped into bronze ``_ingested_at``."""
        return self.run_ts.strftime("%Y-%m-%dT%H:%M:%S")

    @classmethod
    def from_id(cls, run_id: str) -> "RunContext":
        return cls(_dt.datetime.strptime(run_id, "%Y%m%d_%H%M%S"))

    @classmethod
    def now(cls) -> "RunContext":
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        return cls(now)


# The context every oracle-checked query runs under.
FIXED_RUN = RunContext()
