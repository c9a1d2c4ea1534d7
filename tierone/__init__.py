"""tierone — quarterly bank-health analytics as Spark DataFrame jobs.

Layers:

* ``sources``   — fixture mapping into the bronze datasets, Parquet scans and
                  writes, catalog registration, the run ledger.
* ``functions`` — column expressions: pinned rounding, period derivation,
                  ratios, capital class.
* ``operators`` — DataFrame -> DataFrame building blocks: rule tagging and
                  splitting, size-checked lookup joins, scorecard counts,
                  version history.
* ``plans``     — the bronze / silver / gold stages and the reports.
* ``streaming`` — incremental silver validation with Structured Streaming.
"""

from tierone.config import RunContext

__all__ = ["RunContext"]
