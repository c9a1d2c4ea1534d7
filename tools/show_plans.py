"""Print the final (post-AQE) physical plan of registered queries.

    python tools/show_plans.py /root/testdata/sf0.1 bank_health_metrics quarter_trend

Each DataFrame is executed itself with ``collect()`` (fine at the test scale
factors), so the adaptive plan shown is the final one; running a different
action, such as a write, would plan a new query. Expression ids are stripped
for readability.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


def main() -> None:
    from tierone.queries import QUERIES
    from tierone.session import build_session
    sf = sys.argv[1]
    spark = build_session("local[8]", shuffle_partitions=8)
    for name in sys.argv[2:]:
        print(f"===== {name}")
        print(final_plan(QUERIES[name](spark, sf)))
    spark.stop()


if __name__ == "__main__":
    main()
