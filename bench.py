"""Benchmark: headline queries and the end-to-end pipeline.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full through the ``noop`` sink (no collection to
the driver); the time is the median of ``BENCH_REPS`` runs after one warm-up.
``pipeline`` is one complete bronze -> silver -> gold run into a fresh folder.
``serving`` (reported apart, not in ``value``) times the gold reports as SQL
over the tables that run produced — the path a report user actually takes;
``incremental`` times a re-run on an existing base with nothing new to land.
Prints one JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

HEADLINE = [
    "bank_health_metrics",
    "capital_distribution",
    "quarter_trend",
    "regional_summary",
    "dq_scorecard",
    "silver_financials",
    "health_partition_pruned",
    "scd2_history",
    "dq_pass_trend",
    "dim_clustered_lookup",
]


def _run(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    from tierone.config import FIXED_RUN
    from tierone.plans.pipeline import run_pipeline
    from tierone.plans.sql_reports import REPORTS, run_report
    from tierone.queries import QUERIES
    from tierone.session import build_session, scratch_path

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = build_session(f"local[{cpus}]", app="tierone-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})

    def execute(name):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in HEADLINE:
        execute(name)                                   # warm-up
        timings[name] = statistics.median(_run(lambda: execute(name)) for _ in range(reps))

    counter = iter(range(1_000_000))
    bases: list[str] = []

    def pipeline():
        i = next(counter)
        bases.append(scratch_path(spark, f"bench-pipeline-{i}"))
        run_pipeline(spark, sf_dir, FIXED_RUN, bases[-1], database=f"tierone_bench_{i}")

    pipeline()
    timings["pipeline"] = statistics.median(_run(pipeline) for _ in range(reps))

    db = "tierone_bench_0"                              # produced by the warm-up run
    serving: dict[str, float] = {}
    for name in REPORTS:
        def report(name=name):
            run_report(spark, db, name).write.format("noop").mode("overwrite").save()
        report()
        serving[name] = statistics.median(_run(report) for _ in range(reps))

    def rerun():
        run_pipeline(spark, sf_dir, FIXED_RUN, bases[0], database="tierone_bench_0")

    incremental = {"pipeline_rerun_nothing_new":
                   statistics.median(_run(rerun) for _ in range(reps))}

    lineitem_sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_seconds_headline_queries_and_pipeline",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "serving": {k: round(v, 3) for k, v in serving.items()},
        "incremental": {k: round(v, 3) for k, v in incremental.items()},
        "sf": float(lineitem_sf) if lineitem_sf.replace(".", "", 1).isdigit() else lineitem_sf,
        "cpus": cpus,
        "reps": reps,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
