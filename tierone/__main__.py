"""Command line: run the pipeline, or one stage, or a report.

    python -m tierone pipeline SF_DIR [--base DIR] [--db NAME]
    python -m tierone bronze   SF_DIR --base DIR
    python -m tierone silver   --base DIR
    python -m tierone gold     --base DIR [--db NAME]
    python -m tierone report   NAME --base DIR [--db NAME]

Stages run one by one share an audit run with ``--run-id YYYYMMDD_HHMMSS``.
``--shuffle-gb`` and ``--cores`` size shuffles and scans for a large run.

Stages raise on failure, so a failed stage stops the sequence. ``--base``
defaults to a fresh folder under ``spark.checkpoint.dir``. ``pipeline``
prints the gold reports at the end. Tables lie at explicit locations under
``--base`` and are registered again by each process that needs them, so a
stand-alone ``report`` takes ``--base`` too.
"""

from __future__ import annotations

import argparse

from tierone.config import RunContext
from tierone.plans import bronze
from tierone.plans.pipeline import gold_stage, register_tables, run_pipeline, silver_stage, staged_rows
from tierone.plans.sql_reports import REPORTS, run_report
from tierone.session import MIB, build_session, scale_settings, scratch_path


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tierone")
    ap.add_argument("command", choices=["pipeline", "bronze", "silver", "gold", "report"])
    ap.add_argument("arg", nargs="?", help="SF_DIR for pipeline/bronze, report name for report")
    ap.add_argument("--base", help="root folder of the bronze / silver layers")
    ap.add_argument("--db", default="tierone_gold", help="gold database")
    ap.add_argument("--run-id", help="YYYYMMDD_HHMMSS; the present time if not given")
    ap.add_argument("--shuffle-gb", type=int, help="expected shuffle volume of the run")
    ap.add_argument("--cores", type=int, default=8, help="cores of the cluster, for --shuffle-gb")
    args = ap.parse_args(argv)

    sizing = scale_settings(args.shuffle_gb * 1024 * MIB, args.cores) if args.shuffle_gb else None
    spark = build_session(extra=sizing)
    run = RunContext.from_id(args.run_id) if args.run_id else RunContext.now()
    base = args.base or scratch_path(spark, "run")
    try:
        if args.command == "pipeline":
            print(run_pipeline(spark, args.arg, run, base, database=args.db))
            for name in REPORTS:
                print(f"-- {name}")
                run_report(spark, args.db, name).show(truncate=False)
        elif args.command == "bronze":
            landed = bronze.ingest(spark, args.arg, bronze.BronzePaths(base), run)
            print(f"landed {len(landed)} unit(s) under {base}")
        elif args.command == "silver":
            silver_stage(spark, base, run, full_refresh=True)
            staged_rows(spark, base).filter(f"run_id = '{run.run_id}'").show(truncate=False)
        elif args.command == "gold":
            gold_stage(spark, base, run, args.db, full_refresh=True)
            print(f"gold tables in database {args.db}")
        else:
            if args.arg not in REPORTS:
                raise SystemExit(f"unknown report {args.arg!r}; one of {sorted(REPORTS)}")
            if args.base:
                register_tables(spark, base, args.db)
            run_report(spark, args.db, args.arg).show(truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
