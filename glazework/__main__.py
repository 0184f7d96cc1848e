"""Command line: ``python -m glazework run|test``.

  run   build staging, the dimensions and the fact from a raw table, publish
        them as Parquet in a new run under --out, and switch to it
  test  run the 15 data tests and print the summary; exit 1 if any test of severity
        ``error`` fails (``warn`` failures are reported only). With --out and no raw
        table, on the published staging table; else on the staging built from the raw table

The raw table is a CSV (--raw-csv; it is parsed once, rejected records are counted
and kept), a Parquet path (--raw-parquet) or a catalog table (--raw-table). The session comes from
spark-submit / the cluster defaults; --local starts a local one.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession


def _raw(spark: SparkSession, args) -> DataFrame:
    from glazework.sources import land_raw_csv, read_raw_parquet, read_raw_table

    if args.raw_csv:
        good, rejects = land_raw_csv(spark, args.raw_csv, args.landed, args.multi_line)
        n = rejects.count()
        if n:
            print(f"{n} rejected records", file=sys.stderr)
        return good
    if args.raw_parquet:
        return read_raw_parquet(spark, args.raw_parquet)
    if args.raw_table:
        return read_raw_table(spark, args.raw_table)
    raise SystemExit("give --raw-csv, --raw-parquet or --raw-table")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="glazework")
    p.add_argument("command", choices=["run", "test"])
    p.add_argument("--raw-csv")
    p.add_argument("--raw-parquet")
    p.add_argument("--raw-table", help="catalog name of the raw table")
    p.add_argument("--landed", help="where a CSV's rows and rejects are kept as Parquet (default: the work folder)")
    p.add_argument("--multi-line", action="store_true", help="quoted CSV fields may hold line ends")
    p.add_argument("--seed-dir", help="folder with <column>_mapping.csv seeds on shared storage")
    p.add_argument("--out", help="warehouse folder: published to (run), read from (test)")
    p.add_argument("--schema", help="catalog schema whose views are pointed to the new run")
    p.add_argument("--resume", action="store_true", help="take up a build of the same inputs that was broken off (run)")
    p.add_argument("--gate", action="store_true", help="don't switch if a test of severity error fails (run); exit 1")
    p.add_argument("--severity", action="append", default=[], metavar="TEST=warn|error", help="severity of a test")
    p.add_argument("--keep-hours", type=float, help="after publishing, remove runs unused for longer (run)")
    p.add_argument("--local", action="store_true", help="start a local session")
    args = p.parse_args(argv)

    from glazework.operators import quality_summary
    from glazework.plans import build_warehouse, publish, published
    from glazework.plans.build import FailedTests
    from glazework.plans.queries import dq_summary
    from glazework.plans.runs import remove_old_runs
    from glazework.session import local_session
    from glazework.sources.seeds import load_seeds

    spark = local_session() if args.local else SparkSession.builder.getOrCreate()
    seeds = load_seeds(spark, args.seed_dir)
    severities = dict(pair.split("=", 1) for pair in args.severity)
    if args.command == "run":
        if not args.out:
            raise SystemExit("run needs --out")
        wh = build_warehouse(_raw(spark, args), seeds, publish_dir=args.out, resume=args.resume)
        try:
            paths = publish(wh, args.out, schema=args.schema, gate=args.gate, severities=severities)
        except FailedTests as failed:
            print(f"not published: {failed}", file=sys.stderr)
            return 1
        for name, path in paths.items():
            print(f"{name}\t{path}")
        if args.keep_hours is not None:
            for run in remove_old_runs(spark, args.out, int(args.keep_hours * 3600)):
                print(f"removed {run}", file=sys.stderr)
        return 0
    if args.out and not (args.raw_csv or args.raw_parquet or args.raw_table):
        summary = quality_summary(published(spark, args.out, "stg_repairs"), severities=severities)
    else:
        summary = dq_summary(_raw(spark, args), seeds, severities)
    rows = summary.orderBy("test_name").collect()  # 15 rows
    for r in rows:
        print(f"{r['status']:5} {r['failures']:>10} {r['severity']:5} {r['test_name']}")
    return 1 if any(r["status"] == "fail" for r in rows) else 0


if __name__ == "__main__":
    sys.exit(main())
