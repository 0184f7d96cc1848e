"""Summarise the physical plans of the headline queries (run on a stored raw table).

Usage: ``python -m checks.plans [sf_dir] > PLANS.md``. For each query the
final adaptive plan is read after running it; the summary lists scans (read
schema, pushed filters), joins and their strategy, exchanges, aggregates and
any Python evaluation.
"""

from __future__ import annotations

import os
import re
import sys


def _summary(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        s = re.sub(r"^[\s:+|-]*(\*?\s*\(\d+\)\s*)?", "", line)
        if s.startswith(("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
                         "CartesianProduct")):
            out.append("join      " + re.sub(r"#\d+L?", "", s)[:150])
        elif s.startswith(("Exchange", "ShuffleQueryStage", "BroadcastQueryStage")) and "Exchange" in s:
            out.append("exchange  " + re.sub(r"#\d+L?", "", s)[:150])
        elif s.startswith("HashAggregate"):
            out.append("aggregate " + re.sub(r"#\d+L?", "", s)[:110])
        elif s.startswith("FileScan") or s.startswith("Scan parquet"):
            schema = re.search(r"ReadSchema: (struct<.*>)", s)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", s)
            where = re.search(r"Location: \w+\(\d+ paths\)\[([^\]]*)\]", s)
            name = os.path.basename((where.group(1) if where else "").rstrip("/,. ")).rsplit("-", 1)[0]
            out.append(f"scan      {name}: {schema.group(1) if schema else '?'}"
                       + (f" pushed={pushed.group(1)}" if pushed and pushed.group(1) != "[]" else ""))
        elif "EvalPython" in s or "InPandas" in s:
            out.append("PYTHON    " + s[:120])
    return out


def main(argv: list[str]) -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from glazework.constants import TRIM_WHITESPACE
    from glazework.plans.queries import raw_queries
    from glazework.session import local_session, materialize
    from checks.fixture import dirty_repairs

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = local_session("local[8]", 16)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    raw = materialize(dirty_repairs(spark, sf_dir), "raw_repairs")
    qs = raw_queries()
    print(f"# Physical plans (final adaptive plans, {os.path.basename(sf_dir)}, raw table stored as Parquet)\n")
    print("Generated by `python -m checks.plans`. Column ids stripped. `scan` lines show what each Parquet")
    print("scan reads (ReadSchema) and the filters pushed into it; intermediate tables written by a query")
    print("(region lookup, staging, dimensions) are scanned under their own names.\n")
    for name in ["stg_repairs", "dim_customer", "fact_repairs", "dq_summary", "clean_email"]:
        df = qs[name](raw)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = _summary(plan.replace(TRIM_WHITESPACE, "white space"))  # it holds line ends
        print(f"## {name}\n\n```")
        print("\n".join(lines))
        print("```\n")
        print(f"joins: {sum(l.startswith('join') for l in lines)} "
              f"(broadcast {sum('BroadcastHashJoin' in l for l in lines)}), "
              f"shuffle exchanges: {sum(l.startswith('exchange') and 'Broadcast' not in l for l in lines)}, "
              f"Python nodes: {sum(l.startswith('PYTHON') for l in lines)}\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
