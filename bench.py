"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_REPEAT (runs per query, default 3).

The raw repairs table is derived from the driver tables and stored first, as the
source system's load would do; that is not timed. The warehouse queries run on the
stored table. Each is run to completion with the no-op sink (every row is produced,
nothing is collected); the time is the best of the runs, and ``spread`` gives
the worst. A warm-up query runs first so JVM start is not charged to the first query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.fixture import dirty_repairs  # noqa: E402
from checks.registry import registry  # noqa: E402
from glazework.plans.queries import raw_queries  # noqa: E402
from glazework.session import local_session, materialize  # noqa: E402

HEADLINE = ["stg_repairs", "dim_customer", "fact_repairs", "dq_summary"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app="glazework-bench")
    raw = materialize(dirty_repairs(spark, sf_dir), "raw_repairs")
    on_raw, on_tables = raw_queries(), registry()
    run(on_raw["clean_city"](raw))  # warm-up
    best, worst = {}, {}
    for name in names:
        times = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            # a name without a raw-table form is one of the fixture's variants
            run(on_raw[name](raw) if name in on_raw else on_tables[name](spark, sf_dir))
            times.append(round(time.perf_counter() - t0, 3))
        best[name], worst[name] = min(times), max(times)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "spread": worst,
        "repeat": repeat,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
