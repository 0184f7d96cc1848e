"""S-05 / J-05: runs of a warehouse folder: the switch, the views over it, the ledger and the retention.

A run's tables are ``<folder>/<table>/run=<id>``. The switch is one small file in ``published_runs``, numbered in order and
created only if its number is free, so two publishers can't both take it and no clock decides. The catalog views are made
once: each reads its table's folder where ``run`` is the last published one, so all names move at the same moment.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glazework.storage import Store

SWITCH = "published_runs"
LEDGER = "build_ledger"
SWITCH_ROWS = "seq bigint, run string, published_at bigint"
LEDGER_ROWS = "run string, step string, inputs string, detail string"


def new_run() -> str:
    return f"r{uuid.uuid4().hex}"


def table_path(out_dir: str, run: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}/run={run}"


def published_runs(spark: SparkSession, out_dir: str) -> list[tuple[int, str, int]]:
    """(number, run, time in seconds) of every switch, in order: one small row for each publication."""
    if not Store(spark, out_dir).exists(SWITCH):
        return []
    rows = spark.read.schema(SWITCH_ROWS).json(f"{out_dir.rstrip('/')}/{SWITCH}").where("run IS NOT NULL")
    return sorted((r["seq"], r["run"], r["published_at"]) for r in rows.collect())


def current_run(spark: SparkSession, out_dir: str) -> str:
    """The run that ``out_dir`` was last switched to."""
    runs = published_runs(spark, out_dir)
    if not runs:
        raise ValueError(f"nothing is published in {out_dir}")
    return runs[-1][1]


def switch_to(spark: SparkSession, out_dir: str, run: str) -> int:
    """Makes ``run`` the current one for every reader at once; returns its number."""
    store = Store(spark, out_dir)
    while True:
        seq = max([0, *(s for s, _, _ in published_runs(spark, out_dir))]) + 1
        row = {"seq": seq, "run": run, "published_at": int(time.time())}
        taken = max([0, *(int(re.findall(r"\d+", name)[-1]) for name, _ in store.matches(f"{SWITCH}/*.json"))])
        if store.create(f"{SWITCH}/{max(seq, taken + 1):012d}.json", row | {"seq": max(seq, taken + 1)}):
            return max(seq, taken + 1)


def create_views(spark: SparkSession, out_dir: str, schema: str, columns: dict[str, list[str]]) -> None:
    """A view for each table, made once; a later publication moves them all by the switch alone.

    A view is made anew only where its table's columns have changed.
    """
    out = out_dir.rstrip("/")
    last = f"(SELECT max_by(run, seq) FROM json.`{out}/{SWITCH}`)"
    for name, cols in columns.items():
        full = f"`{schema}`.`{name}`"
        if spark.catalog.tableExists(f"{schema}.{name}") and spark.table(full).columns == cols:
            continue
        listed = ", ".join(f"`{c}`" for c in cols)
        spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT {listed} FROM parquet.`{out}/{name}` WHERE run = {last}")


def remove_old_runs(spark: SparkSession, out_dir: str, grace_seconds: int, now: int | None = None) -> list[str]:
    """Removes runs that no reader may still use; returns them.

    A published run goes when it was superseded more than ``grace_seconds`` ago, a run that was never
    published when nothing of it has changed for so long. The grace must be longer than any query and any build.
    The current run always stays. The rows of the switch stay too: they are the history.
    """
    store, now = Store(spark, out_dir), int(time.time()) if now is None else now
    log = published_runs(spark, out_dir)
    last_use = {run: later[2] for (_, run, _), later in zip(log, log[1:])}
    seen: dict[str, int] = {}
    for path, changed in [*store.matches("*/run=*"), *store.matches("*/run=*/*")]:
        run = re.search(r"/run=([^/]+)", path).group(1)
        seen[run] = max(seen.get(run, 0), changed)
    gone = []
    for run, changed in sorted(seen.items()):
        if (log and run == log[-1][1]) or now - last_use.get(run, changed) <= grace_seconds:
            continue
        for path, _ in [*store.matches(f"*/run={run}"), *store.matches(f"{LEDGER}/{run}-*.json")]:
            store.remove(path)
        gone.append(run)
    return gone


def input_fingerprint(raw: DataFrame, seeds: dict[str, DataFrame]) -> str:
    """Names the inputs of a build: the raw table's files (path, length, time), how they are read, and the seeds' rows.

    The files are listed and hashed by Spark; nothing but the hashes comes to the driver besides their names.
    """
    from glazework import __version__

    spark, files = raw.sparkSession, raw.inputFiles()
    if not files:
        raise ValueError("a build can be resumed only where the raw table is read from files")
    kept = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        plan = re.sub(r"#\d+L?|plan_id=\d+", "", raw._jdf.queryExecution().analyzed().toString())
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", kept)
    listed = spark.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
    parts = [listed.select(F.lit("").alias("part"), F.xxhash64("path", "length", "modificationTime").alias("h"))]
    for column, seed in sorted(seeds.items()):
        nulls = F.concat(*[F.col(c).isNull().cast("string") for c in seed.columns])
        parts.append(seed.select(F.lit(column).alias("part"), F.xxhash64(nulls, *seed.columns).alias("h")))
    sums = reduce(DataFrame.unionByName, parts).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")
    )
    hashes = sorted((r["part"], r["n"], r["x"], int(r["s"])) for r in sums.collect())  # a row a seed
    return str(uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([__version__, plan, hashes])))


class Ledger:
    """The finished steps of one run; a step is entered after its table is written."""

    def __init__(self, spark: SparkSession, out_dir: str, run: str, inputs: str, steps: dict[str, dict] | None = None):
        self._store, self.run, self._inputs, self.steps = Store(spark, out_dir), run, inputs, steps or {}

    @classmethod
    def open(cls, spark: SparkSession, out_dir: str, inputs: str) -> Ledger:
        """The ledger of an unpublished run of the same inputs, the one with most steps; else of a new run."""
        found: dict[str, dict[str, dict]] = {}
        if Store(spark, out_dir).exists(LEDGER):
            rows = spark.read.schema(LEDGER_ROWS).json(f"{out_dir.rstrip('/')}/{LEDGER}")
            for r in rows.where(F.col("inputs") == inputs).collect():  # a few rows a run
                found.setdefault(r["run"], {})[r["step"]] = json.loads(r["detail"])
        done = {run for _, run, _ in published_runs(spark, out_dir)}
        open_runs = sorted((-len(steps), run) for run, steps in found.items() if run not in done)
        run = open_runs[0][1] if open_runs else new_run()
        return cls(spark, out_dir, run, inputs, found.get(run))

    def enter(self, step: str, detail: dict | None = None) -> None:
        row = {"run": self.run, "step": step, "inputs": self._inputs, "detail": json.dumps(detail or {})}
        self._store.create(f"{LEDGER}/{self.run}-{step}.json", row)
        self.steps[step] = detail or {}
