"""Session set-up, the shared work folder, materialisation and sized broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table, in bytes as written, that is shipped to every executor as a broadcast side.
DEFAULT_BROADCAST_MAX_BYTES = 32 * 1024 * 1024


def local_session(
    master: str = "local[*]", shuffle_partitions: int = 8, app: str = "glazework", extra_conf: dict | None = None,
    work_folder: str | None = None,
) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on).

    ``work_folder``: where intermediate tables go (see :func:`work_dir`).
    """
    builder = SparkSession.builder
    conf = ({"spark.checkpoint.dir": work_folder} if work_folder else {}) | (extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = (
        builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Small local inputs: let AQE coalesce to about one partition per core
        # rather than to its 1 MB floor (the cleaning stages are CPU-bound).
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Bytes of byte code beyond which the JVM only interprets a method.
COMPILED_METHOD_BYTES = 8000

#: Partitions per core that a shuffle keeps, where they are not smaller than AQE's floor.
PARTITIONS_PER_CORE = 4


def tune_for_wide_rows(spark: SparkSession) -> None:
    """Session settings for stages that spend their time on expressions, where the session doesn't set them itself.

    * The cleaning projection, fused into one method, is too long for the JVM to compile, and Spark's own bound
      (64 kB) lets it be interpreted row by row. Such stages run as operators with small methods instead.
    * AQE merges partitions by bytes down to about one per core, so that one left over makes a second round of
      whole tasks. Several per core even that out.
    """
    wanted = {"spark.sql.codegen.hugeMethodLimit": COMPILED_METHOD_BYTES}
    if hasattr(spark, "_jsc"):  # Spark Connect: no context on the client
        cores = spark.sparkContext.defaultParallelism
        wanted["spark.sql.adaptive.coalescePartitions.minPartitionNum"] = PARTITIONS_PER_CORE * cores
    for setting, value in wanted.items():
        if spark.conf.get(setting, None) is None:
            spark.conf.set(setting, str(value))


def work_dir(spark: SparkSession) -> str:
    """The shared folder for materialised tables: the cluster's checkpoint dir.

    Read from the session (the context's checkpoint dir, else the
    ``spark.checkpoint.dir`` setting). Only a local-mode session without one
    gets a fresh temporary folder; on a cluster a machine-local folder would
    not be visible to executors, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context on the client
        sc = None
    if sc is not None:
        found = sc.getCheckpointDir() or found
    if not found:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        found = tempfile.mkdtemp(prefix="glazework-")
        if sc is not None:
            sc.setCheckpointDir(found)
        else:
            spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(
    df: DataFrame, name: str, partition_by: list[str] | None = None, path: str | None = None
) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    This cuts the lineage (a lost executor re-reads files instead of replaying
    the whole build), lets later jobs prune columns, and makes row counts a
    metadata read. Without ``path`` each call gets its own folder under the
    shared work folder, which the session deletes when it ends; with ``path`` (a
    publish location) the table is written there, once, and read back from there.
    """
    spark = df.sparkSession
    target = path or f"{work_dir(spark)}/glazework/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    if path is None:
        _delete_at_exit(spark, target)
    return spark.read.parquet(target)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    """The session's file system removes ``path`` when it is closed (classic sessions only)."""
    if hasattr(spark, "_jvm"):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def planned_bytes(df: DataFrame) -> int:
    """The planner's size of ``df``: file bytes of a written table, scaled to the columns read."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only when ``df`` is at most ``max_bytes``; beyond that,
    leave the join to the planner (a shuffle, with AQE skew splitting).

    The size is known for written tables, files and inline tables; anything the planner can't
    size counts as large.
    """
    return F.broadcast(df) if hasattr(df, "_jdf") and planned_bytes(df) <= max_bytes else df
