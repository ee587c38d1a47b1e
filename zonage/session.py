"""Session construction, checkpoint location and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Dimension-sized sides (zone references, grid indexes, 1-row statistics) are
# broadcast only after this many rows have been counted; beyond it the join
# stays a shuffle join planned by Catalyst/AQE.
BROADCAST_MAX_ROWS = 2_000_000


def get_spark(master: str | None = None, app: str = "zonage",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, skew-join handling and no UI."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # cp1252 sources (SRC7) are rejected by Spark 4 without this flag.
        "spark.sql.legacy.javaCharsets": "true",
    }
    if not _jvm_running():
        conf.setdefault("spark.driver.memory", os.environ.get("ZONAGE_DRIVER_MEMORY", "12g"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _jvm_running() -> bool:
    return SparkSession.getActiveSession() is not None


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a *dimension-sized* frame (one row per zone, zone ×
    year or district) by writing it as Parquet under the session's shared
    checkpoint folder and reading it back.

    Scoring chains reference their input several times (histogram + join
    back, statistics + projection); materialising the zone table once keeps
    each of those references a scan of a tiny file instead of a re-plan and
    re-execution of the fact joins.  Unlike an eager ``checkpoint()`` the
    input is computed once, and the written files survive executor loss.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"zonage-tables/{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir``.  Only a local session without
    one (tests) gets a fresh scratch folder; on a cluster a folder of the
    driver's own disk would lose the executors' files, so that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not fallback and not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not configured:
        configured = fallback or tempfile.mkdtemp(prefix="zonage-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


# Bound on the total number of nested items (e.g. polygon edges held in
# array columns) of a broadcast side: ~32 bytes per edge -> ~128 MB.
BROADCAST_MAX_ITEMS = 4_000_000


def broadcast_fits(rows: int, items: int, max_rows: int = BROADCAST_MAX_ROWS,
                   max_items: int = BROADCAST_MAX_ITEMS) -> bool:
    """Whether a side of ``rows`` rows and ``items`` nested elements may be broadcast."""
    return rows <= max_rows and items <= max_items


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      items: Column | None = None,
                      max_items: int = BROADCAST_MAX_ITEMS) -> DataFrame:
    """Broadcast ``df`` only if it provably holds at most ``max_rows`` rows
    (and, when ``items`` — a per-row count of nested elements such as
    ``size(edges)`` — is given, at most ``max_items`` elements in total).

    Without ``items`` the check is a ``limit(max_rows + 1).count()``: it stops
    reading as soon as the bound is exceeded, so it is cheap on large inputs.
    Above a bound the frame is returned unchanged and the join is planned as
    a shuffle join.
    """
    if items is None:
        n = df.limit(max_rows + 1).count()
        return F.broadcast(df) if n <= max_rows else df
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(items), F.lit(0)).alias("k")).first()
    return F.broadcast(df) if broadcast_fits(row["n"], row["k"], max_rows, max_items) else df


def side_by_side(spark: SparkSession, *builders: Callable[[], Any]) -> list:
    """Frames (or small facts) that don't depend on each other, built at the same time: where
    building materialises dimension-sized tables, their small jobs share the
    cluster instead of waiting for one another."""
    with ThreadPoolExecutor(len(builders)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(b)) for b in builders]]


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet table ``<base>/<name>.parquet`` (driver test data layout)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
