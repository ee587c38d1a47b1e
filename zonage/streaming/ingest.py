"""Incremental ingestion with Structured Streaming.

The source pipeline re-ingests landing files on a weekly schedule and makes
each run idempotent through its load rules.  The Spark equivalent is a file
stream processed with ``trigger(availableNow=True)``: each run picks up only
files not seen before (the checkpoint remembers them), and every micro-batch
is merged into the target table with the same load rules as batch jobs
(upsert / insert-ignore / append).  A micro-batch that is replayed after a failure
changes nothing more: an upsert finds its rows as they are, an insert-ignore finds
its keys, and an appended micro-batch is a partition of its own, named by stream
and number, that a replay writes again in place.

Among rows of one key the answer doesn't depend on how files fall into
micro-batches: with ``upsert`` the last file by name wins, with
``insert_ignore`` the first.  (Files must arrive in the order of their names.)
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators import load as L
from ..session import ensure_checkpoint_dir


def landing_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                   options: dict | None = None) -> DataFrame:
    """Streaming read of a landing folder (all-string schema recommended)."""
    r = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path).withColumn("_file", F.col("_metadata.file_name"))


def merge_batch(target_base: str, keys: Sequence[str], rule: str = "upsert",
                order: Sequence[Column | str] = (),
                transform: Callable[[DataFrame], DataFrame] | None = None, stream: str = "stream"):
    """``foreachBatch`` function applying a load rule to each micro-batch.
    ``stream`` names the stream whose micro-batches are numbered; ``order``
    decides among rows of one key and file."""
    if rule not in ("upsert", "insert_ignore", "append"):
        raise ValueError(rule)

    def fn(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        src = transform(batch) if transform else batch
        if "_file" in src.columns and rule != "append":
            first = F.col("_file").desc() if rule == "upsert" else F.col("_file").asc()
            ranked = src.withColumn("_rank", F.dense_rank().over(Window.partitionBy(*keys).orderBy(first)))
            src = ranked.filter("_rank = 1").drop("_rank")
        src, layout, among = src.drop("_file"), L.Layout(tuple(keys)), list(order) or list(keys)
        if rule == "upsert":
            L.upsert_rows(src, target_base, layout, among)
        elif rule == "insert_ignore":
            src = L.keep_first(src, list(keys), among)
            cur = L.read_current(spark, target_base)
            L.append_rows(src if cur is None else L.new_rows(cur, src, keys), target_base, layout)
        else:
            L.append_batch(src, target_base, f"{hashlib.sha256(stream.encode()).hexdigest()[:16]}-{epoch_id}")
    return fn


def run_available(stream: DataFrame, target_base: str, keys: Sequence[str], rule: str = "upsert",
                  checkpoint: str | None = None,
                  transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Process every file available now, then stop (one scheduled run)."""
    spark = stream.sparkSession
    ckpt = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "streams",
                                      os.path.basename(target_base.rstrip("/")))
    q = (stream.writeStream.foreachBatch(merge_batch(target_base, keys, rule, transform=transform, stream=ckpt))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
