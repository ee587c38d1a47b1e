"""Helpers shared by the operators of this subpackage.

Operators take the names of the id and text columns and project exactly those
under private names (``_id``, ``_text``) before doing anything else, so extra
columns, whatever they are called, neither clash nor travel through a shuffle.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonage.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Texts handed to a Python worker at a time are cut to chunks of about this
# many bytes, whatever Arrow's row count per batch is.
CHUNK_BYTES = 4 << 20

# Bits of the bitmap that tells which rows may be dropped, in words of 64 bits
# (at most 1 << 18 rows of two longs to broadcast).
GONE_BITS = 1 << 24


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the folder of ``spark.checkpoint.dir`` and
    read it back: the lineage is cut, and the files survive lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, f"zonage-llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str) -> DataFrame:
    """:func:`stored`, for results that took large shuffles.  Spark removes the
    shuffle files of finished queries when the driver's garbage is collected,
    which a driver with room may put off until the disks of the executors are
    full; so it is collected now."""
    out = stored(df, name)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


# Arrow batches that Spark hands to a Python worker hold about this many bytes.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as rows: texts differ in length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def release() -> None:
    """Give freed memory back to the system: a Python worker outlives its task
    and would hold what that task needed at most."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_id, _text)`` with null texts as empty strings."""
    bound_batches(docs.sparkSession)
    return docs.select(docs[id_col].alias("_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def without(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """``docs`` without the rows whose id is the value of ``ids``' only column
    (nulls are equal), all columns unchanged; ``ids`` should be stored, as it is read
    twice.  A bitmap of the hashes of ``ids``, of :data:`GONE_BITS` bits whatever
    their number, leaves most rows where they are; those whose bit is set, the
    lost ones and a few more, are joined, so only they are ever shuffled."""
    name, word, bits = (unused(docs, x) for x in ("_gone", "_word", "_bits"))
    gone = ids.toDF(name)
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(GONE_BITS))
    words = gone.select(bit(gone[name]).alias("_b")).groupBy(F.shiftright("_b", 6).alias(word)) \
                .agg(F.expr("bit_or(shiftleft(1L, cast(_b & 63 as int)))").alias(bits))
    own = bit(docs[id_col])
    is_set = (F.shiftright(own, 6) == F.col(word)) & (F.getbit(F.col(bits), own.bitwiseAND(63).cast("int")) == 1)
    sure = docs.join(F.broadcast(words), is_set, "left_anti")
    maybe = docs.join(F.broadcast(words), is_set, "left_semi")
    return sure.union(maybe.join(gone, docs[id_col].eqNullSafe(gone[name]), "left_anti"))


def text_digest(text: Column) -> Column:
    """SHA-256 of ``text`` as bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def row_key(id_col: Column, digest: Column) -> Column:
    """Bytes that tell rows apart by the digest of their text and their id,
    which may be null or that of other texts; never null."""
    named = F.coalesce(F.concat(F.lit("="), id_col.cast("string")), F.lit("-"))
    return F.concat(digest, named.cast("binary"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  Pure-ASCII texts (as many bytes as characters)
    take ``lower``, which agrees there and is cheaper than ``translate``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)) \
            .otherwise(F.translate(text, UPPER, LOWER))


def text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """``(ids, texts as UTF-8 bytes)`` chunks of ``(_id, _text)`` batches, each
    of about :data:`CHUNK_BYTES` (one longer text makes a chunk of its own)."""
    for batch in batches:
        ids, col = batch.column(0), batch.column(1).cast(pa.binary())
        start = size = 0
        for i, n in enumerate(pa.compute.binary_length(col).to_pylist()):
            if size and size + n > CHUNK_BYTES:
                yield ids.slice(start, i - start).to_pylist(), col.slice(start, i - start).to_pylist()
                start, size = i, 0
            size += n
        if start < len(col):
            yield ids.slice(start).to_pylist(), col.slice(start).to_pylist()


def bounded(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows (a partial count per task,
    nothing is collected but one number)."""
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"] <= max_rows


def left_join_spread(left: DataFrame, right: DataFrame, key: str, spread: str, salts: int = 16) -> DataFrame:
    """``left`` left-joined with ``right`` (one row per ``key``), a hot key of
    ``left`` dealt over ``salts`` tasks by the column ``spread``.  ``right`` is
    replicated only for the (key, salt) pairs that occur."""
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    needed = salted.select(key, "_salt").distinct().join(right, key)
    return salted.join(needed, [key, "_salt"], "left").drop("_salt")
