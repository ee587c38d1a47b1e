"""Centroid clustering with zone maps along a space-filling curve.

Vectors of a fixed number of components become integers, ``floor(scale * x)``.
They are ordered along a Hilbert curve over all components (:data:`BITS` bits
each), dealt by ranges of it, and cut into blocks of at most
:data:`BLOCK_ROWS` neighbours, stored with the smallest and largest value of
each component: the block's box.

A round visits each block with all centroids.  Over a box, the difference of
the squared distances to two centroids is linear in the vector, so its
smallest value is a sum over components; where it is above 0, the first
centroid is the nearest of no vector of the block.  What is left are the
block's candidates; a block with one candidate needs no distances at all (its
component sums do), others are compared with the candidates exactly, as one
matrix product.  Only sums and counts per centroid leave a task, partially
aggregated; the driver holds the centroids (``k`` x components numbers).

All results are exact integers: products run in float64 while every partial
sum stays below 2^53, in 64-bit integers beyond.

Edge cases: vectors that are null, of another length, or with a component that
is null, non-finite or beyond ``vectors.LARGEST`` after scaling are left out;
fewer vectors than ``k`` give as many centroids; ties of distance go to the
smaller number; equal start hashes (repeated or null ids, a null id hashes as
the empty text) are ordered by the vectors; equal vectors stay rows of their
own, spread over blocks by their ids; extra columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, stored
from .vectors import integers, matrix

BITS = 4
BLOCK_ROWS = 256
# Below it, sums of 64 squared differences stay exact in float64.
SMALL = 1 << 21


def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each row of ``x`` (integers of
    ``bits`` bits), as bytes that sort like the position.  Gray-code walk from
    the highest bit down: each level inverts or exchanges the lower bits of the
    first axis so that neighbouring cells meet."""
    x = x.T.astype(np.uint32).copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(n):
            on = (x[i] & bit) != 0
            swap = np.where(on, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] & np.uint32(1 << level)) != 0, np.uint32((1 << level) - 1), np.uint32(0))
    x ^= flip
    planes = [(x >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).astype(np.uint8).T, axis=1)


def _ordered(kept: DataFrame, components: int) -> DataFrame:
    """``(_id, _x, _key)``: the place along the curve and, so that equal
    vectors can be dealt apart, a hash of the id."""
    span = kept.agg(F.min(F.array_min("_x")).alias("lo"), F.max(F.array_max("_x")).alias("hi")).first()
    low, width = (0, 1) if span["lo"] is None else (span["lo"], span["hi"] - span["lo"] + 1)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("_x"), components).astype(np.int64)
                keys = hilbert_keys((x - low) * (1 << BITS) // width, BITS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), batch.column("_x"), pa.array([k.tobytes() for k in keys], pa.binary())],
                    ["_id", "_x", "_key"])

    kind = kept.schema["_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"_id {kind}, _x array<int>, _key binary")


def blocks(kept: DataFrame, components: int) -> DataFrame:
    """``(ids, xs, low, high)`` per block: ids, component matrix and box, the
    last three as packed 32-bit integers."""
    spread = F.xxhash64("_id")
    dealt = _ordered(kept, components).withColumn("_salt", spread)
    dealt = dealt.repartitionByRange("_key", "_salt").sortWithinPartitions("_key", "_salt")

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(s, BLOCK_ROWS)
                x = matrix(part.column("_x"), components).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column("_id").to_pylist()], pa.list_(batch.column("_id").type)),
                     *(pa.array([v.tobytes()], pa.binary()) for v in (x, x.min(0), x.max(0)))],
                    ["ids", "xs", "low", "high"])

    kind = kept.schema["_id"].dataType.simpleString()
    return dealt.select("_id", "_x").mapInArrow(run, f"ids array<{kind}>, xs binary, low binary, high binary")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector of the box.
    ``|x - a|^2 - |x - b|^2`` is ``|a|^2 - |b|^2 - 2 x (a - b)``, at its least
    where each component of ``x`` is the end of its range that suits it."""
    low, high, c = (v.astype(np.float64) for v in (low, high, centroids))
    norm = (c ** 2).sum(1)
    gone = np.zeros(len(c), bool)
    best = int(((c - (low + high) / 2) ** 2).sum(1).argmin())
    for b in [best, *(i for i in range(len(c)) if i != best)]:
        if not gone[b]:
            side = 2 * (c - c[b])
            least = norm - norm[b] - np.where(side > 0, side * high, side * low).sum(1)
            gone |= least > 0
    return np.flatnonzero(~gone)


def nearest(x: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of each vector of a block."""
    small = max(np.abs(low).max(initial=0), np.abs(high).max(initial=0), np.abs(centroids).max(initial=0)) < SMALL
    at = candidates(low, high, centroids) if small else np.arange(len(centroids))
    if len(at) == 1:
        return np.full(len(x), at[0])
    c = centroids[at]
    if small:  # without |x|^2, the same for all
        c = c.astype(np.float64)
        return at[((c ** 2).sum(1) - 2 * (x.astype(np.float64) @ c.T)).argmin(1)]
    return at[np.stack([((x.astype(np.int64) - v) ** 2).sum(1) for v in c], 1).argmin(1)]


def _unpacked(batch: pa.RecordBatch, components: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    ids = batch.column("ids")
    for i in range(batch.num_rows):
        xs, low, high = (np.frombuffer(batch.column(name)[i].as_buffer(), np.int32) for name in ("xs", "low", "high"))
        yield ids[i].values, xs.reshape(-1, components), low, high


def sums(zoned: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Rows and component sums of each centroid that is the nearest of any."""
    k, components = centroids.shape

    def run(batches):
        count, total = np.zeros(k, np.int64), np.zeros((k, components), np.int64)
        for batch in batches:
            for _, x, low, high in _unpacked(batch, components):
                of = nearest(x, low, high, centroids)
                for c in np.unique(of):
                    rows = x[of == c]
                    count[c] += len(rows)
                    total[c] += rows.sum(0, dtype=np.int64)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, components), pa.int32()), pa.array(np.tile(np.arange(components), len(at)), pa.int32()),
             pa.array(np.repeat(count[at], components)), pa.array(total[at].ravel())], ["c", "d", "n", "s"])

    found = zoned.mapInArrow(run, "c int, d int, n long, s long").groupBy("c", "d").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in found.orderBy("c", "d").collect():  # k x components numbers
        out.setdefault(r["c"], (r["n"], []))[1].append(int(r["s"]))
    return out


def start(kept: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of ``salt`` and id."""
    name = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [r["_x"] for r in kept.select("_x", name.alias("h")).orderBy("h", "_x").limit(k).collect()]


def cluster(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, rounds: int = 10,
            components: int = 64, scale: int = 1024, salt: str = "3:") -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid)`` per kept
    vector after ``rounds`` rounds and one more assignment; ``centroid`` is the
    final one's components as decimal integers joined by ``,``."""
    bound_batches(rows.sparkSession)
    fine, x = integers(rows, rows[vector_col], scale, components)
    kept = rows.filter(fine).select(rows[id_col].alias("_id"), x.alias("_x"))
    centroids = np.array(start(kept, k, salt), np.int64).reshape(-1, components)
    zoned = stored(blocks(kept, components), "centroid-blocks")
    for _ in range(rounds if len(centroids) else 0):
        for c, (n, total) in sums(zoned, centroids).items():
            centroids[c] = [s // n for s in total]

    def run(batches):
        for batch in batches:
            for ids, v, low, high in _unpacked(batch, components):
                of = nearest(v, low, high, centroids)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(of, pa.int32()), pa.array(((v - centroids[of]) ** 2).sum(1), pa.int64())],
                    ["_id", "cluster", "distance"])

    kind = kept.schema["_id"].dataType.simpleString()
    assigned = zoned.mapInArrow(run, f"_id {kind}, cluster int, distance long")
    spark, names = rows.sparkSession, [",".join(map(str, c.tolist())) for c in centroids]
    each = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect() if names else []
    inertia = sum(r["cluster_inertia"] for r in each)
    finals = spark.createDataFrame([(r["cluster"], r["cluster_inertia"], inertia, names[r["cluster"]]) for r in each],
                                   "cluster int, cluster_inertia long, inertia long, centroid string")
    return assigned.join(F.broadcast(finals), "cluster").select(
        F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
