"""Hard-negative mining with exact scores from a residue-number-system GEMM.

Vectors become integers, ``floor(scale * x)``.  The score of two is their inner
product, computed exactly in float32: the matrices are reduced modulo several
primes below 1024 (to residues around 0, so that a product over
:data:`STRIP` components stays below 2^24, where float32 is exact), multiplied
once per prime, and the signed scores are put together again by Chinese
remaindering, digit by digit in a mixed radix.  As many primes are taken as
the two blocks' norms need.

All rows are packed once into blocks of bounded bytes; anchors, the stated
query set, into chunks of about :data:`CHUNK` rows.  Each block meets each
chunk once in each of two passes, by an equi-join on the chunk's number in
which the chunks are broadcast if their bytes are counted to be few, else dealt
over ``_side`` copies.  The first pass returns each block's best rows of the
anchor's label, the second, for the positives so found, each block's best rows
of other labels in the window below the positive's score.  A block returns at
most ``positives`` rows an anchor, and ``negatives`` rows an anchor and
positive, so memory and shuffle are bounded whatever share of the rows one
label, or one repeated vector, holds; Spark's rank limit merges them.

Edge cases: rows whose label or vector is null, or with a component that is
null, non-finite or beyond ``vectors.LARGEST`` after scaling, take no part; a
null id is no anchor, and comes last among ties; rows that share an id are
told apart, so a copy of an anchor's row can be its positive; vectors of
different lengths are scored over the components both have, an empty one
scores 0; a positive without a negative in its window gives no row; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, stored
from .vectors import integers, matrix

STRIP = 64             # components multiplied at a time
BLOCK_BYTES = 1 << 20  # of the vectors of a block
BLOCK_ROWS = 4096
CHUNK = 512            # anchors
SLICE = 1024           # rows of a block scored at a time
BROADCAST_BYTES = 32 << 20

NONE = np.iinfo(np.int64).min


def _primes() -> list[int]:
    """Primes whose residues around 0 keep ``STRIP`` products below 2^24."""
    top = 2 * math.isqrt(((1 << 24) - 1) // STRIP) + 1
    return [p for p in range(top, top // 2, -1) if all(p % q for q in range(2, math.isqrt(p) + 1))]


PRIMES = _primes()


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of integer matrices, exact while it fits 63 bits."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width].astype(np.int64), b[:, :width].astype(np.int64)
    norm = lambda m: math.sqrt(float((m.astype(np.float64) ** 2).sum(1).max(initial=0)))
    half = int(norm(a) * norm(b) * (1 + 1e-6)) + 1  # no score is beyond it
    primes, range_ = [], 1
    while range_ <= 2 * half:
        primes.append(PRIMES[len(primes)])
        range_ *= primes[-1]
    digits, value, weight = [], np.zeros((len(a), len(b)), np.uint64), 1
    for p in primes:
        rest = np.full((len(a), len(b)), half % p, np.int64)  # of the score, moved to be positive
        ra, rb = _around(a, p), _around(b, p)
        for s in range(0, width, STRIP):
            rest += (ra[:, s:s + STRIP] @ rb[:, s:s + STRIP].T).astype(np.int64)
        # the next digit: what is left after the digits before, over their weight
        w = 1
        for q, digit in zip(primes, digits):
            rest -= digit * w
            w = w * q % p
        digit = rest % p * pow(w, -1, p) % p
        digits.append(digit)
        value += digit.astype(np.uint64) * np.uint64(weight % (1 << 64))
        weight *= p
    return (value - np.uint64(half)).astype(np.int64)


def _around(m: np.ndarray, p: int) -> np.ndarray:
    """Residues from ``-(p - 1) / 2`` to ``(p - 1) / 2``."""
    r = m % p
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores (``NONE``: no score), ties by place."""
    at = np.flatnonzero(scores != NONE)
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def pack(rows: DataFrame) -> DataFrame:
    """Blocks ``(uid, ids, labels, xs, width)`` of ``(_id, _label, _x)`` rows,
    in order of the id inside a block (nulls last).  ``uid`` is the first row's
    number; rows of a block are numbered on from it."""

    def run(batches):
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            lists, start = batch.column("_x"), 0
            sizes = np.maximum.accumulate(np.diff(lists.offsets.to_numpy())) if batch.num_rows else []
            while start < batch.num_rows:
                n = BLOCK_ROWS
                while n > 1 and n * 4 * int(sizes[min(start + n, len(sizes)) - 1]) > BLOCK_BYTES:
                    n //= 2
                part = batch.slice(start, n)
                start += n
                part = part.take(pa.compute.sort_indices(part.column("_id"), null_placement="at_end"))
                x = matrix(part.column("_x")).astype(np.int32)
                labels = part.column("_label").to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uid], pa.int64()), pa.array([part.column("_id").to_pylist()], pa.list_(pa.int64())),
                     pa.array([labels.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()),
                     pa.array([x.shape[1]], pa.int32())], ["uid", "ids", "labels", "xs", "width"])
                uid += len(part)

    return rows.mapInArrow(run, "uid long, ids array<long>, labels binary, xs binary, width int")


def _opened(batch: pa.RecordBatch, i: int) -> tuple[int, pa.Array, np.ndarray, np.ndarray]:
    width = batch.column("width")[i].as_py()
    ids = batch.column("ids")[i].values
    labels = np.frombuffer(batch.column("labels")[i].as_buffer(), np.int64)
    xs = np.frombuffer(batch.column("xs")[i].as_buffer() or b"", np.int32).reshape(len(ids), width)
    return batch.column("uid")[i].as_py(), ids, labels, xs


def anchors_of(blocks: DataFrame, every: int) -> DataFrame:
    """``(a, anchor, label, x)`` of the rows whose id ``every`` divides; ``a``
    is the row's number."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                uid, ids, labels, xs = _opened(batch, i)
                at = [j for j, v in enumerate(ids.to_pylist()) if v is not None and v % every == 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uid + j for j in at], pa.int64()), ids.take(pa.array(at, pa.int64())), pa.array(labels[at]),
                     pa.array([xs[j].tolist() for j in at], pa.list_(pa.int32()))], ["a", "anchor", "label", "x"])

    return blocks.mapInArrow(run, "a long, anchor long, label long, x array<int>")


def _meet(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """Each block with each chunk of anchors (``chunk``, a list of rows)."""
    size = anchors.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("x")), F.lit(0)).alias("c")).first()
    chunks = max(1, -(-size["n"] // CHUNK))
    few = size["n"] * 100 + size["c"] * 4 <= BROADCAST_BYTES
    sides = 1 if few else 16
    packed = anchors.withColumn("_chunk", F.pmod(F.xxhash64("a"), F.lit(chunks))).groupBy("_chunk") \
                    .agg(F.collect_list(F.struct(*anchors.columns)).alias("chunk"))
    packed = packed.withColumn("_side", F.explode(F.sequence(F.lit(0), F.lit(sides - 1))))
    spread = blocks.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))) \
                   .withColumn("_side", F.pmod(F.xxhash64("uid"), F.lit(sides)).cast("int"))
    return spread.join(F.broadcast(packed) if few else packed, ["_chunk", "_side"]).drop("_chunk", "_side")


def _scored(batches: Iterator[pa.RecordBatch]):
    """``(anchors, first row number, ids, labels, scores)`` of each meeting;
    ``scores`` yields slices of the block as ``(first place, matrix)``."""
    for batch in batches:
        for i in range(batch.num_rows):
            uid, ids, labels, xs = _opened(batch, i)
            chunk = batch.column("chunk")[i].values
            of = {name: chunk.field(j) for j, name in enumerate(f.name for f in chunk.type)}
            yield of, uid, ids, labels, [(s, products(matrix(of["x"]), xs[s:s + SLICE])) for s in range(0, len(xs), SLICE)]


def nearest_of_label(blocks: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """``(a, rank, id, score)``: each anchor's first ``k`` other rows of its
    label."""

    def run(batches):
        for of, uid, ids, labels, slices in _scored(batches):
            own, out = of["label"].to_numpy(), []
            scores = np.concatenate([s for _, s in slices], 1)
            for j, a in enumerate(of["a"].to_pylist()):
                s = np.where(labels == own[j], scores[j], NONE)
                if 0 <= a - uid < len(s):
                    s[a - uid] = NONE
                at = best(s, k)
                out.append((np.full(len(at), a), at, s[at]))
            a, at, s = (np.concatenate([o[i] for o in out]) for i in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), ids.take(pa.array(at, pa.int64())), pa.array(s, pa.int64()),
                                              pa.array(at + uid, pa.int64())], ["a", "id", "score", "uid"])

    found = _meet(blocks, anchors).mapInArrow(run, "a long, id long, score long, uid long")
    return _ranked(found, ["a"], k)


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("uid")


def window_below(blocks: DataFrame, anchors: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """``(a, p, rank, id, score)``: the first ``k`` rows of other labels that
    score from ``low`` to ``high`` hundredths of the score of positive ``p`` of
    anchor ``a``; ``scores`` of ``anchors`` lists these by ``p``."""
    g = math.gcd(low, math.gcd(high, 100))
    lo, hi, whole = low // g, high // g, 100 // g

    def run(batches):
        for of, uid, ids, labels, slices in _scored(batches):
            own, wanted, out = of["label"].to_numpy(), of["scores"].to_pylist(), []
            scores = np.concatenate([s for _, s in slices], 1)
            for j, a in enumerate(of["a"].to_pylist()):
                places = np.flatnonzero((labels != own[j]) & (whole * scores[j] <= hi * max(wanted[j]))
                                        & (whole * scores[j] >= lo * min(wanted[j])))
                s = scores[j][places]
                for p, top in enumerate(wanted[j]):
                    at = best(np.where((whole * s <= hi * top) & (whole * s >= lo * top), s, NONE), k)
                    out.append((np.full(len(at), a), np.full(len(at), p), places[at], s[at]))
            a, p, at, s = (np.concatenate([o[i] for o in out]) for i in range(4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(p, pa.int32()), ids.take(pa.array(at, pa.int64())), pa.array(s, pa.int64()),
                 pa.array(at + uid, pa.int64())], ["a", "p", "id", "score", "uid"])

    found = _meet(blocks, anchors).mapInArrow(run, "a long, p int, id long, score long, uid long")
    return _ranked(found, ["a", "p"], k)


def mine(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
         every: int = 100, scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80,
         high: int = 100) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``.  Anchors are the rows whose id ``every`` divides."""
    bound_batches(rows.sparkSession)
    fine, x = integers(rows, rows[vector_col], scale)
    of = (rows["label"] if label is None else label).cast("long")
    kept = rows.filter(fine & of.isNotNull()).select(rows[id_col].cast("long").alias("_id"), of.alias("_label"), x.alias("_x"))
    blocks = stored(pack(kept), "negatives-blocks")
    anchors = stored(anchors_of(blocks, every), "negatives-anchors")
    near = stored(nearest_of_label(blocks, anchors, positives), "negatives-positives")
    listed = near.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found")) \
                 .select("a", F.col("found.id").alias("positives"), F.col("found.score").alias("scores"))
    asked = stored(anchors.join(listed, "a"), "negatives-asked")
    below = window_below(blocks, asked.select("a", "label", "x", "scores"), negatives, low, high)
    return below.join(asked.select("a", "anchor", "positives", "scores"), "a").select(
        F.col("anchor").alias("anchor_id"), F.element_at("positives", F.col("p") + 1).alias("positive_id"), "rank",
        F.col("id").alias("negative_id"), F.element_at("scores", F.col("p") + 1).alias("positive_score"),
        F.col("score").alias("negative_score"))
