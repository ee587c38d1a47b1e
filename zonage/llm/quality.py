"""Quality classifier: a factorisation machine over hashed words, structure
statistics and the text's own metadata (its length).

A text becomes a sparse vector: hashed words (log counts, scaled to length 1)
and one indicator per statistic for the bin it falls in.  The score is the
logistic of ``w0 + <w, x> + sum over pairs <v_i, v_j> x_i x_j``, the pairwise
sum computed in linear time as half the sum over factors of
``(sum v x)^2 - sum v^2 x^2``.

The model is fitted on a bounded sample of labelled rows: of the ids that the
caller leaves in the :data:`SAMPLE_ROWS` smallest by their hash, and where ids
repeat, so that these have more texts, of the texts the :data:`SAMPLE_ROWS`
smallest by a hash of their features.  Its parameters are bounded (``DIM * (FACTORS + 1)`` floats) and
broadcast; scoring is one pass over whole texts where Spark reads them, in
chunks of bounded bytes.

Edge cases: null or empty texts have no words and score by their statistics;
null labels are ignored; with no labelled rows at all, or one class only, the
score is the smoothed share of label 1; repeated rows score alike; ties in the
sample are broken by the id; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _Shared
from .common import bound_batches, id_and_text, release, text_rows

WORD_DIM = 1 << 15
BINS = 12
SAMPLE_ROWS = 8000
FACTORS = 8
EPOCHS = 12
BATCH = 128
RATE = 0.08
DECAY = 1e-5
MEMO_SIZE = 200_000

_PUNCT = re.compile(rb"[^\x00-\x20A-Za-z0-9\x80-\xff]")
_DIGIT = re.compile(rb"[0-9]")
_UPPER = re.compile(rb"[A-Z]")
_STOP = re.compile(rb"[.!?][\"')\]]*(?:\s|$)")


def statistics(text: bytes, words: list[bytes], distinct: int) -> list[float]:
    """Structure statistics of a text, each from 0 to 1."""
    n, w = max(1, len(text)), max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    ended = sum(x.rstrip()[-1:] in (b".", b"!", b"?", b'"', b":") for x in lines)
    length = sum(map(len, words)) / w
    return [
        min(1.0, math.log2(1 + len(words)) / 16),
        min(1.0, length / 16),
        len(_PUNCT.findall(text)) / n * 4,
        len(_DIGIT.findall(text)) / n * 4,
        len(_UPPER.findall(text)) / n * 4,
        distinct / w,
        len(set(lines)) / max(1, len(lines)),
        ended / max(1, len(lines)),
        min(1.0, len(words) / max(1, len(lines)) / 64),
        min(1.0, 8 * len(_STOP.findall(text)) / w),
        sum(not (x[-1:].isalnum() or x[-1:] >= b"\x80") for x in words) / w,
        sum(not (x[:1].isalnum() or x[:1] >= b"\x80") for x in words) / w,
        sum(map(eq, words, words[1:])) / w,
    ]


N_STATS = len(statistics(b"", [], 0))
DIM = WORD_DIM + N_STATS * BINS


class Features(dict):
    """Memo from a word to its hashed feature."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = zlib.crc32(word) % WORD_DIM
        return h

    def vector(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """``(features, values)`` of one text."""
        if len(self) > MEMO_SIZE:
            self.clear()
        words = text.lower().split()
        ids = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        at, counts = np.unique(ids, return_counts=True)
        values = np.log1p(counts)
        values /= max(1e-9, float(np.sqrt((values ** 2).sum())))
        stats = np.array(statistics(text, words, len(set(words))))
        bins = np.minimum((stats * BINS).astype(np.int32), BINS - 1)
        return (np.concatenate([at, WORD_DIM + np.arange(N_STATS, dtype=np.int32) * BINS + bins]).astype(np.int32),
                np.concatenate([values, np.full(N_STATS, 1 / math.sqrt(N_STATS))]).astype(np.float32))


@dataclass
class Machine:
    w0: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, at: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[at] * x[:, None]
        return float(self.w0 + self.w[at] @ x + 0.5 * ((vx.sum(0) ** 2).sum() - (vx ** 2).sum()))

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.margin(at, x)))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 1) -> Machine:
    """AdaGrad on the logistic loss over mini-batches."""
    rng = np.random.default_rng(seed)
    ones = sum(y for *_, y in rows)
    prior = (ones + 0.5) / (len(rows) + 1)
    m = Machine(math.log(prior / (1 - prior)), np.zeros(DIM, np.float32), np.zeros((DIM, FACTORS), np.float32))
    if not 0 < ones < len(rows):
        return m
    m.v[:] = rng.normal(0, 0.02, m.v.shape)
    gw, gv, g0 = np.full(DIM, 1e-6, np.float32), np.full(m.v.shape, 1e-6, np.float32), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for s in range(0, len(rows), BATCH):
            part = [rows[i] for i in order[s:s + BATCH]]
            at, x = np.concatenate([r[0] for r in part]), np.concatenate([r[1] for r in part])[:, None]
            starts = np.cumsum([0] + [len(r[0]) for r in part[:-1]])
            of = np.repeat(np.arange(len(part)), [len(r[0]) for r in part])
            vx = m.v[at] * x
            sums = np.add.reduceat(vx, starts)
            z = m.w0 + np.add.reduceat(m.w[at] * x[:, 0], starts) \
                + 0.5 * ((sums ** 2).sum(1) - np.add.reduceat((vx ** 2).sum(1), starts))
            y = np.array([r[2] for r in part])
            d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(part)
            dx = d[of][:, None] * x
            uniq, inv = np.unique(at, return_inverse=True)
            dw = np.bincount(inv, dx[:, 0], len(uniq)) + DECAY * m.w[uniq]
            each = dx * (sums[of] - vx)
            dv = np.stack([np.bincount(inv, each[:, f], len(uniq)) for f in range(FACTORS)], 1) + DECAY * m.v[uniq]
            gw[uniq] += dw ** 2
            gv[uniq] += dv ** 2
            g0 += d.sum() ** 2
            m.w[uniq] -= RATE * dw / np.sqrt(gw[uniq])
            m.v[uniq] -= RATE / 4 * dv / np.sqrt(gv[uniq])
            m.w0 -= RATE * d.sum() / math.sqrt(g0)
    return m


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on at most ``max_rows`` labelled rows; the sample is bounded, so it
    is broadcast, and its vectors go to the driver."""
    labelled = labels.select(labels[id_col].alias("_lid"), labels[label_col].cast("int").alias("_y")).dropna()
    sample = labelled.distinct().orderBy(F.xxhash64("_lid"), "_lid", "_y").limit(max_rows)
    src = id_and_text(docs, id_col, text_col)
    src = src.join(F.broadcast(sample), F.col("_id") == F.col("_lid")).select("_y", "_text")

    def run(batches):
        features = Features()
        for batch in batches:
            for ys, texts in text_rows([batch]):
                vs = [features.vector(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ys, pa.int32()), pa.array([a.tobytes() for a, _ in vs], pa.binary()),
                     pa.array([x.tobytes() for _, x in vs], pa.binary())], ["y", "at", "x"])

    found = src.mapInArrow(run, "y int, at binary, x binary") \
               .orderBy(F.xxhash64("at", "x", "y")).limit(max_rows).collect()
    return fit([(np.frombuffer(r["at"], np.int32), np.frombuffer(r["x"], np.float32), int(r["y"] > 0)) for r in found])


def scores(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` per row: how likely label 1 is."""
    src = id_and_text(docs, id_col, text_col)
    shared = _Shared(docs.sparkSession, machine)

    def run(batches):
        features = Features()
        for batch in batches:
            for ids, texts in text_rows([batch]):
                out = [shared.value.score(*features.vector(t)) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.column(0).type), pa.array(out, pa.float64())], ["_id", "score"])

    return src.mapInArrow(run, f"_id {src.schema['_id'].dataType.simpleString()}, score double") \
              .withColumnRenamed("_id", id_col)


def keep_good(docs: DataFrame, machine: Machine, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``, all columns
    unchanged, without a shuffle."""
    bound_batches(docs.sparkSession)
    shared = _Shared(docs.sparkSession, machine)
    column = docs.columns.index(text_col)

    def run(batches):
        features = Features()
        for batch in batches:
            texts = pa.compute.fill_null(batch.column(column).cast(pa.string()), "")
            rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), texts], ["i", "text"])
            keep = [shared.value.score(*features.vector(t)) >= threshold for _, part in text_rows([rows]) for t in part]
            yield batch.filter(pa.array(keep, pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)
