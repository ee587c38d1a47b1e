"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is a run of letters, digits and bytes beyond ASCII, lower-cased; one
that repeats the word before it is left out.  Its
features are itself and its byte n-grams of :data:`GRAMS` bytes, the marks
before and after it included, all hashed to rows of one embedding table; so a
misspelling that was never seen shares most vectors with the word it comes
from.  The vectors of a window of :data:`WINDOW` words are averaged and go
through a linear softmax of two classes; a text is as toxic as its most toxic
window, so that an insult in a long text isn't averaged away.  Windows step by
half their length and cover the whole text.

Vectors and softmax are trained jointly, with AdaGrad in numpy, on windows: at
first random ones under the label of their text, then the most toxic window
of each text by the model so far, and a random one of the clean texts.  The
fit is on a bounded sample of labelled rows: per class the :data:`SAMPLE_ROWS`
smallest by a hash of the id, of those with at most :data:`SAMPLE_BYTES` bytes
of text.  The score of a window is linear in its features up to the softmax,
so the model that is broadcast is one number for each row of the table, and
scoring is a gather and running sums over the bytes of whole texts, in
sections of bounded length, where Spark reads them.

Edge cases: null or empty texts, and texts without a word, have the score of a
window without features; words of any length are summed over all their
n-grams; a text of fewer words than a window is one window; null labels are
ignored, an id with both labels is learnt under both; without labelled rows of
both classes the score is their smoothed share; repeated rows score alike;
extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import _Shared
from .common import id_and_text, text_rows

ROWS = 1 << 16         # of the embedding table
DIM = 8
GRAMS = (3, 4, 5)
WINDOW = 16            # words; the next window begins half as many later
SAMPLE_ROWS = 1500     # of each class
SAMPLE_BYTES = 1 << 15
EPOCHS = 9
FIRST = 6              # epochs on random windows
BATCH = 64
RATE = 0.5
SECTION = 1 << 18      # bytes that are hashed at a time

_MARK = 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_NORMAL = np.where(_WORD, np.arange(256), _MARK).astype(np.uint8)
_NORMAL[65:91] += 32
_BYTE = np.random.default_rng(23).integers(1, 1 << 63, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _slot(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(40)).astype(np.int64) % ROWS


def sections(text: bytes) -> Iterator[bytes]:
    """``text`` in sections of about :data:`SECTION` bytes, cut between words;
    a word longer than a section is cut too."""
    raw = np.frombuffer(text, np.uint8)
    at = 0
    while len(text) - at > SECTION:
        gaps = np.flatnonzero(~_WORD[raw[at + SECTION // 2:at + SECTION]])
        cut = at + SECTION // 2 + int(gaps[-1]) if len(gaps) else at + SECTION
        yield text[at:cut]
        at = cut
    yield text[at:]


_known: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base, and of its inverse modulo 2^64."""
    if len(_known[0]) < n:
        for k, base in enumerate((int(_BASE), pow(int(_BASE), -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _known[k] = np.cumprod(steps)
    return _known


def words(text: bytes) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Of a text: the table row of each word as a whole, those of the n-grams
    that start at each byte (one array for each length, position 0 being the
    mark before the text), and start and end of each word in these positions.
    A word that repeats the one before it is left out: a line of one word over
    and over says no more than the word."""
    raw = np.full(len(text) + 2, _MARK, np.uint8)
    raw[1:-1] = _NORMAL[np.frombuffer(text, np.uint8)]
    inside = raw != _MARK
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    code, h, grams = _BYTE[raw], np.zeros(len(raw), np.uint64), []
    for n in range(1, max(GRAMS) + 1):
        h = h[:len(raw) - n + 1] * _BASE + code[n - 1:] if len(raw) >= n else h[:0]
        if n in GRAMS:
            grams.append(_slot(h + np.uint64(n)))
    # a word's hash: a polynomial in its bytes, from one running sum over all
    power, inverse = _powers(len(raw))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * power[:len(raw)])])
    whole = (sums[ends] - sums[starts]) * inverse[starts]
    new = np.concatenate([[True], whole[1:] != whole[:-1]])[:len(whole)]
    return _slot(whole[new]), grams, starts[new], ends[new]


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all features of a text, word by word, and where each
    word's begin (with the end of the last)."""
    rows, sizes = [], []
    for part in sections(text):
        whole, grams, starts, ends = words(part)
        if not len(starts):
            continue
        of, at = [np.arange(len(starts))], [whole]
        for n, g in zip(GRAMS, grams):
            count = np.maximum(ends - starts + 3 - n, 0)
            first = np.repeat(starts - 1 - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
            at.append(g[first + np.arange(count.sum())])
            of.append(np.repeat(np.arange(len(starts)), count))
        of = np.concatenate(of)
        rows.append(np.concatenate(at)[np.argsort(of, kind="stable")])
        sizes.append(np.bincount(of, minlength=len(starts)))
    if not rows:
        return np.zeros(0, np.uint16), np.zeros(1, np.int64)
    return np.concatenate(rows).astype(np.uint16), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def window_starts(n: int) -> np.ndarray:
    """First words of the windows of ``n`` words; the last window ends with
    the text."""
    last = max(0, n - WINDOW)
    step = np.arange(0, last, max(1, WINDOW // 2))
    return np.append(step, last)


@dataclass
class Model:
    """``margin + mean of weight[row]`` is a window's log-odds of label 1."""

    margin: float
    weight: np.ndarray

    def windows(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log-odds of each window from running sums over words of weights and
        of feature counts."""
        at = window_starts(len(sums) - 1)
        to = np.minimum(at + WINDOW, len(sums) - 1)
        return self.margin + (sums[to] - sums[at]) / np.maximum(1, counts[to] - counts[at])

    def log_odds(self, text: bytes) -> float:
        """Of the most toxic window of a text."""
        sums, counts = [np.zeros(1)], [np.zeros(1)]
        for part in sections(text):
            whole, grams, starts, ends = words(part)
            if not len(starts):
                continue
            s, c = self.weight[whole], np.ones(len(starts))
            for n, g in zip(GRAMS, grams):
                run = np.concatenate([[0.0], np.cumsum(self.weight[g])])
                count = np.maximum(ends - starts + 3 - n, 0)
                first = np.minimum(starts - 1, len(g))
                s = s + run[first + count] - run[first]
                c += count
            sums.append(s)
            counts.append(c)
        return float(self.windows(np.cumsum(np.concatenate(sums)), np.cumsum(np.concatenate(counts))).max())

    def score(self, text: bytes) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.log_odds(text)))))


@dataclass
class Parameters:
    """Embedding table, softmax weights and biases, and their squared steps."""

    table: np.ndarray
    soft: np.ndarray
    bias: np.ndarray

    def __post_init__(self):
        self.steps = [np.full(x.shape, 1e-6, np.float32) for x in (self.table, self.soft, self.bias)]

    def model(self) -> Model:
        side = self.soft[:, 1] - self.soft[:, 0]
        return Model(float(self.bias[1] - self.bias[0]), (self.table @ side).astype(np.float64))

    def learn(self, bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> None:
        """One step on the cross entropy of windows, given as table rows."""
        sizes = np.array([len(b) for b in bags])
        rows, of = np.concatenate(bags).astype(np.int64), np.repeat(np.arange(len(bags)), sizes)
        uniq, at = np.unique(rows, return_inverse=True)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        mean = np.add.reduceat(self.table[rows], first) / sizes[:, None].astype(np.float32)
        z = mean @ self.soft + self.bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        d = (p - np.eye(2, dtype=np.float32)[y]) * (weight / weight.sum())[:, None].astype(np.float32)
        each = ((d @ self.soft.T) / sizes[:, None])[of]
        table = np.stack([np.bincount(at, each[:, k], len(uniq)) for k in range(DIM)], 1)
        slopes = [table, mean.T @ d, d.sum(0)]
        for x, g, s, rate, i in zip((self.table, self.soft, self.bias), slopes, self.steps, (RATE, RATE / 4, RATE / 4),
                                    (uniq, ..., ...)):
            s[i] += g ** 2
            x[i] -= rate * g / np.sqrt(s[i])


def fit(texts: list[tuple[bytes, int]], seed: int = 3) -> Model:
    """Joint training of vectors and softmax on labelled texts."""
    rng = np.random.default_rng(seed)
    docs = [(*features(t), y) for t, y in texts]
    ones = sum(y for *_, y in docs)
    docs = [(rows, at, y) for rows, at, y in docs if len(rows)]
    if not 0 < sum(y for *_, y in docs) < len(docs):
        share = (ones + 0.5) / (len(texts) + 1)
        return Model(math.log(share / (1 - share)), np.zeros(ROWS))
    p = Parameters(rng.normal(0, 0.1, (ROWS, DIM)).astype(np.float32), rng.normal(0, 0.5, (DIM, 2)).astype(np.float32),
                   np.zeros(2, np.float32))
    bag = lambda rows, at, w: rows[at[w]:at[min(w + WINDOW, len(at) - 1)]]
    starts = [window_starts(len(at) - 1) for _, at, _ in docs]
    for epoch in range(EPOCHS):
        picked = []
        model = p.model()
        for (rows, at, y), ws in zip(docs, starts):
            if epoch < FIRST:
                chosen = rng.choice(ws, min(len(ws), 6 if y else 2), replace=False)
            else:
                run = np.concatenate([[0.0], np.cumsum(model.weight[rows])])[at]
                chosen = {int(ws[np.argmax(model.windows(run, at))])} | (set() if y else {int(rng.choice(ws))})
            picked += [(bag(rows, at, w), y, 1 / len(chosen)) for w in chosen]
        order = rng.permutation(len(picked))
        for s in range(0, len(order), BATCH):
            part = [picked[i] for i in order[s:s + BATCH]]
            p.learn([b for b, *_ in part], np.array([y for _, y, _ in part]), np.array([w for *_, w in part]))
    return p.model()


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled rows of each class; the sample is
    bounded in rows and bytes, so it is broadcast and its texts go to the
    driver."""
    labelled = labels.select(labels[id_col].alias("_lid"), (labels[label_col] > 0).cast("int").alias("_y")).dropna().distinct()
    src = id_and_text(docs, id_col, text_col).filter(F.octet_length("_text") <= SAMPLE_BYTES)
    ids = []
    for y in (0, 1):
        ids.append(labelled.filter(F.col("_y") == y).orderBy(F.xxhash64("_lid"), "_lid").limit(max_rows))
    found = src.join(F.broadcast(ids[0].union(ids[1])), F.col("_id") == F.col("_lid")).select("_lid", "_y", "_text")
    # an id may have several texts: the rows stay bounded
    order = Window.partitionBy("_y").orderBy(F.xxhash64("_lid"), F.xxhash64("_text"))
    rows = found.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= max_rows).orderBy("_y", "_k").collect()
    return fit([(r["_text"].encode(), r["_y"]) for r in rows])


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` per row: how likely label 1 is."""
    src = id_and_text(docs, id_col, text_col)
    shared = _Shared(docs.sparkSession, model)

    def run(batches):
        for batch in batches:
            for ids, texts in text_rows([batch]):
                out = [shared.value.score(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.column(0).type), pa.array(out, pa.float64())], ["_id", "score"])

    return src.mapInArrow(run, f"_id {src.schema['_id'].dataType.simpleString()}, score double") \
              .withColumnRenamed("_id", id_col)
