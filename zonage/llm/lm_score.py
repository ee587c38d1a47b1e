"""Language-model scoring by a Brown class-based bigram model.

Training counts words and adjacent pairs over all training documents.  Every
word that occurs :data:`LEAST` times has a class of its own choice, found by
exchange in two steps.  First the words that are at least a :data:`FREQUENT`-th
of all tokens, and the shapes that stand for all other words, go through rounds
of exchange: in each, every word (or shape) of one part of them moves to the
class that raises the training likelihood of the class bigrams most, all others
staying, and the parts take turns.  Then every other word of :data:`LEAST`
occurrences, which till then has the class of its shape, moves to the class
under which its occurrences are likeliest, given the classes of the words
beside them; a word of that step is too rare to change the transitions by
itself, so all move at once, one time.  Words that are rarer, and those never
seen, have the class of their shape.  The number of words with a class grows
with the corpus, without a bound.  The probability of a token is

    LAMBDA * P(class | class before) * P(word | class)
    + (1 - LAMBDA) * (c(word) + 0.5) / (N + 0.5 * (V + 1)),

the class transitions smoothed towards the classes' frequencies.  A clustered
word's or a shape's share of its class is its share of the class's tokens;
within a shape of ``v`` words and ``n`` tokens, a word has ``(c(word) + 0.5) /
(n + 0.5 * (v + 1))``, which leaves unknown words of that shape as much as a word
seen half a time.  It sums to 1 over the training words and the unknown one,
whose class part its shapes share.  Perplexity follows as
``10 ** (-score / n_tokens)``.

Words are 56-bit hashes with 8 bits of shape.  Of the words with a class the
most frequent are broadcast, at most :data:`LOOKED_UP`.  Classes and counts of
the others and counts of rarer words stay distributed; the documents' tokens
that aren't broadcast are joined with them, and so are the tokens behind a word
whose class is not broadcast.  A bitmap of fixed size leaves few others to ask
for, so scores don't depend on how many words are broadcast.  The first step
reads, per frequent word, how often it stands beside each other
frequent word or shape; the second, per word, how often it stands between each
two classes.  A task needs the rows of its own words only.

Edge cases: null or empty texts are one token, the end; equal texts score
equal, repeated rows included; a null id is in no fold and is scored as held
out of training; with no training text at all only the smoothed base remains
(N = 0, V = 0); very long texts are read as one sequence; extra columns don't
matter.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import _Shared
from .common import id_and_text, left_join_spread, stored, text_rows
from .wordhash import SECTION, mix, sections, word_hashes

CLASSES = 64
SHAPES = 256
LEAST = 5               # occurrences of a word with a class of its own choice
LOOKED_UP = 1 << 19     # broadcast words with such a class; the most frequent ones
BITS = 1 << 24          # of the bitmap of the others
FREQUENT = 1 << 13      # words with at least this share of all tokens take part in the rounds
ROUNDS = 12
PARTS = 4
LAMBDA = 0.95
SMOOTH = 16.0
AT_ONCE = 1 << 22       # tokens that a task counts together
MEMO_SIZE = 400_000
_LETTER = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
END = 0                 # the end of a text; no word has this hash


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` (the low bits being the shape) and where
    they start.  A word's shape: whether other characters follow its last
    letter, whether it is long, and its last two letters, hashed."""
    raw = np.frombuffer(data.lower(), np.uint8)  # of bytes: A-Z only
    hashes, starts, ends = word_hashes(raw)
    if not len(starts):
        return hashes, starts
    stem = np.maximum.accumulate(np.where(_LETTER[raw], np.arange(len(raw)), -1))[ends - 1]
    stem = np.where(stem < starts, ends - 1, stem)
    two = raw[stem].astype(np.uint64) * np.uint64(131) + np.where(stem > starts, raw[stem - 1], 0).astype(np.uint64)
    shape = (stem < ends - 1).astype(np.uint64) | (ends - starts > 8).astype(np.uint64) << np.uint64(1) \
        | mix(two * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(SHAPES // 4) << np.uint64(2)
    return (hashes | np.uint64(1 << 63)) & ~np.uint64(SHAPES - 1) | shape, starts


def token_arrays(texts: list[bytes]):
    """Chunks of texts: their positions in ``texts``, all their tokens (each
    text's words, then its end) in one array, and each text's first and end."""
    held, size = [], 0

    def settle():
        hashes, starts = _hashed(b" ".join(texts[i] for i in held))
        words = np.searchsorted(starts, np.cumsum([0] + [len(texts[i]) + 1 for i in held]))
        bounds = words + np.arange(len(words))  # an end behind each text
        tokens = np.full(len(hashes) + len(held), END, np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[bounds[1:] - 1] = False
        tokens[inner] = hashes
        return held, tokens, bounds

    for i, t in enumerate(texts):
        if len(t) > SECTION:
            tokens = np.concatenate([*(_hashed(x)[0] for x in sections(t)), np.full(1, END, np.uint64)])
            yield [i], tokens, np.array([0, len(tokens)])
            continue
        if held and size + len(t) > SECTION:
            yield settle()
            held, size = [], 0
        held.append(i)
        size += len(t)
    if held:
        yield settle()


class Index:
    """Places of sorted 64-bit hashes: by their high bits (but for the first,
    which all words have set) to a few neighbours, compared one by one."""

    def __init__(self, keys: np.ndarray):
        bits = max(1, len(keys).bit_length() + 1)
        self.keys, self.shift = keys, np.uint64(64 - bits)
        self.first = np.searchsorted(self.bucket(keys), np.arange((1 << bits) + 1)).astype(np.int32)

    def bucket(self, x: np.ndarray) -> np.ndarray:
        return ((x << np.uint64(1)) >> self.shift).astype(np.int64)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        out = np.full(len(x), -1, np.int64)
        b = self.bucket(x)
        at, end = self.first[b].astype(np.int64), self.first[b + 1]
        left = np.flatnonzero(at < end)
        while len(left):
            here = at[left]
            same = self.keys[here] == x[left]
            out[left[same]] = here[same]
            at[left] += 1
            left = left[~same & (at[left] < end[left])]
        return out


@dataclass
class Model:
    index: Index         # of the broadcast words with a class of their own choice
    classes: np.ndarray  # of each unit: these words, then the shapes
    tokens: np.ndarray   # of each unit
    kinds: np.ndarray    # distinct words per shape that have the shape's class
    pairs: np.ndarray    # counts of class pairs
    total: int           # N
    distinct: int        # V
    others: np.ndarray   # bitmap of the other words with a class of their own choice; may be empty

    def __post_init__(self):
        self.words = len(self.classes) - SHAPES
        self.sizes = sizes = self.pairs.sum(0)
        share = (sizes + 1e-9) / (sizes.sum() + 1e-9 * len(sizes))
        self.trans = LAMBDA * (self.pairs + SMOOTH * share) / (self.pairs.sum(1, keepdims=True) + SMOOTH)
        # The class part is the transition * (count + added) * weight of the unit.
        own = np.maximum(self.tokens, 1e-9) / np.maximum(sizes[self.classes], 1e-9)
        whole = self.tokens + 0.5 * np.concatenate([np.zeros(self.words), self.kinds + 1.0])
        self.weight = own / np.maximum(whole, 1e-9)
        self.norm = self.total + 0.5 * (self.distinct + 1)

    def look_up(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units, and counts (-1: not among the broadcast words)."""
        at = self.index.find(tokens)
        found = at >= 0
        units = np.where(found, at, self.words + (tokens & np.uint64(SHAPES - 1)).astype(np.int64))
        return units, np.where(found, self.tokens[units], -1)

    def unsure(self, tokens: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Which tokens, of these counts, may be words that have a class of
        their own choice which isn't broadcast."""
        if not len(self.others):
            return np.zeros(len(tokens), bool)
        bit = (tokens >> np.uint64(8)).astype(np.int64) % (32 * len(self.others))
        return (n < 0) & (self.others[bit >> 5] >> (bit & 31).astype(np.uint32) & np.uint32(1)).astype(bool)

    def added(self, units: np.ndarray) -> np.ndarray:
        """What is added to a token's count: half a word in shapes."""
        return np.where(units < self.words, 0.0, 0.5)

    def factors(self, units: np.ndarray) -> np.ndarray:
        """What a token's count (plus what is added) is multiplied with, from
        the units of whole texts; a text begins behind an end, its own or
        another's."""
        c = self.classes[units]
        return self.trans[np.concatenate([c[-1:], c[:-1]]), c] * self.weight[units]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _behind(x: np.ndarray) -> np.ndarray:
    """Of each token of whole texts, ``x`` of the token before it."""
    return np.concatenate([x[-1:], x[:-1]])


def _count(train: DataFrame) -> DataFrame:
    """``(w, n)`` over all training tokens."""

    def run(batches):
        held, size = [], 0

        def counted():
            w, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(_signed(w)), pa.array(n.astype(np.int64))], ["w", "n"])

        for batch in batches:
            for _, texts in text_rows([batch]):
                for _, x, _ in token_arrays(texts):
                    held.append(x)
                    size += len(x)
                if size >= AT_ONCE:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return train.mapInArrow(run, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n"))


def _neighbours(train: DataFrame, vocabulary: _Shared) -> DataFrame:
    """``(w, other, n)``: how often clustered word or shape class ``w`` stands
    before ``other`` (``other`` >= 0) or behind it (``-1 - other``)."""

    def run(batches):
        held, size = [], 0
        hashes = vocabulary.value

        def counted():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], ["pair", "n"])

        for batch in batches:
            for _, texts in text_rows([batch]):
                for _, x, _ in token_arrays(texts):
                    at = np.minimum(np.searchsorted(hashes, x), len(hashes) - 1)
                    ids = np.where(hashes[at] == x, at, len(hashes) + (x & np.uint64(SHAPES - 1)).astype(np.int64))
                    held.append(np.concatenate([ids[-1:], ids[:-1]]) << 32 | ids)
                    size += len(x)
                if size >= AT_ONCE:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    pairs = train.mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(0xFFFFFFFF)
    both = F.array(F.struct(a.alias("w"), b.alias("other")), F.struct(b.alias("w"), (F.lit(-1) - a).alias("other")))
    return (pairs.select(F.explode(both).alias("e"), "n").select("e.w", "e.other", "n")
                 .repartition("w").sortWithinPartitions("w"))


def _class_pairs(rows: DataFrame, classes: _Shared) -> np.ndarray:
    """Counts of class pairs under an assignment."""
    k = CLASSES

    def run(batches):
        out = np.zeros(k * k)
        for batch in batches:
            w, other, n = (c.to_numpy() for c in batch.columns)
            f = other >= 0
            out += np.bincount(classes.value[w[f]] * k + classes.value[other[f]], n[f], k * k)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at].astype(np.int64))], ["at", "n"])

    found = rows.mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(k * k)
    out[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    return out.reshape(k, k)


def _xlogx(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0.0)
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(pairs: np.ndarray) -> float:
    """Log likelihood of the class bigrams, but for what no assignment changes."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(1)).sum() - _xlogx(pairs.sum(0)).sum())


def best_class(a: int, after: np.ndarray, behind: np.ndarray, pairs: np.ndarray) -> int:
    """The class that a unit of class ``a`` does best in: ``after[d]`` and
    ``behind[c]`` count the classes that follow and precede it.  ``pairs`` is
    left with the unit in that class."""
    pairs[a] -= after
    pairs[:, a] -= behind
    np.maximum(pairs, 0, out=pairs)
    rows, cols, n, m = pairs.sum(1), pairs.sum(0), after.sum(), behind.sum()
    d, e = np.flatnonzero(after), np.flatnonzero(behind)
    gain = (_xlogx(pairs[:, d] + after[d]) - _xlogx(pairs[:, d])).sum(1)
    gain += (_xlogx(pairs[e] + behind[e][:, None]) - _xlogx(pairs[e])).sum(0)
    gain -= _xlogx(rows + n) - _xlogx(rows) + _xlogx(cols + m) - _xlogx(cols)
    best = int(np.argmax(gain))
    best = best if gain[best] > gain[a] + 1e-9 else a
    pairs[best] += after
    pairs[:, best] += behind
    return best


def _exchange(rows: DataFrame, classes: _Shared, pairs: _Shared, turn: int) -> DataFrame:
    """``(w, class)``: the units of one part that move, and where.  A task moves
    its own units one after the other, each seeing the moves before it."""

    def run(batches):
        cls, counts = classes.value.copy(), pairs.value.copy()
        held = [np.empty(0, np.int64)] * 3

        def settle(w, other, n):
            out = []
            at = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            for s, e in zip(at, [*at[1:], len(w)]):
                x = int(w[s])
                if (x * 0x9E3779B1 >> 16) % PARTS != turn % PARTS:
                    continue
                o, m = other[s:e], n[s:e]
                f = o >= 0
                after = np.bincount(cls[o[f]], m[f], CLASSES)
                behind = np.bincount(cls[-1 - o[~f]], m[~f], CLASSES)
                to = best_class(int(cls[x]), after, behind, counts)
                if to != cls[x]:
                    cls[x] = to
                    out.append((x, to))
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()),
                                               pa.array([c for _, c in out], pa.int64())], ["w", "class"])

        for batch in batches:  # a unit's rows are together; the last unit's may go on
            w, other, n = (np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns))
            if not len(w):
                continue
            cut = int(np.searchsorted(w, w[-1]))
            if cut:
                yield settle(w[:cut], other[:cut], n[:cut])
            held = [w[cut:], other[cut:], n[cut:]]
        if len(held[0]):
            yield settle(*held)

    return rows.mapInArrow(run, "w bigint, class bigint")


def cluster(rows: DataFrame, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exchange clustering from a first assignment: the classes, and the counts
    of class pairs.  Tasks don't see each other's moves, so a round's moves are
    taken back by halves while they lower the likelihood."""
    spark = rows.sparkSession
    pairs = _class_pairs(rows, _Shared(spark, cls))
    for turn in range(ROUNDS):
        moves = _exchange(rows, _Shared(spark, cls), _Shared(spark, pairs), turn).toPandas().to_numpy(np.int64)
        while len(moves):
            new = cls.copy()
            new[moves[:, 0]] = moves[:, 1]
            then = _class_pairs(rows, _Shared(spark, new))
            if likelihood(then) > likelihood(pairs):
                cls, pairs = new, then
                break
            moves = moves[::2] if len(moves) > 1 else moves[:0]
    return cls, pairs


def _between(train: DataFrame, model: _Shared, frequent: _Shared) -> DataFrame:
    """``(u, between, n)``: how often ``u``, the unit of a word that isn't
    frequent or (below 0) the hash of one that may have a class which isn't
    broadcast, stands behind one class and before another (both in ``between``)."""

    def run(batches):
        held, others, size = [], [], 0

        def counted(key, names=None):
            key, n = np.unique(key, return_counts=True)
            u = key // CLASSES ** 2
            return pa.RecordBatch.from_arrays([pa.array(u if names is None else names[u]),
                                               pa.array((key % CLASSES ** 2).astype(np.int32)),
                                               pa.array(n.astype(np.int32))], ["u", "between", "n"])

        def settle():
            yield counted(np.concatenate(held))
            names, at = np.unique(np.concatenate([w for w, _ in others]), return_inverse=True)
            yield counted(at * CLASSES ** 2 + np.concatenate([b for _, b in others]), names)

        for batch in batches:
            for _, texts in text_rows([batch]):
                for _, x, _ in token_arrays(texts):
                    u, n = model.value.look_up(x)
                    c = model.value.classes[u].astype(np.int64)
                    at = np.flatnonzero((n >= 0) & ~frequent.value[u])
                    held.append(u[at] * CLASSES ** 2 + c[at - 1] * CLASSES + c[(at + 1) % len(c)])
                    at = np.flatnonzero(model.value.unsure(x, n))
                    others.append((_signed(x[at]), c[at - 1] * CLASSES + c[(at + 1) % len(c)]))
                    size += len(x)
                if size >= AT_ONCE:
                    yield from settle()
                    held, others, size = [], [], 0
        if held:
            yield from settle()

    return train.mapInArrow(run, "u bigint, between int, n int").repartition("u")


def _choose(between: DataFrame, pairs: np.ndarray) -> DataFrame:
    """``(u, class)``: the class under which a word's occurrences are likeliest."""
    rows, cols = pairs.sum(1, keepdims=True), pairs.sum(0)
    follow = np.log((pairs + SMOOTH / CLASSES) / (rows + SMOOTH))  # log P(class | class before)
    share = np.log(cols + SMOOTH)                                  # a word's share of a class is count / size

    def settle(u, between, n):
        units, at = np.unique(u, return_inverse=True)
        sums = lambda c: np.bincount(at * CLASSES + c, n, len(units) * CLASSES).reshape(-1, CLASSES)
        behind, before = sums(between // CLASSES), sums(between % CLASSES)
        gain = behind @ follow + before @ follow.T - behind.sum(1, keepdims=True) * share
        return pa.RecordBatch.from_arrays([pa.array(units, pa.int64()), pa.array(gain.argmax(1), pa.int32())], ["u", "class"])

    def run(batches):
        held = [np.empty(0, np.int64)] * 3
        for batch in batches:  # a word's rows are together; the last word's may go on
            u, between, n = (np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns))
            if not len(u):
                continue
            cut = int(np.searchsorted(u, u[-1]))
            if cut:
                yield settle(u[:cut], between[:cut], n[:cut])
            held = [u[cut:], between[cut:], n[cut:]]
        if len(held[0]):
            yield settle(*held)

    return between.sortWithinPartitions("u").mapInArrow(run, "u bigint, class int")


def _recount(train: DataFrame, model: _Shared, others: DataFrame) -> np.ndarray:
    """Counts of class pairs over all training tokens; ``others`` has the
    ``(w, class)`` that aren't broadcast."""

    def run(batches):
        out, m = np.zeros(CLASSES ** 2, np.int64), model.value
        for batch in batches:
            for _, texts in text_rows([batch]):
                for _, x, _ in token_arrays(texts):
                    u, n = m.look_up(x)
                    c, unsure = m.classes[u].astype(np.int64), m.unsure(x, n)
                    sure = ~unsure & ~_behind(unsure)
                    out += np.bincount((_behind(c) * CLASSES + c)[sure], minlength=CLASSES ** 2)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], ["at", "n"])

    found = train.mapInArrow(run, "at bigint, n bigint")
    if len(model.value.others):
        found = found.unionByName(_joined_pairs(train, model, others))
    found = found.groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(CLASSES ** 2)
    out[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    return out.reshape(CLASSES, CLASSES)


def _joined_pairs(train: DataFrame, model: _Shared, others: DataFrame) -> DataFrame:
    """``(at, n)``: counts of class pairs, for adjacent training tokens of which
    one may have a class that isn't broadcast.  A task counts a pair of a hash
    and a class, or of two hashes, together."""

    def run(batches):
        held, size, m = [], 0, model.value

        def counted():
            w, c, first = (np.concatenate(x) for x in zip(*held))
            (w, at), (c, of) = (np.unique(x, return_inverse=True) for x in (w, c))
            key, n = np.unique((at * len(c) + of) * 2 + first, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(w[key // 2 // len(c)]), pa.array(c[key // 2 % len(c)]),
                                               pa.array(key % 2 == 1), pa.array(n)], ["w", "other", "first", "n"])

        for batch in batches:
            for _, texts in text_rows([batch]):
                for _, x, _ in token_arrays(texts):
                    u, n = m.look_up(x)
                    unsure = m.unsure(x, n)
                    end = np.where(unsure, _signed(x), m.classes[u])  # classes are 0 or more, hashes below 0
                    some = unsure | _behind(unsure)
                    a, b = _behind(end)[some], end[some]
                    held.append((np.where(a < 0, a, b), np.where(a < 0, b, a), a < 0))
                    size += len(a)
                if size >= AT_ONCE:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    found = train.mapInArrow(run, "w bigint, other bigint, first boolean, n bigint")
    one = found.join(others, "w", "left").select(_class_of("w", model.value).alias("c"), "other", "first", "n")
    one = stored(one.groupBy("c", "other", "first").agg(F.sum("n").alias("n")), "half-known")
    two = one.filter("other < 0").join(others.withColumnRenamed("w", "other"), "other", "left") \
             .select("c", _class_of("other", model.value).alias("other"), "first", "n")
    at = F.when(F.col("first"), F.col("c") * CLASSES + F.col("other")).otherwise(F.col("other") * CLASSES + F.col("c"))
    return one.filter("other >= 0").unionByName(two).select(at.alias("at"), "n")


def _class_of(word: str, model: Model) -> Column:
    """``class``, or that of the word's shape."""
    shapes = F.array(*[F.lit(int(c)) for c in model.classes[model.words:]])
    return F.coalesce("class", F.get(shapes, F.col(word).bitwiseAND(SHAPES - 1).cast("int"))).cast("long")


def _vocabulary(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, Column]:
    """Sorted hashes and counts of the words to broadcast, and which rows of
    ``counts`` they are: :data:`LEAST` occurrences, or as many more (in steps of
    a sixteenth of a power of two) as :data:`LOOKED_UP` words leave room for."""
    step = F.floor(F.log2("n") * 16)
    room, least = LOOKED_UP, None
    for r in counts.filter(F.col("n") >= LEAST).groupBy(step.alias("k")).agg(F.count(F.lit(1)).alias("v")) \
                   .orderBy(F.desc("k")).collect():  # some hundred rows
        if r["v"] > room:
            break
        room, least = room - r["v"], r["k"]
    chosen = F.col("w") == END
    if least is not None:
        chosen = chosen | (F.col("n") >= LEAST) & (step >= least)
    top = counts.filter(chosen).toArrow()
    hashes = top["w"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], top["n"].to_numpy()[order], chosen


def _bitmap(words: DataFrame) -> np.ndarray:
    """Bitmap of the words, of :data:`BITS` bits whatever their number."""
    bit = F.shiftrightunsigned("w", 8).bitwiseAND(BITS - 1)
    found = (words.select(bit.alias("bit")).groupBy(F.shiftright("bit", 5).alias("at"))
                  .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 31 as int)))").alias("v")).toPandas())
    out = np.zeros(BITS // 32, np.uint32)
    out[found["at"].to_numpy(np.int64)] = found["v"].to_numpy(np.int64).astype(np.uint32)
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Model, DataFrame]:
    """The model, and the distributed ``(w, n, class)`` of all words: their
    counts, and the classes of their own choice that aren't broadcast."""
    spark = docs.sparkSession
    src = id_and_text(docs, id_col, text_col)
    counts = stored(_count(src), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    hashes, n, chosen = _vocabulary(counts)
    words = len(hashes)
    shape = words + (hashes & np.uint64(SHAPES - 1)).astype(np.int64)
    kinds, tokens, mass = np.zeros(SHAPES), np.concatenate([n.astype(np.float64), np.zeros(SHAPES)]), np.zeros(SHAPES)
    several = False  # whether words with a class of their own choice aren't broadcast
    for r in counts.filter(~chosen).groupBy(F.col("w").bitwiseAND(SHAPES - 1).alias("s"), (F.col("n") >= LEAST).alias("own")) \
                   .agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).collect():  # 2 * SHAPES rows
        mass[r["s"]] += r["n"]
        several |= r["own"]
        if not r["own"]:
            kinds[r["s"]], tokens[words + r["s"]] = r["v"], r["n"]
    others = counts.filter(~chosen & (F.col("n") >= LEAST)).select("w")
    bits = _bitmap(others) if several else np.empty(0, np.uint32)
    classes = np.zeros(words + SHAPES, np.int16)
    pairs = np.zeros((CLASSES, CLASSES))
    frequent = np.concatenate([(n > total // FREQUENT) | (hashes == END), np.zeros(SHAPES, bool)])
    if total:
        # The rounds: begin with the units dealt out by falling frequency.
        first, few = np.flatnonzero(frequent), int(frequent.sum())
        mass += np.bincount(shape[~frequent[:words]] - words, n[~frequent[:words]], SHAPES)
        cls = np.empty(few + SHAPES, np.int64)
        cls[np.argsort(-np.concatenate([n[first], mass]), kind="stable")] = np.arange(few + SHAPES) % CLASSES
        cls, pairs = cluster(stored(_neighbours(src, _Shared(spark, hashes[first])), "neighbours"), cls)
        classes[words:] = cls[few:]
        classes[:words] = classes[shape]
        classes[first] = cls[:few]
    model = Model(Index(hashes), classes, tokens, kinds, pairs, int(total), int(distinct), bits)
    if several or words > frequent.sum():
        between = _between(src, _Shared(spark, model), _Shared(spark, frequent))
        moved = stored(_choose(between, pairs), "moved")
        here = moved.filter("u >= 0").toArrow()  # at most LOOKED_UP rows
        classes = classes.copy()
        classes[here["u"].to_numpy()] = here["class"].to_numpy()
        model = replace(model, classes=classes)
        others = stored(others.join(moved.withColumnRenamed("u", "w"), "w"), "others")
        model = replace(model, pairs=_recount(src, _Shared(spark, model), others))
    if several:
        return model, stored(counts.join(others, "w", "left"), "classed")
    return model, counts.withColumn("class", F.lit(None).cast("int"))


def score(docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``(id, n_tokens, n_known, base_score, score)``, the
    scores being log10 probabilities of the whole text."""
    src = id_and_text(docs, id_col, text_col)
    shared = _Shared(docs.sparkSession, model)

    def common(batches):
        m = shared.value
        for batch in batches:
            for ids, texts in text_rows([batch]):
                out = np.zeros((4, len(texts)))
                for at, x, bounds in token_arrays(texts):
                    u, n = m.look_up(x)
                    f = n >= 0
                    base = (np.maximum(n, 0) + 0.5) / m.norm
                    p = m.factors(u) * (n + m.added(u)) + (1 - LAMBDA) * base
                    whole = f & ~_behind(m.unsure(x, n))
                    out[0, at] = np.diff(bounds)
                    out[1:, at] = [np.add.reduceat(v, bounds[:-1]) for v in
                                   (f, np.where(f, np.log10(base), 0), np.where(whole, np.log10(np.where(whole, p, 1)), 0))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.column(0).type),
                     pa.array(_signed(np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64))),
                     pa.array(out[0].astype(np.int64)), pa.array(out[1].astype(np.int64)), pa.array(out[2]), pa.array(out[3])],
                    ["_id", "t", "n_tokens", "k", "b", "s"])

    def fresh(batches):
        """Tokens of texts not met before: each one's text, tokens, part."""
        seen, part = set(), TaskContext.get().partitionId()
        for batch in batches:
            for _, texts in text_rows([batch]):
                if len(seen) > MEMO_SIZE:
                    part += 1 << 20  # a text met again is told apart from before
                    seen.clear()
                keys = [xxhash.xxh3_64_intdigest(t) for t in texts]
                new = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
                keys = np.array(keys, np.uint64)[new]
                for at, x, bounds in token_arrays([texts[i] for i in new]):
                    yield _signed(np.repeat(keys[at], np.diff(bounds))), x, part

    def rare(batches):
        m = shared.value
        for t, x, part in fresh(batches):
            u, n = m.look_up(x)
            unsure = m.unsure(x, n)
            f = (n < 0) & ~unsure & ~_behind(unsure)
            yield pa.RecordBatch.from_arrays([pa.array(t[f]), pa.array(_signed(x[f])), pa.array(m.factors(u)[f]),
                                              pa.array(np.full(int(f.sum()), part))], ["t", "w", "f", "part"])

    def unsettled(batches):
        """Words that may have a class which isn't broadcast, with what stands
        before them (a class, or -1) and the token behind, if it is broadcast
        (its class, and its probability is ``g`` * the transition + ``h``); and,
        with ``hash`` of the word before, tokens behind such a word that aren't."""
        m = shared.value
        for t, x, part in fresh(batches):
            u, n = m.look_up(x)
            unsure = m.unsure(x, n)
            c = m.classes[u].astype(np.int64)
            behind = _behind(unsure)
            at, late = np.flatnonzero(unsure), np.flatnonzero((n < 0) & behind)
            after = (at + 1) % len(x)
            told = n[after] >= 0
            none = np.full(len(late), -1)
            cells = [np.concatenate(v) for v in (
                (t[at], t[late]), (_signed(x[at]), _signed(x[late])), (np.where(behind[at], -1, c[at - 1]), none),
                (np.where(told, c[after], -1), none),
                (np.where(told, m.weight[u[after]] * (n[after] + m.added(u[after])), 0), np.zeros(len(late))),
                (np.where(told, (1 - LAMBDA) * (n[after] + 0.5) / m.norm, 1), np.ones(len(late))))]
            hashes = np.concatenate([np.zeros(len(at), np.int64), _signed(x[late - 1])])
            yield pa.RecordBatch.from_arrays([*map(pa.array, cells), pa.array(hashes), pa.array(np.full(len(hashes), part))],
                                             ["t", "w", "before", "after", "g", "h", "hash", "part"])

    def settle(batches):
        m = shared.value
        for batch in batches:
            t, part, w, before, after, g, h = (c.to_numpy() for c in batch.columns[:7])
            n, own = (pa.compute.fill_null(c, x).to_numpy() for c, x in zip(batch.columns[7:], (0, -1)))
            unit = m.words + (w & (SHAPES - 1))
            c = np.where(own >= 0, own, m.classes[unit])
            share = np.where(own >= 0, n / np.maximum(m.sizes[c], 1e-9), m.weight[unit] * (n + 0.5))
            base = (n + 0.5) / m.norm
            known, told = before >= 0, after >= 0
            s = np.where(known, np.log10(m.trans[before, c] * share + (1 - LAMBDA) * base), 0)
            s += np.where(told, np.log10(m.trans[c, after] * g + h), 0)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (t, part, (known & (n > 0)).astype(np.int64),
                                                                    np.where(known, np.log10(base), 0), s)],
                                             ["t", "part", "rk", "rb", "rs"])

    def by_text(parts: DataFrame) -> DataFrame:
        sums = parts.groupBy("t", "part").agg(*[F.sum(c).alias(c) for c in ("rk", "rb", "rs")])
        # Several tasks may have met one text; each has summed it whole.
        return sums.groupBy("t").agg(*[F.max(c).alias(c) for c in ("rk", "rb", "rs")])

    rows = src.mapInArrow(common, f"_id {src.schema['_id'].dataType.simpleString()}, t bigint, n_tokens bigint, "
                                  "k bigint, b double, s double")
    tokens = src.mapInArrow(rare, "t bigint, w bigint, f double, part bigint").join(counts.select("w", "n"), "w", "left")
    n = F.coalesce("n", F.lit(0))
    base = (n + 0.5) / model.norm
    per_text = by_text(tokens.select("t", "part", F.when(n > 0, 1).otherwise(0).alias("rk"), F.log10(base).alias("rb"),
                                     F.log10(F.col("f") * (n + 0.5) + (1 - LAMBDA) * base).alias("rs")))
    if len(model.others):
        found = stored(src.mapInArrow(unsettled, "t bigint, w bigint, before bigint, after bigint, g double, h double, "
                                                 "hash bigint, part bigint"), "unsettled")
        classes = counts.filter("class is not null").select(F.col("w").alias("hash"), "class")
        late = found.filter("hash < 0").join(classes, "hash", "left").withColumn("before", _class_of("hash", model)).drop("class")
        both = found.filter("hash = 0").unionByName(late).join(counts, "w", "left") \
                    .select("t", "part", "w", "before", "after", "g", "h", "n", "class")
        settled_ = by_text(both.mapInArrow(settle, "t bigint, part bigint, rk bigint, rb double, rs double"))
        per_text = per_text.unionByName(settled_).groupBy("t").agg(*[F.sum(c).alias(c) for c in ("rk", "rb", "rs")])
    out = left_join_spread(rows, per_text, "t", "_id")
    plus: Column = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return out.select(F.col("_id").alias(id_col), "n_tokens", plus("k", "rk").alias("n_known"),
                      plus("b", "rb").alias("base_score"), plus("s", "rs").alias("score"))
