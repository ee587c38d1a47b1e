"""Repeated-substring removal by merging shard Burrows-Wheeler transforms.

Every ``length``-byte window that also starts anywhere else in the corpus is
removed with all the bytes it covers.  The work narrows in three steps.

1. *Anchors.*  Each window has an anchor: the leftmost of its ``GRAM``-byte
   grams with the smallest hash.  Equal windows have equal anchors at equal
   offsets, so windows are compared within the groups of one anchor hash only.
   Consecutive windows of one anchor form a segment (``length`` to about twice
   that many bytes, one per 70 bytes of text).
2. *Segments.*  Segments that occur twice are repeated as a whole, segments
   whose anchor is unique hold no repeat; a count per segment and per anchor
   hash tells them apart without their bytes.  What repeats within a chunk of a
   task is settled there and sends one witness.
3. *Merge.*  The rest are segments that agree in part.  Their bytes are
   gathered by anchor hash and cut into shards.  Each shard gets a
   Burrows-Wheeler transform of its segments' rotations, whose symbols are the
   ``STEP`` bytes before a rotation.  The transforms are merged by iterative
   interleave refinement: from the order by the first ``k`` bytes, one stable
   counting sort of the shard-of-origin sequence by the merged symbols gives
   the order by the first ``k + STEP`` bytes, and the boundaries that appear
   give the common prefixes.  Suffixes of different shards are never compared.
   After ``length`` bytes, intervals without a boundary are repeated windows.

An anchor hash with more than :data:`HOT` segments isn't merged in one task:
its windows are counted by their 64-bit hashes in a distributed aggregate, an
exact way for groups of any size.  Hashes (64 bits) stand for grams, segments
and texts throughout.

Only narrow rows and the segments of step 3 are shuffled, and the texts of
documents that lose some bytes but not all.

Edge cases: null or empty texts, and texts shorter than ``length``, lose
nothing; a text with an equal copy (repeated rows included) loses everything if
it is long enough; texts are UTF-8 bytes, so what is kept need not be valid
UTF-8; very long texts are cut into overlapping pieces that together have
every window once; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import _Shared
from .common import id_and_text, stored, text_rows

LENGTH = 200
GRAM = 64
STEP = 8
PIECE = 1 << 15        # bytes of a text looked at together
CHUNK = 1 << 16        # bytes of several texts looked at together; they fit a core's cache
POSITION_BITS = 17
HOT = 8192             # segments of one anchor hash that are merged in one task
MERGE_BYTES = 96 << 10  # bytes merged together, more only for one anchor hash
SHARDS = 4
BITS = 1 << 26         # of a bitmap of hashes, whatever their number
SEEN = 200_000
def signed(x: int) -> int:
    return x - (x >> 63 << 64)


def gram_hashes(data: bytes) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at every position: of the eight bytes there,
    then by doubling."""
    h = np.empty(len(data) - 7, np.uint64)
    for o in range(8):
        part = np.frombuffer(data, "<u8", (len(data) - o) // 8, o)
        h[o::8] = part[:len(h[o::8])]
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(29)
    k = 8
    while k < GRAM:
        a = h[:-k] * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        a ^= a >> np.uint64(31)
        a += h[k:]
        h = a
        k *= 2
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    k = 1
    while 2 * k <= width:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[:len(x) - (width - k)], x[width - k:]) if width > k else x


def anchors(texts: list[bytes], length: int = LENGTH):
    """``(text, lo, at, hi, hash)`` arrays and the joined bytes with each text's
    start: windows ``lo..hi`` of a text (offsets in it) have the anchor ``at``.
    The texts have ``length`` bytes at least, and :data:`CHUNK` together or are
    one piece."""
    data = b"".join(texts)
    starts = np.cumsum([0] + [len(t) for t in texts])
    h = gram_hashes(data)
    mask = np.uint64((1 << POSITION_BITS) - 1)
    key = h & ~mask
    key |= np.arange(len(h), dtype=np.uint64)
    key = _window_min(key, length - GRAM + 1)
    ts, los, ats, his = [], [], [], []
    for t, s in enumerate(starts[:-1].tolist()):
        own = key[s:starts[t + 1] - length + 1]  # a key names its anchor's place
        first = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
        ts.append(np.full(len(first), t))
        los.append(first)
        ats.append((own[first] & mask).astype(np.int64) - s)
        his.append(np.concatenate([first[1:], [len(own)]]) - 1)
    t, at = np.concatenate(ts), np.concatenate(ats)
    return t, np.concatenate(los), at, np.concatenate(his), h[starts[t] + at], data, starts


def pieces(texts: list[tuple], length: int = LENGTH):
    """Chunks of ``(key, offset, bytes)`` pieces that have every window of every
    text once, of bounded bytes each."""
    chunk, size = [], 0
    for key, text in texts:
        at = 0
        while len(text) - at >= length:
            part = text[at:at + PIECE + length - 1]
            if chunk and size + len(part) > CHUNK:
                yield chunk
                chunk, size = [], 0
            chunk.append((key, at, part))
            size += len(part)
            at += PIECE
    if chunk:
        yield chunk


class _Fresh(set):
    """Keys met by a task, bounded; forgetting one only repeats work."""

    def new(self, key) -> bool:
        if key in self:
            return False
        if len(self) > SEEN:
            self.clear()
        self.add(key)
        return True


def _segments(chunk: list[tuple], length: int):
    """Of a chunk of pieces: arrays ``(piece, lo, at, hi, h, g)``, ``g`` being
    the segment's hash with its anchor's offset."""
    t, lo, at, hi, h, data, starts = anchors([x for _, _, x in chunk], length)
    begin, end = (starts[t] + lo).tolist(), (starts[t] + hi + length).tolist()
    digest = xxhash.xxh3_64_intdigest
    g = np.fromiter((digest(data[b:e], o) for b, e, o in zip(begin, end, (at - lo).tolist())), np.uint64, len(t))
    return t, lo, at, hi, h, g


def _describe(src: DataFrame, length: int) -> DataFrame:
    """One pass over the texts.  ``kind`` 0: a document (``id``, text key ``t``,
    ``n`` bytes, ``sha`` of the whole text); 1: a segment (``t``, ``h``, ``g``,
    ``n``: first window, offset of the anchor and number of windows, packed; 0
    for a witness); 2: a repeated span (``t``, ``h`` and ``g``: start, end)."""
    id_type = src.schema["_id"].dataType.simpleString()
    names = ["kind", "_id", "t", "n", "h", "g", "sha"]

    def run(batches):
        fresh = _Fresh()
        for batch in batches:
            for ids, texts in text_rows([batch]):
                keys = [xxhash.xxh3_64_intdigest(x) for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0] * len(ids), pa.int8()), pa.array(ids, batch.column(0).type),
                     pa.array([signed(k) for k in keys], pa.int64()), pa.array([len(x) for x in texts], pa.int64()),
                     pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in texts])], names)
                todo = [(k, x) for k, x in zip(keys, texts) if len(x) >= length and fresh.new(k)]
                parts = []
                for chunk in pieces(todo, length):
                    t, lo, at, hi, h, g = _segments(chunk, length)
                    offset = np.array([o for _, o, _ in chunk])[t]
                    parts.append((np.array([k for k, _, _ in chunk], np.uint64)[t].view(np.int64),
                                  lo + offset, at - lo, hi + offset, h, g))
                if not parts:
                    continue
                # What repeats among these texts is settled here.
                key, lo, off, hi, h, g = (np.concatenate(c) for c in zip(*parts))
                _, first, of, times = np.unique(h * np.uint64(0x9E3779B97F4A7C15) ^ g, return_index=True,
                                                return_inverse=True, return_counts=True)
                again = times[of.ravel()] > 1
                alone, witness = np.flatnonzero(~again), first[times > 1]
                n = int(again.sum())
                packed = lo << 16 | off << 8 | (hi - lo + 1)
                kind = np.concatenate([np.ones(len(alone) + len(witness), np.int8), np.full(n, 2, np.int8)])
                h, g = h.view(np.int64), g.view(np.int64)
                cols = [np.concatenate([key[alone], key[witness], key[again]]),
                        np.concatenate([packed[alone], np.zeros(len(witness) + n, np.int64)]),
                        np.concatenate([h[alone], h[witness], lo[again]]),
                        np.concatenate([g[alone], g[witness], hi[again] + length])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind), pa.nulls(len(kind), batch.column(0).type), *map(pa.array, cols),
                     pa.nulls(len(kind), pa.string())], names)

    return src.mapInArrow(run, f"kind tinyint, _id {id_type}, t bigint, n bigint, h bigint, g bigint, sha string")


def bitmap(df: DataFrame, column: str) -> np.ndarray:
    """Bitmap of a column's hashes: :data:`BITS` bits, whatever their number."""
    bits = df.select(F.pmod(column, F.lit(BITS)).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("w")) \
                .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("v")).toPandas()
    out = np.zeros(BITS // 64, np.int64)
    out[words["w"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64)
    return out.view(np.uint64)


def _has(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    b = x.astype(np.uint64) & np.uint64(BITS - 1)  # pmod of the signed value by a power of two
    return (bits[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63))) & np.uint64(1) > 0


def _gather(src: DataFrame, wanted: _Shared, length: int) -> DataFrame:
    """``(h, g, data)``: bytes of the segments whose anchor hash is wanted."""

    def run(batches):
        fresh, sent, bits = _Fresh(), _Fresh(), wanted.value
        for batch in batches:
            for _, texts in text_rows([batch]):
                todo = [(k, x) for x in texts if len(x) >= length and fresh.new(k := xxhash.xxh3_64_intdigest(x))]
                for chunk in pieces(todo, length):
                    t, lo, at, hi, h, data, starts = anchors([x for _, _, x in chunk], length)
                    rows = []
                    for i in np.flatnonzero(_has(bits, h)).tolist():
                        seg = data[starts[t[i]] + lo[i]:starts[t[i]] + hi[i] + length]
                        g = xxhash.xxh3_64_intdigest(seg, int(at[i] - lo[i]))
                        if sent.new((int(h[i]), g)):
                            rows.append((signed(int(h[i])), signed(g), seg))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x for x, _, _ in rows], pa.int64()), pa.array([x for _, x, _ in rows], pa.int64()),
                         pa.array([x for _, _, x in rows], pa.binary())], ["h", "g", "data"])

    return src.mapInArrow(run, "h bigint, g bigint, data binary")


def stable_order(x: np.ndarray) -> np.ndarray:
    """Stable counting sort of codes below 2**32, 16 bits at a time."""
    order = np.argsort((x & 0xFFFF).astype(np.uint16), kind="stable")
    if len(x) and int(x.max()) > 0xFFFF:
        order = order[np.argsort((x[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def _rotations(segments: list[bytes]):
    """Of joined segments: each position's code of the next ``STEP`` bytes (in
    their order, cyclic per segment) and its segment's start and size."""
    sizes = np.array([len(x) for x in segments])
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    size = np.repeat(sizes, sizes)
    data = np.frombuffer(b"".join(segments), np.uint8).astype(np.uint64)
    at = np.arange(len(data)) - starts
    word = data
    for k in (1, 2, 4):
        word = (word << np.uint64(8 * k)) | word[starts + (at + k) % size]
    _, code = np.unique(word, return_inverse=True)
    return code.ravel().astype(np.int64), starts, size, at


def transform(code: np.ndarray, starts: np.ndarray, size: np.ndarray, at: np.ndarray, length: int):
    """A shard's rotations in order by ``length`` bytes at least, by doubling
    (positions in the joined segments), and its transform: the code of the
    ``STEP`` bytes before each."""
    rank, k = code, STEP
    while True:
        order = np.argsort(rank, kind="stable")
        if k >= length:
            break
        step = rank[starts + (at + k) % size]
        order = order if k >= length else np.lexsort((step, rank))
        new = np.ones(len(order), np.int64)
        new[0] = 0
        new[1:] = (rank[order][1:] != rank[order][:-1]) | (step[order][1:] != step[order][:-1])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        k *= 2
    return order, code[(starts + (at - STEP) % size)[order]]


def merge(transforms: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge the shards' transforms by interleave refinement.  Returns the
    interleave (shard of each merged suffix) and whether each begins an
    interval of equal ``length``-byte prefixes."""
    z = np.repeat(np.arange(len(transforms), dtype=np.uint8), [len(x) for x in transforms])
    by_shard = np.concatenate(transforms)
    begins = np.zeros(len(z), bool)
    begins[:1] = True
    for _ in range(length // STEP):
        symbols = np.empty(len(z), np.int64)
        symbols[np.argsort(z, kind="stable")] = by_shard
        order = stable_order(symbols)
        block = np.cumsum(begins)[order]  # of the order so far
        symbols, z = symbols[order], z[order]
        begins = np.ones(len(z), bool)
        begins[1:] = (symbols[1:] != symbols[:-1]) | (block[1:] != block[:-1])
    return z, begins


def repeated_windows(segments: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per segment, which of its windows occur more than once among all
    segments, themselves included."""
    code, starts, size, at = _rotations(segments)
    bounds = np.cumsum([0] + [len(x) for x in segments])
    cuts = sorted({int(np.searchsorted(bounds, len(code) * k // SHARDS)) for k in range(SHARDS + 1)})
    orders, transforms = [], []
    for a, b in zip(cuts, cuts[1:]):
        p = slice(bounds[a], bounds[b])
        order, bwt = transform(code[p], starts[p] - bounds[a], size[p], at[p], length)
        orders.append(order + bounds[a])
        transforms.append(bwt)
    z, begins = merge(transforms, length)
    suffix = np.empty(len(z), np.int64)
    suffix[np.argsort(z, kind="stable")] = np.concatenate(orders)
    real = at[suffix] + length <= size[suffix]  # the other rotations wrap around
    block = np.cumsum(begins) - 1
    times = np.bincount(block, real, minlength=1)
    flags = np.zeros(len(code), bool)
    flags[suffix[real & (times[block] > 1)]] = True
    return [flags[a:b - length + 1] for a, b in zip(bounds, bounds[1:])]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _merged(segments: DataFrame, length: int) -> DataFrame:
    """``(h, g, a, b, w)``: runs of repeated windows of each segment (``w``
    null), and for hot anchor hashes the hash ``w`` of each window ``a``."""
    rows = segments.repartition("h").sortWithinPartitions("h", "g")
    names = ["h", "g", "a", "b", "w"]

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*out) if out else [[]] * 5)], names)

    def settle(held):
        out = []
        for (h, g, _), flags in zip(held, repeated_windows([d for *_, d in held], length)):
            out += [(h, g, a, b, None) for a, b in _runs(flags)]
        return batch_of(out)

    def spread(held):
        # Windows that repeat among these are settled; one row stands for them.
        rows = [(h, g, i, i + 1, signed(xxhash.xxh3_64_intdigest(d[i:i + length])))
                for h, g, d in held for i in range(len(d) - length + 1)]
        _, first, of, times = np.unique([r[4] for r in rows], return_index=True, return_inverse=True, return_counts=True)
        again = times[of.ravel()] > 1
        stands = np.zeros(len(rows), bool)
        stands[first] = True
        out = [r for r, s in zip(rows, stands.tolist()) if s]
        flags: dict = {}
        for r, x in zip(rows, again.tolist()):
            if x:
                flags.setdefault(r[:2], []).append(r[2])
        for (h, g), at in flags.items():
            hit = np.zeros(max(at) + 1, bool)
            hit[at] = True
            out += [(h, g, a, b, None) for a, b in _runs(hit)]
        return batch_of(out)

    def run(batches):
        done, done_size, group, hot, last = [], 0, [], False, None  # done: whole groups; group: the running one
        for batch in batches:
            for h, g, d in zip(*(c.to_pylist() for c in batch.columns)):
                if last is not None and (h, g) == last:
                    continue
                if last is not None and h != last[0]:
                    if hot:
                        yield spread(group)
                    else:
                        done += group
                        done_size += sum(len(x) for *_, x in group)
                    group, hot = [], False
                    if done_size >= MERGE_BYTES:
                        yield settle(done)
                        done, done_size = [], 0
                last = (h, g)
                group.append((h, g, d))
                if len(group) > HOT or hot and len(group) >= min(HOT, 1024):
                    yield spread(group)
                    group, hot = [], True
        if hot:
            yield spread(group)
        else:
            done += group
        if done:
            yield settle(done)

    return rows.mapInArrow(run, ", ".join(f"{x} bigint" for x in names))


def repeated_spans(described: DataFrame, src: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(t, a, b)``: spans of byte offsets of text ``t`` that repeated windows
    cover.  Texts with an equal copy are left to the caller."""
    spark = src.sparkSession
    known = described.filter("kind = 2").select("t", F.col("h").alias("a"), F.col("g").alias("b"))
    by_pair = Window.partitionBy("h", "g")
    rows = described.filter("kind = 1").select("t", "n", "h", "g").repartition("h") \
        .withColumn("same", F.count(F.lit(1)).over(by_pair)) \
        .withColumn("all", F.count(F.lit(1)).over(Window.partitionBy("h"))) \
        .filter("all > 1 and n <> 0")
    first = F.shiftright("n", 16)
    windows = F.col("n").bitwiseAND(255)
    rows = stored(rows.select("t", "h", "g", (F.col("same") > 1).alias("whole"), first.alias("lo"), windows.alias("k")),
                  "segments")
    whole = rows.filter("whole").select("t", F.col("lo").alias("a"), (F.col("lo") + F.col("k") + length - 1).alias("b"))
    partly = rows.filter("not whole")
    wanted = _Shared(spark, bitmap(partly, "h"))
    merged = stored(_merged(_gather(src, wanted, length), length), "merged")
    many = merged.filter("w is not null")
    twice = many.groupBy("w").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("w")
    runs = merged.filter("w is null").select("h", "g", "a", "b") \
        .unionByName(many.join(twice, "w").select("h", "g", "a", "b"))
    found = partly.join(runs, ["h", "g"]) \
        .select("t", (F.col("lo") + F.col("a")).alias("a"), (F.col("lo") + F.col("b") + length - 1).alias("b"))
    return known.unionByName(whole).unionByName(found)


def _union(pairs) -> list[tuple[int, int]]:
    """Maximal runs covered by spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: ``(id, n_bytes, spans, kept_sha256, kept)``: the
    maximal removed runs of bytes, the SHA-256 of what remains, and what
    remains (null: nothing is removed)."""
    if not GRAM <= length <= 255 or length % STEP:
        raise ValueError(f"length must be a multiple of {STEP} from {GRAM} to 255")
    spark = docs.sparkSession
    src = id_and_text(docs, id_col, text_col)
    described = stored(_describe(src, length), "described")
    texts = described.filter("kind = 0").select("_id", "t", "n", "sha")
    copied = stored(texts.groupBy("t").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("t"), "copied")
    spans = repeated_spans(described, src, length).join(copied, "t", "left_anti")
    spans = stored(spans.groupBy("t").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "spans")
    wanted = _Shared(spark, bitmap(spans, "t"))

    def pick(batches):
        bits, fresh = wanted.value, _Fresh()
        for batch in batches:
            for _, raw in text_rows([batch]):
                keys = np.array([xxhash.xxh3_64_intdigest(x) for x in raw], np.uint64)
                got = [i for i in np.flatnonzero(_has(bits, keys)).tolist() if fresh.new(int(keys[i]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([signed(int(keys[i])) for i in got], pa.int64()), pa.array([raw[i] for i in got], pa.binary())],
                    ["t", "data"])

    def cut(batches):
        for batch in batches:
            out = []
            for data, pairs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                runs = _union((p["a"], p["b"]) for p in pairs)
                kept = b"".join(data[b:a] for (_, b), (a, _) in zip([(0, 0), *runs], [*runs, (len(data), 0)]))
                out.append((runs, kept, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[{"a": a, "b": b} for a, b in r] for r, _, _ in out], batch.schema.field(2).type),
                 pa.array([k for _, k, _ in out], pa.binary()), pa.array([s for _, _, s in out])],
                ["t", "spans", "kept", "kept_sha256"])

    chosen = src.mapInArrow(pick, "t bigint, data binary").join(spans, "t").select("t", "data", "spans")
    some = stored(chosen.mapInArrow(cut, "t bigint, spans array<struct<a: bigint, b: bigint>>, kept binary, kept_sha256 string"),
                  "cut")
    nothing = F.array().cast("array<struct<a: bigint, b: bigint>>")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n").alias("b")))
    gone = F.col("copy") & (F.col("n") >= length)
    return (texts.join(copied.withColumn("copy", F.lit(True)), "t", "left").withColumn("copy", F.coalesce("copy", F.lit(False)))
                 .join(some.dropDuplicates(["t"]), "t", "left")
                 .select(F.col("_id").alias(id_col), F.col("n").alias("n_bytes"),
                         F.when(gone, everything).otherwise(F.coalesce("spans", nothing)).alias("spans"),
                         F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
                         F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept")))
