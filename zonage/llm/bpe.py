"""Byte-level BPE encoding and decoding by two-tier lookup.

Texts are split by the vocabulary's pattern; each match is encoded apart.
First tier: a minimal perfect hash over the vocabulary resolves a match that is
itself a token.  Second tier, for the rest: adjacent parts are merged in order
of rank from a heap over a doubly linked list of byte positions, n log n steps
for a match of n bytes.  A bounded memo holds the matches last met.

The vocabulary (bounded, read once by the driver from a path that is a
parameter) is broadcast; texts are encoded where Spark reads them, in chunks
of bounded bytes, and never shuffled.

Edge cases: null or empty texts have no ids and decode to no bytes; very long
texts are cut before white space that follows a non-space, where no match can
span; repeated rows and extra columns don't matter; an empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import id_and_text, release, text_rows

CHUNK_CHARS = 1 << 20
MEMO_BYTES = 80 << 20
ENTRY_BYTES = 220       # of two small objects and their place in the memo
# The same white space as in the pattern, so a cut there never splits a match.
_CUT = regex.compile(r"(?<=\S)\s")


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * len(pairs)
    for tok, rank in pairs:
        out[int(rank)] = base64.b64decode(tok)
    return out


class PerfectHash:
    """Minimal perfect hash of distinct byte strings: each bucket of keys has a
    seed under which its keys fall into slots of their own; buckets of one key
    name their slot outright (as ``-slot - 1``)."""

    def __init__(self, keys: list[bytes], load: int = 2):
        self.n = max(1, len(keys))
        self.m = max(1, len(keys) // load)
        self.seeds = [0] * self.m
        self.slots = [-1] * self.n
        buckets: dict[int, list[int]] = {}
        for i, k in enumerate(keys):
            buckets.setdefault(xxhash.xxh3_64_intdigest(k) % self.m, []).append(i)
        singles = []
        for b, members in sorted(buckets.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                singles.append((b, members[0]))
                continue
            seed = 1
            while True:
                at = {xxhash.xxh3_64_intdigest(keys[i], seed) % self.n for i in members}
                if len(at) == len(members) and all(self.slots[s] < 0 for s in at):
                    break
                seed += 1
            self.seeds[b] = seed
            for i in members:
                self.slots[xxhash.xxh3_64_intdigest(keys[i], seed) % self.n] = i
        free = (s for s, i in enumerate(self.slots) if i < 0)
        for b, i in singles:
            s = next(free)
            self.slots[s], self.seeds[b] = i, -s - 1
        self.keys = keys

    def get(self, key: bytes) -> int:
        """The key's index, or -1 for a string that is not among the keys."""
        seed = self.seeds[xxhash.xxh3_64_intdigest(key) % self.m]
        slot = -seed - 1 if seed < 0 else xxhash.xxh3_64_intdigest(key, seed) % self.n
        i = self.slots[slot]
        return i if i >= 0 and self.keys[i] == key else -1


class Codec(dict):
    """Encoder and decoder; as a dict, the bounded memo from a pattern match to
    its ids, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, index: PerfectHash, pattern: str):
        super().__init__()
        self.index, self.tokens, self.find = index, index.keys, regex.compile(pattern).findall
        self.ranks = {t: i for i, t in enumerate(index.keys)}  # of merged parts
        self.held = 0          # bytes in the memo

    def __missing__(self, match: str) -> bytes:
        data = match.encode()
        i = self.index.get(data)
        ids = [i] if i >= 0 else self.merge(data)
        packed = b"".join([x.to_bytes(4, "little") for x in ids])
        if len(data) <= 64:
            self[match] = packed
            self.held += ENTRY_BYTES + len(data) + len(packed)
        return packed

    def merge(self, data: bytes) -> list[int]:
        """Merge the lowest-ranked adjacent pair, leftmost first, until none is
        a token."""
        n, rank = len(data), self.ranks.get
        end = list(range(1, n + 1))    # of the part that starts here; 0: merged away
        before = list(range(-1, n))    # start of the part to the left
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue  # one of the two parts has changed since
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := rank(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if i and (r := rank(data[before[i]:stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        out, i = [], 0
        while i < n:
            t = rank(data[i:end[i]])
            if t is None:
                raise ValueError(f"byte {data[i]} is not in the vocabulary")
            out.append(t)
            i = end[i]
        return out

    def encode(self, text: str) -> bytes:
        if self.held > MEMO_BYTES:
            self.clear()
            self.held = 0
        return b"".join(map(self.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return decoded(self.tokens, ids)


def decoded(tokens: list[bytes], ids: bytes) -> bytes:
    return b"".join(map(tokens.__getitem__, memoryview(ids).cast("I")))


def sections(text: str) -> Iterator[str]:
    """``text`` in sections of at least :data:`CHUNK_CHARS` (but for the last),
    cut where no pattern match can span."""
    start = 0
    while len(text) - start > CHUNK_CHARS and (m := _CUT.search(text, start + CHUNK_CHARS)):
        yield text[start:m.start()]
        start = m.start()
    yield text[start:]


class _Shared:
    """A broadcast value with a name that workers can cache by."""

    def __init__(self, spark, value):
        self.bc = spark.sparkContext.broadcast(value)
        self.id = self.bc._jbroadcast.id()

    def __getstate__(self):
        return {"bc": self.bc, "id": self.id}

    @property
    def value(self):
        return self.bc.value


def _vocabulary(spark, path: str, pattern: str) -> _Shared:
    """The perfect hash, built once by the driver, and the pattern."""
    return _Shared(spark, (PerfectHash(read_ranks(path)), pattern))


def encode(docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(id, ids)`` per row: the token ids as little-endian unsigned 32-bit
    integers in one binary value."""
    return _encoded(docs, vocab_path, pattern, id_col, text_col, False)


def encode_and_decode(docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``(id, ids, decoded)`` per row: the token ids as :func:`encode` packs
    them, and the bytes that these decode to, in one pass of one worker."""
    return _encoded(docs, vocab_path, pattern, id_col, text_col, True)


def _encoded(docs: DataFrame, vocab_path: str, pattern: str, id_col: str, text_col: str, back: bool) -> DataFrame:
    src = id_and_text(docs, id_col, text_col)
    shared = _vocabulary(docs.sparkSession, vocab_path, pattern)

    def run(batches):
        codec = Codec(*shared.value)
        for batch in batches:
            for ids, texts in text_rows([batch]):
                packed = [b"".join(map(codec.encode, sections(t.decode()))) for t in texts]
                columns = {"_id": pa.array(ids, batch.column(0).type), "ids": pa.array(packed, pa.binary())}
                if back:
                    columns["decoded"] = pa.array([codec.decode(p) for p in packed], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)
        del codec  # a worker without tasks holds no memo
        release()

    kind = src.schema["_id"].dataType.simpleString()
    return src.mapInArrow(run, f"_id {kind}, ids binary" + ", decoded binary" * back).withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, vocab_path: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``(id, ids, decoded)``: ids as :func:`encode` packs them, and the bytes
    they stand for (null ids: no bytes)."""
    src = encoded.select(encoded[id_col].alias("_id"), encoded[ids_col].alias("_text"))
    shared = _Shared(encoded.sparkSession, read_ranks(vocab_path))
    schema = src.schema["_id"]

    def run(batches):
        tokens = shared.value
        for batch in batches:
            for ids, packed in text_rows([batch]):
                out = [decoded(tokens, p or b"") for p in packed]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.column(0).type), pa.array(packed, pa.binary()),
                     pa.array(out, pa.binary())], ["_id", "ids", "decoded"])

    return src.mapInArrow(run, f"_id {schema.dataType.simpleString()}, ids binary, decoded binary") \
              .withColumnRenamed("_id", id_col)
