"""Token counts by a sentence-piece model: Arrow batches in, lengths out.

Chunks of bounded bytes are cut into segments at places no piece can span: a
run of spaces opens a segment, since no piece holds a space after another
character (checked against the model), and inside a long segment a cut lies
between two characters that no piece holds side by side.  The library encodes
each distinct segment of a chunk once, in one batch call; a bounded memo keeps
the lengths last met, and a text's count is the sum over its segments.

The model (bounded, read once by the driver from a path that is a parameter)
is broadcast; texts are never shuffled and only lengths leave the task.

Edge cases: null or empty texts have no tokens and no bytes; repeated rows and
extra columns don't matter; an empty table gives an empty result.  Models that
normalise texts, or whose pieces hold inner spaces, are encoded text by text.
"""

from __future__ import annotations

import re

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .bpe import _Shared
from .common import id_and_text, text_rows

MEMO_SIZE = 200_000
LONG_SEGMENT = 256
_SEGMENT = re.compile(" *[^ ]+| +")
SPACE = "▁"  # fixed value: how the library writes a space


class Counter(dict):
    """Memo from a segment, first space included, to its number of tokens."""

    def __init__(self, model: bytes):
        super().__init__()
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.sp.get_piece_size()
        pieces = [self.sp.id_to_piece(i) for i in range(n)
                  if not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_byte(i))]
        self.pairs = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}
        probe = "a  Ａ\tΩ b "
        same = self.sp.normalize(probe) == SPACE + probe.replace(" ", SPACE)
        self.whole = not same or any(SPACE in p.lstrip(SPACE) for p in pieces)

    def lengths(self, parts: list[str]) -> list[int]:
        return [len(x) for x in self.sp.encode(parts, num_threads=1)]

    def learn(self, segments: set[str]) -> None:
        """Count segments that are not in the memo yet.  The library puts one
        space before what it encodes, which stands for a segment's first."""
        if len(self) > MEMO_SIZE:
            self.clear()
        new = [s for s in segments if s not in self]
        words = [s for s in new if s.strip(" ")]
        self.update(zip(words, self.lengths([s[1:] for s in words])))
        for s in new:  # a text's trailing spaces: what they add to a letter
            if s not in self:
                self[s] = len(self.sp.encode("a" + s)) - len(self.sp.encode("a"))

    def cut(self, segment: str) -> tuple[str, list[str]]:
        """A long segment's opening part, and its other parts, cut where no
        piece holds both neighbours."""
        at = [i for i in range(1, len(segment))
              if segment[i - 1:i + 1].replace(" ", SPACE) not in self.pairs and segment[i - 1] != " "]
        ends = [0, *at, len(segment)]
        parts = [segment[a:b] for a, b in zip(ends, ends[1:])]
        return parts[0], parts[1:]

    def inner(self, parts: list[str]) -> int:
        """Tokens of parts that follow other characters: what each adds behind
        a line break, which no piece holds."""
        lead = len(self.sp.encode("\n"))
        return sum(self.lengths(["\n" + p for p in parts])) - lead * len(parts)

    def counts(self, texts: list[str]) -> list[int]:
        if self.whole:
            return self.lengths(texts)
        split = [_SEGMENT.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        extra = [0] * len(texts)
        for k, segs in enumerate(split):
            for j, s in enumerate(segs):
                if len(s) > LONG_SEGMENT and s.strip(" "):
                    segs[j], rest = self.cut(s)
                    extra[k] += self.inner(rest)
        self.learn(set().union(*split))
        get = self.__getitem__
        return [sum(map(get, segs)) + x for segs, x in zip(split, extra)]


_counters: dict[int, Counter] = {}


def _counter(shared) -> Counter:
    if shared.id not in _counters:
        _counters.clear()
        _counters[shared.id] = Counter(shared.value)
    return _counters[shared.id]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens)`` per row, without begin, end or other special
    tokens."""
    src = id_and_text(docs, id_col, text_col)
    with open(model_path, "rb") as f:
        shared = _Shared(docs.sparkSession, f.read())
    schema = src.schema["_id"]

    def run(batches):
        counter = _counter(shared)
        for batch in batches:
            for ids, texts in text_rows([batch]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.column(0).type), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(counter.counts([t.decode() for t in texts]), pa.int64())],
                    ["_id", "n_bytes", "n_tokens"])

    return src.mapInArrow(run, f"_id {schema.dataType.simpleString()}, n_bytes bigint, n_tokens bigint") \
              .withColumnRenamed("_id", id_col)
