"""Secret scan: dictionary-primed zstandard novelty on top of base patterns.

Base spans are the matches of three patterns (assignments to sensitive names,
access key ids, long hexadecimal runs).  The method adds spans: every long
token with a letter and a sensitive word shortly before it, on its line or the
one before, is a candidate, and so are the tokens on the lines that go on from
it; its novelty is its marginal compressed size, i.e. the bytes that it adds
under a compressor primed with a dictionary of identifier parts and with the
text around it, further copies of it blanked out.  A name put together from known
parts adds few bytes, a key as many as it has; candidates that add
:data:`LEAST_SHARE` bytes a byte or more are reported as ``novel`` unless a base
span covers a part of them.  Base spans carry their novelty too.

The dictionary holds the parts of identifiers that code has everywhere
(:data:`COMMON`) and the most frequent parts in and around the candidates of
this corpus, at most :data:`DICT_WORDS` of them (the model's parameter), so it
is bounded and broadcast.  A part counts once for each different candidate it is
in, and once for each different text it stands near one in, so neither a copied
text nor a secret that is written many times becomes a part by itself.  Texts
are scanned where Spark reads them, in chunks of bounded bytes, and never
shuffled.

Edge cases: null or empty texts have no spans; offsets count code points, the
end is exclusive; a short match uses up its characters as any other and is then
dropped; repeated rows and extra columns don't matter; an empty table gives an
empty result, and without parts from the corpus the common ones and the text
around are the only context.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import _Shared
from .common import id_and_text, text_rows

# The base patterns and their least lengths, and what marks a
# context as sensitive.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"api")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # greedy: as long a run as there is, of 20 or more
HEX_LEAST = 24
HEX = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")
KINDS = ("assign", "access", "hex", "novel")
SENSITIVE = re.compile(r"password|passwd|secret|token|api[_\x20-]?key|credential|bearer|private[_\x20-]?key|access[_\x20-]?key|auth(?:orization)?\b",
                       re.IGNORECASE | re.ASCII)
SENSITIVE_WORDS = ASSIGN_WORDS + (b"credential", b"bearer", b"private", b"access", b"auth")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}")
REACH = 40            # code points before a candidate that may hold the sensitive word
AROUND = 256          # code points of context on each side
# Parts of identifiers; longer runs of one case are no words but may be keys.
PART = re.compile(r"(?<![A-Za-z])[a-z]{4,12}(?![a-z])|[A-Z][a-z]{3,11}(?![a-z])|(?<![A-Za-z])[A-Z]{4,12}(?![A-Za-z])")
DICT_WORDS = 2000
# Words that identifiers in code are made of.
COMMON = """
    access account action active address admin argument array attribute auth backup base batch buffer build cache
    callback category change channel check child class client close code column command common component config
    connect content context control count create credential current customer data database date debug default define
    delete document domain email enable entity entry error event example exception export factory feature fetch
    field file filter find format function generate global group handle handler header history host index info input
    insert instance interface internal item length level library limit line link list listener load local login
    logger manager message meta method metric model module monitor name network node notify number object offset
    option order output package page param parent parser password path payment permission plugin policy private
    process product profile project property provider public query queue reader record reference register report
    request reset resource response result role root rule schema search secret security select server service
    session setting size source stage start state static status storage store stream string support system table
    target task template test text thread time token tools transaction transfer type update user utils validate
    value version view worker wrapper writer
""".split()
LEAST_COPY = 16       # code points of a value that is blanked out where it stands again
LEAST_SHARE = 0.92    # marginal bytes per byte of an incompressible candidate: between names and keys

_HEX_MAP = bytes(ord("h") if c in b"0123456789abcdef" else 32 for c in range(256))
_HEX_RUN = b"h" * HEX_LEAST


def _sensitive(before: str) -> bool:
    """Whether the text before a token has a sensitive word on the token's line
    or on the last line before that isn't blank."""
    head, _, line = before.rpartition("\n")
    return bool(SENSITIVE.search(line) or SENSITIVE.search(head.rstrip().rpartition("\n")[2]))


def _candidates(text: str) -> list[tuple[int, int]]:
    """Tokens in a sensitive context, and those that follow one with nothing but
    white space and a line break between (the lines of a key's body)."""
    found, last = [], None
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        goes_on = last is not None and "\n" in (gap := text[last:min(s, last + REACH)]) and s - last < REACH and gap.isspace()
        if goes_on or _sensitive(text[max(0, s - REACH):s]):
            found.append((s, e))
            last = e
    return found


def _values(token: str) -> list[str]:
    """What a token holds that may stand elsewhere by itself."""
    return [p for p in token.split("=") if len(p) >= LEAST_COPY]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _may_hold(data: bytes) -> bool:
    """Whether a text can have spans at all; cheap, and never wrong about no."""
    low = data.lower()
    return any(w in low for w in SENSITIVE_WORDS) or b"AKIA" in data or _HEX_RUN in data.translate(_HEX_MAP)


# Stands before what is measured: bytes of every value, so that literals cost
# one byte each, behind a copy of the dictionary's end, so that every block is
# coded; without it, whether a few bytes are coded at all decides their cost.
_NOISE = bytes(random.Random(5).sample(range(256), 256))
_ECHO = bytes(random.Random(6).choices(range(256), k=64))


class Novelty:
    """Marginal compressed bytes under a dictionary of identifier parts, most
    frequent first, and of :data:`COMMON`."""

    def __init__(self, words: list[str]):
        # The last bytes of a dictionary are the cheapest to refer to.
        parts = COMMON + [w for w in reversed(words) if w not in COMMON]
        self.primer = " ".join([*map(str.upper, parts), *map(str.capitalize, parts), *parts]).encode()

    def marginal(self, text: str, start: int, end: int) -> int:
        inside = text[start:end]
        # Copies are looked for as far as one can reach into the context.
        before = text[max(0, start - AROUND - len(inside)):start]
        after = text[end:end + AROUND + len(inside)]
        for part in {inside, *_values(inside)}:
            before, after = (t.replace(part, " " * len(part)) for t in (before, after))
        known = self.primer + after[:AROUND].encode() + before[-AROUND:].encode() + _ECHO
        size = zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(
            known, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False).compress
        return len(size(_ECHO + _NOISE + inside.encode())) - len(size(_ECHO + _NOISE))

    def spans(self, text: str) -> list[tuple[int, int, int, int]]:
        """``(start, kind, end, novelty)``, base spans and novel ones, in order."""
        base = base_spans(text)
        found = [(s, k, e, self.marginal(text, s, e)) for s, k, e in base]
        for s, e in _candidates(text):
            if not any(s < b and a < e for a, _, b in base):
                new = self.marginal(text, s, e)
                if new >= LEAST_SHARE * (e - s):
                    found.append((s, 3, e, new))
        return sorted(found)


def identifiers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                most: int = DICT_WORDS) -> list[str]:
    """The most frequent identifier parts in and around candidates and base
    spans, lower-cased, most frequent first, at most ``most``; counted over all
    documents by the different tokens and texts that they are seen in."""
    src = id_and_text(docs, id_col, text_col)

    def run(batches):
        for batch in batches:
            for _, texts in text_rows([batch]):
                seen = set()
                for data in texts:
                    if not _may_hold(data):
                        continue
                    text, whole = data.decode(), xxhash.xxh3_64_intdigest(data)
                    for s, e in {*_candidates(text), *((s, e) for s, _, e in base_spans(text))}:
                        token = xxhash.xxh3_64_intdigest(text[s:e].encode())
                        for source, part in ((whole, text[max(0, s - AROUND):s]), (token, text[s:e]), (whole, text[e:e + AROUND])):
                            seen.update((w.lower(), source) for w in PART.findall(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in seen], pa.string()),
                     pa.array(np.array([s for _, s in seen], np.uint64).view(np.int64))], ["word", "source"])

    top = (src.mapInArrow(run, "word string, source bigint").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n"))
              .filter("n > 1").orderBy(F.desc("n"), "word").limit(most).collect())
    return [r["word"] for r in top]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         words: list[str] | None = None) -> DataFrame:
    """``(id, spans)`` per row: spans as ``struct<kind, start, end, novelty>``
    by start, then kind.  ``words`` primes the compressor (by default
    :func:`identifiers` of ``docs``)."""
    src = id_and_text(docs, id_col, text_col)
    shared = _Shared(docs.sparkSession, identifiers(docs, id_col, text_col) if words is None else words)
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.int32())])

    def run(batches):
        model = Novelty(shared.value)
        for batch in batches:
            for ids, texts in text_rows([batch]):
                out = [[{"kind": KINDS[k], "start": s, "end": e, "novelty": n}
                        for s, k, e, n in model.spans(t.decode())] if _may_hold(t) else [] for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.column(0).type), pa.array(out, pa.list_(span))], ["_id", "spans"])

    return src.mapInArrow(run, f"_id {src.schema['_id'].dataType.simpleString()}, "
                               "spans array<struct<kind: string, start: int, end: int, novelty: int>>") \
              .withColumnRenamed("_id", id_col)


def written(spans: Column) -> Column:
    """Spans as text: ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
