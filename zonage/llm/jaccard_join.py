"""Set-similarity join on word shingles (Jaccard >= 4/5) with set relations.

*Sets.*  A text's words give its distinct five-word shingles as 64-bit hashes.
Texts with equal sets share one set id, so copies are joined once; the id and
the shingles are 64-bit hashes, and what follows is exact on them.

*Index.*  Shingles are ordered globally: those that many sets hold come last
(their number is bounded, see :data:`FREQUENT`), the rest by hash.  A set is
listed under its first ``n // 5 + 1`` shingles; two similar sets always meet in
the list of their first common shingle.  Each entry has the set's size and the
shingle's position, and blocks of entries that these rule out are skipped.

*Sketches.*  A set's sketch, a count per range of hashes, is 1/20 of its size;
pairs whose sketches bound their intersection too low are dropped before whole
sets are fetched.

*Answers from a similar set.*  Lists are never compared pairwise.  In a first
round each list is compared to one pivot; entries similar to the pivot take
over its component.  Later rounds look only at lists that still hold several
components, take an entry of the largest component as pivot while that merges
components, then entries of the smaller ones (more each round), and skip an
entry if the two sets' known similarities to the first
pivot rule the pair out: the Jaccard distance is a metric, so two distances to
one pivot that differ by more than 1/5 exclude a link.  Compared pivots leave
the list; the join ends when no list holds two components.  The result is the
components of all links, as no pair across components is left unchecked.

*Hot lists.*  Lists of frequent shingles are salted by set id in the first
round; group values travel back by salted keys; and the sets of hot pivots are
replicated per salt.  Every table is distributed and stored in the shared
folder between rounds; the driver sees counts, the bounded list of frequent
shingles and bounded bitmaps only.

Edge cases: null or empty texts (and texts of white space) have no shingles,
link with nothing and are components of their own; texts of fewer words are one
shingle; a null id never names a component that has another id; repeated rows
and ties don't matter, as sets are compared and the smallest id names a
component; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import _Shared
from .common import id_and_text, settled, stored, text_digest, text_rows, unused, without
from .wordhash import SECTION, mix, sections, word_hashes

WIDTH = 5
# At most so many shingles count as frequent: those held by at least
# (number of shingles) / FREQUENT sets.
FREQUENT = 1 << 20
LEAST_FREQUENT = 32
COUNT_AT_ONCE = 1 << 21   # shingles whose repeats are counted together in a task
MEMO_SIZE = 200_000
SALTS = 16
RARE_BITS, POS_BITS = 12, 25
BITS = 1 << 24            # of the bitmap of wanted sets
MERGE_ROUNDS = 1         # at most, before the rounds of several pivots
PIVOTS = (16, 64, 256, 1024, 4096)

_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list = [None] * len(texts)
    short, size = [], 0

    def settle():
        # Texts are hashed together; a space between them ends their last words.
        hashes, starts, _ = word_hashes(np.frombuffer(b" ".join(texts[i] for i in short).lower(), np.uint8))
        bounds = np.searchsorted(starts, np.cumsum([0] + [len(texts[i]) + 1 for i in short]))
        for i, a, b in zip(short, bounds, bounds[1:]):
            out[i] = _shingles(hashes[a:b])

    for i, t in enumerate(texts):
        if len(t) > SECTION:
            out[i] = _shingles(np.concatenate([word_hashes(np.frombuffer(x.lower(), np.uint8))[0] for x in sections(t)]))
            continue
        if short and size + len(t) > SECTION:
            settle()
            short, size = [], 0
        short.append(i)
        size += len(t)
    if short:
        settle()
    return out


def _shingles(words: np.ndarray) -> np.ndarray:
    if not len(words):
        return np.empty(0, np.uint64)
    n = max(1, len(words) - WIDTH + 1)
    s = np.full(n, len(words) if len(words) < WIDTH else 0, np.uint64)
    for k in range(min(WIDTH, len(words))):
        s += words[k:k + n] * _MUL[k]
    return np.unique(mix(s))


def sketch(shingles: np.ndarray) -> bytes | None:
    """How many shingles fall into each of 2**k ranges of hashes, about three a
    range.  Summed minima of two sketches bound the sets' intersection from
    above (null: no bound)."""
    k = max(2, int(len(shingles) // 2).bit_length() - 1)
    counts = np.bincount((shingles >> np.uint64(64 - k)).astype(np.int64), minlength=1 << k)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def may_link(n: int, x: bytes | None, m: int, y: bytes | None) -> bool:
    """Whether the sketches of sets of sizes ``n`` and ``m`` leave a link possible."""
    if x is None or y is None:
        return True
    u, v = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    k = min(len(u), len(v))
    return 9 * int(np.minimum(u.reshape(k, -1).sum(1), v.reshape(k, -1).sum(1)).sum()) >= 4 * (n + m)


def set_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes())


def _signed(x) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


class _Seen(set):
    """Set ids met by a task, bounded; forgetting one only repeats work."""

    def new(self, sid: int) -> bool:
        if sid in self:
            return False
        if len(self) > MEMO_SIZE:
            self.clear()
        self.add(sid)
        return True


def _describe(src: DataFrame) -> DataFrame:
    """Rows ``(_id, n, sid, sketch)`` per document (the sketch once per set and
    task) and ``(token, hits)`` per shingle that repeats within a task."""
    id_type = src.schema["_id"].dataType.simpleString()
    names = ["_id", "n", "sid", "sketch", "token", "hits"]

    def run(batches):
        seen, held, size = _Seen(), [], 0

        def repeats(id_arrow):
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= 4
            t, c = tokens[often], counts[often]
            empty = (pa.nulls(len(t), x) for x in (id_arrow, pa.int64(), pa.int64(), pa.binary()))
            return pa.RecordBatch.from_arrays([*empty, pa.array(_signed(t)), pa.array(c.astype(np.int64))], names)

        for batch in batches:
            for ids, texts in text_rows([batch]):
                sets = shingle_sets(texts)
                sids, sketches = [], []
                for s in sets:
                    sid = set_id(s) if len(s) else None
                    fresh = sid is not None and seen.new(sid)
                    sids.append(None if sid is None else sid - (sid >> 63 << 64))
                    sketches.append(sketch(s) if fresh else None)
                    if fresh:
                        held.append(s)
                        size += len(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.column(0).type), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(sids, pa.int64()), pa.array(sketches, pa.binary()), pa.nulls(len(ids), pa.int64()),
                     pa.nulls(len(ids), pa.int64())], names)
                if size >= COUNT_AT_ONCE:
                    yield repeats(batch.column(0).type)
                    held, size = [], 0
        if held:
            yield repeats(batch.column(0).type)

    return src.mapInArrow(run, f"_id {id_type}, n bigint, sid bigint, sketch binary, token bigint, hits bigint")


def _frequent(described: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and the logarithm of their counts.  At most
    :data:`FREQUENT`, since counts add up to the number of shingles at most."""
    total = described.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_FREQUENT, total // FREQUENT + 1)
    found = (described.filter("token is not null").groupBy("token").agg(F.sum("hits").alias("hits"))
                      .filter(F.col("hits") >= least).toPandas())
    tokens = found["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.log2(found["hits"].to_numpy(np.float64)).astype(np.uint8)[order]


def _index(src: DataFrame, frequent: _Shared) -> DataFrame:
    """``(token, sid, np)``: entries of each set's prefix; ``np`` packs the
    set's size, how many of its prefix's shingles aren't frequent, and the
    position (:func:`_unpacked`), negative under a frequent shingle."""

    def run(batches):
        seen = _Seen()
        tokens, levels = frequent.value
        for batch in batches:
            for _, texts in text_rows([batch]):
                ts, ss, nps = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
                for s in shingle_sets(texts):
                    if not len(s) or not seen.new(sid := set_id(s)):
                        continue
                    often = np.zeros(len(s), np.uint8)
                    if len(tokens):
                        at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                        often = np.where(tokens[at] == s, levels[at], 0).astype(np.uint8)
                    first = np.argsort(often, kind="stable")[:len(s) // 5 + 1]
                    ts.append(s[first])
                    ss.append(np.full(len(first), sid, np.uint64))
                    rare = min(int((often[first] == 0).sum()), (1 << RARE_BITS) - 1)
                    packed = np.int64(len(s) << (RARE_BITS + POS_BITS) | rare << POS_BITS) + np.arange(len(first))
                    nps.append(np.where(often[first] > 0, -packed, packed))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(np.concatenate(ts))), pa.array(_signed(np.concatenate(ss))),
                     pa.array(np.concatenate(nps))], ["token", "sid", "np"])

    return src.mapInArrow(run, "token bigint, sid bigint, np bigint")


def _unpacked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size, rare shingles of the prefix, position."""
    x = np.abs(x)
    return x >> (RARE_BITS + POS_BITS), x >> POS_BITS & ((1 << RARE_BITS) - 1), x & ((1 << POS_BITS) - 1)


def _lists(index: DataFrame) -> DataFrame:
    """Lists of two entries or more, each entry with its list's pivot (the
    set with the fewest rare shingles, as it is the likeliest to be similar to
    the others): ``(token, sid, n, rare, pos, pivot, pn, ppos, more)``; ``more``
    is 0 if the list surely has no third entry.  A streaming pass over sorted
    entries; only the running list's pivot is held."""
    salt = F.when(F.col("np") < 0, F.pmod("sid", F.lit(SALTS))).otherwise(F.lit(0))
    rare = F.shiftright(F.abs("np"), POS_BITS).bitwiseAND((1 << RARE_BITS) - 1)
    sorted_ = index.withColumn("salt", salt).repartition("token", "salt") \
                   .sortWithinPartitions("token", "salt", rare, "sid")
    names = ["token", "sid", "n", "rare", "pos", "pivot", "pn", "ppos", "more"]

    def run(batches):
        held = None    # the running list's pivot: (token, salt, sid, np)
        told = False   # whether it has been handed on
        last = None    # the last entry's set id
        for batch in batches:
            t, s, p, z = (batch.column(i).to_numpy() for i in range(4))
            if not len(t):
                continue
            if held is not None:
                t, s, p, z = (np.concatenate([[h], x]) for h, x in zip((held[0], held[2], held[3], held[1]), (t, s, p, z)))
            starts = np.ones(len(t), bool)
            starts[1:] = (t[1:] != t[:-1]) | (z[1:] != z[:-1])
            again = np.zeros(len(t), bool)  # copies of a set from several tasks
            again[1:] = ~starts[1:] & (s[1:] == s[:-1])
            if held is not None and len(t) > 1 and not starts[1] and s[1] == last:
                again[1] = True
            at = np.flatnonzero(starts)
            of = np.cumsum(starts) - 1
            size = np.bincount(of, ~again)
            many = size > 1
            more = (size > 2)[of] | (p < 0) | (of == of[-1]) | (of == 0)  # the first and last may go on
            out = ~again & (many[of] | (p < 0))
            if told:
                out[0] = False
            k = at[-1]
            told = bool(out[k] or told and k == 0)
            held, last = (t[k], z[k], s[k], p[k]), s[-1]
            piv = at[of][out]
            n, rare_, pos = _unpacked(p)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (t[out], s[out], n[out], rare_[out], pos[out], s[piv], n[piv], pos[piv],
                                       more[out].astype(np.int64))], names)

    return sorted_.mapInArrow(run, ", ".join(f"{x} bigint" for x in names))


def _possible(n: Column, i: Column, m: Column, j: Column) -> Column:
    """Whether sets of sizes ``n`` and ``m`` whose first common shingle lies at
    positions ``i`` and ``j`` can be similar."""
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * F.least(n - i, m - j) >= 4 * (n + m))


def _wanted(pairs: DataFrame) -> np.ndarray:
    """Bitmap of the sets in ``pairs``, of :data:`BITS` bits whatever their number."""
    bit = F.pmod("sid", F.lit(BITS))
    sids = pairs.select(F.explode(F.array("a", "b")).alias("sid"))
    words = (sids.select(bit.alias("bit"))
                 .groupBy(F.shiftright("bit", 5).alias("w"))
                 .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 31 as int)))").alias("v"))
                 .toPandas())
    out = np.zeros(BITS // 32, np.uint32)
    out[words["w"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64).astype(np.uint32)
    return out


def _sets(src: DataFrame, wanted: _Shared) -> DataFrame:
    """``(sid, members)`` of the wanted sets (and a few whose bit is the same)."""

    def run(batches):
        seen, bits = _Seen(), wanted.value
        for batch in batches:
            for _, texts in text_rows([batch]):
                sids, members = [], []
                for s in shingle_sets(texts):
                    if not len(s):
                        continue
                    sid = set_id(s)
                    b = (sid - (sid >> 63 << 64)) % BITS
                    if bits[b >> 5] >> (b & 31) & 1 and seen.new(sid):
                        sids.append(sid)
                        members.append(s.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(sids)), pa.array(members, pa.binary())], ["sid", "members"])

    return src.mapInArrow(run, "sid bigint, members binary")


def _attach(pairs: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` with the columns of ``values`` (by ``sid``) for ``a`` (named
    ``x_``) and ``b`` (``y_``).  Pivots (``a``) may be hot: their values are
    replicated for the salts that occur."""
    salted = pairs.withColumn("salt", F.pmod("b", F.lit(SALTS)))
    x = values.select(F.col("sid").alias("a"), *[F.col(c).alias(f"x_{c}") for c in columns])
    y = values.select(F.col("sid").alias("b"), *[F.col(c).alias(f"y_{c}") for c in columns])
    needs = salted.select("a", "salt").distinct().join(x, "a")
    return salted.join(needs, ["a", "salt"]).join(y, "b") \
                 .select("a", "b", *[f"{p}_{c}" for c in columns for p in "xy"])


def _plausible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs that their sketches don't rule out."""

    def run(batches):
        for batch in batches:
            n, m, x, y = (batch.column(i).to_pylist() for i in range(2, 6))
            ok = pa.array([may_link(*v) for v in zip(n, x, m, y)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], ["a", "b"])

    return _attach(pairs, sketches, ["n", "sketch"]).mapInArrow(run, "a bigint, b bigint")


def _verify(src: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(a, b, j, linked)``: the similarity of each pair."""
    spark = src.sparkSession
    sets = _sets(src, _Shared(spark, _wanted(pairs)))
    sets = settled(sets.groupBy("sid").agg(F.first("members").alias("members")), "sets")
    both = _attach(pairs, sets, ["members"])

    def run(batches):
        for batch in batches:
            js = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                w = np.sort(np.concatenate([u, v]), kind="stable")
                common = int((w[1:] == w[:-1]).sum())
                union = len(w) - common
                js.append((common / union, 100 * common >= 80 * union))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([j for j, _ in js], pa.float64()),
                 pa.array([k for _, k in js], pa.bool_())], ["a", "b", "j", "linked"])

    return both.mapInArrow(run, "a bigint, b bigint, j double, linked boolean")


def _minimum(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``df`` with the minimum of ``value`` per ``key``; the minimum is
    aggregated before the shuffle, and a hot key is split by the skew join."""
    return df.join(df.groupBy(key).agg(F.min(value).alias(out)), key)


def components(links: DataFrame) -> DataFrame:
    """``(sid, comp)`` of every node of ``links`` (``a``, ``b``): ``comp`` is the
    smallest node it reaches.  Alternates two star contractions, each round
    stored, until every component is a star: no node has two parents, and no
    parent has one."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        # Large star: each node's larger neighbours move to its smallest neighbour.
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
        large = stored(_minimum(both.select("e.u", "e.v"), "u", "v", "m").filter("v > u")
                       .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large")
        # Small star: a node and its smaller neighbours move to the smallest.
        small = _minimum(large, "u", "v", "m").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.u", "e.v").filter("u > v").distinct(), "edges")
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent")),
                                              F.struct(F.col("v").alias("x"), F.lit(0).alias("child"), F.lit(1).alias("parent")))).alias("e"))
        bad = ends.select("e.*").groupBy("x").agg(F.sum("child").alias("c"), F.max("parent").alias("p")).filter("c + p > 1")
        if bad.isEmpty():
            return edges.select(F.col("u").alias("sid"), F.col("v").alias("comp")) \
                        .union(edges.select("v", F.col("v").alias("comp")).distinct())


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` after more links: components of components."""
    at = lambda c: comps.select(F.col("sid").alias(c), F.col("comp").alias(f"{c}c"))
    over = links.join(at("a"), "a", "left").join(at("b"), "b", "left") \
                .select(F.coalesce("ac", "a").alias("a"), F.coalesce("bc", "b").alias("b")).filter("a <> b")
    moved = components(over).withColumnsRenamed({"sid": "old", "comp": "new"})
    old = comps.join(moved, F.col("comp") == F.col("old"), "left").select("sid", F.coalesce("new", "comp").alias("comp"))
    new = moved.join(comps, F.col("old") == F.col("sid"), "left_anti").select(F.col("old").alias("sid"), F.col("new").alias("comp"))
    return stored(old.union(new), "comps")


def similarity_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``(id, n_shingles, component_id)``."""
    spark = docs.sparkSession
    src = id_and_text(docs, id_col, text_col)
    # Frees what led to ``docs`` too: its shuffles would lie beside the index's.
    described = settled(_describe(src), "described")
    rows = described.filter("token is null").select("_id", "n", "sid")
    frequent = _Shared(spark, _frequent(described))
    sketches = settled(described.filter("sketch is not null").groupBy("sid")
                       .agg(F.max("n").alias("n"), F.max("sketch").alias("sketch")), "sketches")
    lists = settled(_lists(_index(src, frequent)), "lists")

    pairs = lists.filter("sid <> pivot").filter(_possible(F.col("n"), F.col("pos"), F.col("pn"), F.col("ppos"))) \
                 .select(F.col("pivot").alias("a"), F.col("sid").alias("b")).distinct()
    pairs = settled(_plausible(pairs, sketches), "pairs")
    verified = settled(_verify(src, pairs), "verified")
    comps = components(verified.filter("linked").select("a", "b"))

    # Later rounds: entries with what the first pivot's answers say of them.
    known = verified.select(F.col("a").alias("pivot"), F.col("b").alias("sid"), "j")
    entries = lists.filter("more = 1").join(known, ["pivot", "sid"], "left") \
        .withColumn("j", F.when(F.col("sid") == F.col("pivot"), F.lit(1.0)).otherwise(F.col("j"))) \
        .select("token", "sid", "n", "rare", "pos", "pivot", "j")
    checked = verified.select("a", "b")
    turn, merging = 0, 0
    while True:
        entries, several = _mixed(entries, comps, f"entries{turn}")
        if not several:
            break
        # First, while that merges components, one pivot a list: the likeliest
        # of its largest component.  Then the entries of the smallest ones.
        merge = merging == turn < MERGE_ROUNDS
        most = 1 if merge else PIVOTS[min(turn - merging, len(PIVOTS) - 1)]
        size = F.col("held").desc() if merge else F.col("held").asc()
        order = Window.partitionBy("token").orderBy(size, "comp", "rare", "sid")
        ranked = settled(entries.withColumn("rank", F.row_number().over(order)), "ranked")
        p, e = ranked.filter(F.col("rank") <= most).alias("p"), ranked.alias("e")
        new = (p.join(e, (F.col("p.token") == F.col("e.token")) & (F.col("p.rank") < F.col("e.rank"))
                      & (F.col("p.comp") != F.col("e.comp"))
                      & _possible(F.col("p.n"), F.col("p.pos"), F.col("e.n"), F.col("e.pos"))
                      & F.coalesce((F.col("p.pivot") != F.col("e.pivot"))
                                   | (F.abs(F.col("p.j") - F.col("e.j")) <= 0.2000001), F.lit(True)))
                .select(F.least("p.sid", "e.sid").alias("a"), F.greatest("p.sid", "e.sid").alias("b")).distinct()
                .join(checked, ["a", "b"], "left_anti"))
        new = settled(_plausible(new, sketches), "pairs")
        if not new.isEmpty():
            more = settled(_verify(src, new), "verified")
            checked = checked.union(more.select("a", "b"))
            if not more.filter("linked").isEmpty():
                comps = _joined(comps, more.filter("linked").select("a", "b"))
                merging += merge
        entries = ranked.filter(F.col("rank") > most).select("token", "sid", "n", "rare", "pos", "pivot", "j")
        turn += 1

    alone = rows.filter("sid is null").select("_id", "n", F.col("_id").alias("component_id"))
    named = rows.filter("sid is not null").join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    salted = stored(named.select("_id", "n", "comp"), "named").withColumn("salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)))
    parts = salted.groupBy("comp", "salt").agg(F.min("_id").alias("m"))
    least = parts.select("comp", "salt").join(parts.groupBy("comp").agg(F.min("m").alias("component_id")), "comp")
    grouped = salted.join(least, ["comp", "salt"]).select("_id", "n", "component_id")
    return alone.unionByName(grouped).select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _mixed(entries: DataFrame, comps: DataFrame, name: str) -> tuple[DataFrame, bool]:
    """Entries of lists that hold several components, with ``comp`` and how
    many entries of the list are of that component; whether there are any."""
    now = entries.join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    now = settled(now, name)
    held = now.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("held"))
    lists = held.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("token")
    held = stored(held.join(lists, "token"), f"{name}-held")
    return now.join(held, ["token", "comp"]), not held.isEmpty()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component (its smallest id, of that
    id's texts the one with the smallest digest), all columns unchanged; rows
    with a null id stay, and so do other texts of a dropped text's id."""
    key = unused(docs, "_key")
    named = F.struct(docs[id_col].alias("id"), text_digest(docs[text_col]).alias("digest"))
    keyed = docs.withColumn(key, F.when(docs[id_col].isNotNull(), named))
    found = similarity_components(keyed, key, text_col)
    gone = found.filter(F.col(key) != F.col("component_id")).select(key).distinct()
    return without(keyed, stored(gone, "gone"), key).select(*docs.columns)
