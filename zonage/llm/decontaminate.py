"""Benchmark decontamination (DataFrame functions only).

Benchmark items become windows of ``width`` consecutive normalised words; the
set of windows is broadcast (after counting it) as a hash set.  Each document
computes, at every word position, a cheap hash of three words of the window
that would start there; positions whose hash is in the set are verified
against the window's full words, and verified windows mark the words they
cover.  Only verified hits leave the scan, so texts are never shuffled.

Beyond :data:`MAX_BROADCAST` windows, positions and hashes are shuffled to the
windows instead, and the documents' words meet the positions that are left; the
result is the same.

Edge cases: null or empty texts have no words, are never contaminated and give
no windows; an item of fewer than ``width`` words is one window of all its
words; equal windows of several items count for each of them; rows that share an id,
or have none, are told apart by their texts, and repeated rows get the same
result; texts of any length are scanned whole, in one array of words; extra
columns are not read; empty tables give empty or clean results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bounded, id_and_text, row_key, stored, text_digest, unused, without

# Fixed value: what separates words (every ASCII character but a-z and 0-9).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MAX_BROADCAST = 500_000


def words(text: Column) -> Column:
    """Array of normalised words of ``text``."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def _gate(ws: Column, i: Column, n: int) -> Column:
    """Hash of the first, middle and last word of the window of ``n`` words at
    0-based position ``i``."""
    at = lambda k: F.get(ws, i + F.lit(k))
    return F.xxhash64(F.lit(n), at(0), at(n // 2), at(n - 1))


def _gates(ws: Column, n: int) -> Column:
    """:func:`_gate` of every window of ``n`` words of ``ws``."""
    return F.transform(F.sequence(F.lit(0), F.size(ws) - F.lit(n)), lambda i: _gate(ws, i, n))


def windows(items: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """``(item, n, win)``: distinct windows of each item as arrays of words."""
    ws = id_and_text(items, item_col, text_col).select("_id", words(F.col("_text")).alias("_ws"))
    ws = ws.filter(F.size("_ws") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("_ws") - F.lit(width), F.lit(0)))
    return (ws.select(F.col("_id").alias("item"), "_ws", F.explode(starts).alias("_i"))
              .select("item", F.slice("_ws", F.col("_i") + 1, width).alias("win"))
              .select("item", F.size("win").alias("n"), "win").distinct())


def find_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", width: int = 10) -> DataFrame:
    """Verified hits ``(id, pos, n, item)``: item ``item``'s window of ``n``
    words starts at word ``pos`` (0-based) of document ``id``."""
    wins = stored(windows(items, item_col, item_text_col, width), "windows")
    sizes = sorted(r["n"] for r in wins.select("n").distinct().collect())  # at most `width` numbers
    ws = id_and_text(docs, id_col, text_col).select("_id", words(F.col("_text")).alias("_ws"))
    small = bounded(wins, MAX_BROADCAST)
    found = None
    for n in sizes:
        keyed = wins.filter(F.col("n") == n).select("win", "item", _gate(F.col("win"), F.lit(0), n).alias("_g"))
        one = keyed.groupBy("_g", "win").agg(F.collect_set("item").alias("items"))
        long = ws.filter(F.size("_ws") >= n)
        gates = F.posexplode(_gates(F.col("_ws"), n)).alias("pos", "_g")
        if small:
            cand = long.select("_id", "_ws", gates).join(F.broadcast(one), "_g") \
                       .filter(F.slice("_ws", F.col("pos") + 1, n) == F.col("win"))
        else:
            # Only positions are shuffled by hash; words meet those that are left.
            at = long.select("_id", gates).join(one.select("_g").distinct(), "_g", "left_semi")
            at = at.groupBy("_id").agg(F.collect_set(F.struct("pos", "_g")).alias("_at")).withColumnRenamed("_id", "_aid")
            cand = (long.join(at, F.col("_id").eqNullSafe(F.col("_aid"))).select("_id", "_ws", F.explode("_at").alias("_a"))
                        .select("_id", "_a.pos", "_a._g", F.slice("_ws", F.col("_a.pos") + 1, n).alias("win"))
                        .join(one, ["_g", "win"]))
        cand = cand.select("_id", "pos", F.lit(n).alias("n"), F.explode("items").alias("item"))
        found = cand if found is None else found.unionByName(cand)
    if found is None:
        found = ws.filter("false").select("_id", F.lit(0).alias("pos"), F.lit(0).alias("n"),
                                          F.lit(None).cast(items.schema[item_col].dataType).alias("item"))
    return found.withColumnRenamed("_id", id_col)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", width: int = 10) -> DataFrame:
    """Per row of ``docs``: ``(id, n_words, n_hit, items)``, ``items`` being the
    sorted array of items (as strings) with windows in it."""
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.withColumn("_key", row_key(F.col("_id"), text_digest(F.col("_text"))))
    hits = stored(find_hits(rows, items, "_key", "_text", item_col, item_text_col, width), "hits")
    covered = (hits.select("_key", "pos", "n").distinct()
                   .select("_key", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("n") - 1)).alias("_p"))
                   .distinct().groupBy("_key").agg(F.count(F.lit(1)).alias("n_hit")))
    named = (hits.select("_key", F.col("item").cast("string").alias("item")).distinct()
                 .groupBy("_key").agg(F.sort_array(F.collect_list("item")).alias("items")))
    base = rows.select("_id", "_key", F.size(words(F.col("_text"))).cast("long").alias("n_words"))
    return (base.join(covered.join(named, "_key"), "_key", "left")
                .select(F.col("_id").alias(id_col), "n_words",
                        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                        F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **kw) -> DataFrame:
    """``docs`` without the rows in which a benchmark window occurs, all columns
    unchanged; the rest stays as it is, rows that share a null or other id with
    a dropped text included."""
    key = unused(docs, "_key")
    keyed = docs.withColumn(key, row_key(docs[id_col], text_digest(docs[text_col])))
    bad = find_hits(keyed, items, key, text_col, **kw).select(key).distinct()
    return without(keyed, stored(bad, "contaminated"), key).select(*docs.columns)
