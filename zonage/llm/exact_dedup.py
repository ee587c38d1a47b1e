"""Exact deduplication by progressive refinement (DataFrame functions only).

Documents are refined by byte length, then by a hash of the first characters,
then by a hash of the whole text.  Each level hands the next one only the
groups that still have two members, so whole texts are hashed only where an
equal text can exist.

Surviving groups are handed on as a set of hash buckets, at most
:data:`BUCKETS` longs whatever the input's size, so broadcasting them is
bounded by construction.  Two groups in one bucket merely let more rows
through to the next level; the last level compares SHA-256 digests.

Groups may be of any size: a group's size and largest id come from two
partially aggregated steps over ``(digest, salt)``, and rows find them by that
salted key, so a text that holds a third of all rows is dealt over
:data:`SALTS` tasks.

Edge cases: null texts count as empty, and empty texts are equal to each
other; a null id is smaller than any other; rows with equal id and equal text
count separately in ``group_size`` and are all marked as kept or dropped alike
(:func:`keep_one` leaves one of them); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, id_and_text, row_key, stored, text_digest, unused

BUCKETS = 1 << 20
SALTS = 64
PREFIX_CHARS = 64


def _repeated(df: DataFrame, bucket) -> DataFrame:
    """Buckets that hold at least two rows of ``df``."""
    return df.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n")) \
             .filter("_n > 1").select("_b")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            extra: dict | None = None) -> DataFrame:
    """``(_id, _key)`` per row: the digest of the normalised text where an equal
    text can exist, null where length or prefix already prove it unique.
    ``extra`` maps names to expressions over ``_norm`` computed on the way."""
    src = id_and_text(docs, id_col, text_col)
    rows = src.withColumn("_norm", ascii_lower(F.col("_text")))
    by_len = F.pmod(F.octet_length("_text"), F.lit(BUCKETS))
    by_prefix = F.pmod(F.xxhash64(F.octet_length("_text"),
                                  ascii_lower(F.substring("_text", 1, PREFIX_CHARS))), F.lit(BUCKETS))
    lens = _repeated(src, by_len)
    level2 = src.join(F.broadcast(lens), by_len == F.col("_b"), "left_semi")
    prefixes = _repeated(level2, by_prefix)
    return (rows.join(F.broadcast(prefixes), by_prefix == F.col("_b"), "left")
                .select("_id",
                        F.when(F.col("_b").isNotNull(), F.unhex(F.sha2(F.col("_norm"), 256))).alias("_key"),
                        *[c.alias(n) for n, c in (extra or {}).items()]))


def _groups(rows: DataFrame, names: list[str]) -> DataFrame:
    """``(_id, _key, keep_id, group_size)`` plus ``names`` per row of
    :func:`digests` whose digest is known."""
    salt = F.pmod(F.xxhash64("_id"), F.lit(SALTS))
    shared = rows.filter(F.col("_key").isNotNull()).withColumn("_salt", salt)
    parts = shared.groupBy("_key", "_salt").agg(F.max("_id").alias("_m"), F.count(F.lit(1)).alias("_n"))
    # At most SALTS rows per digest reach this aggregate.
    whole = parts.groupBy("_key").agg(F.max("_m").alias("keep_id"), F.sum("_n").alias("group_size"))
    found = parts.select("_key", "_salt").join(whole, "_key")
    return shared.join(found, ["_key", "_salt"]).select("_id", "_key", "keep_id", "group_size", *names)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                extra: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: ``(id, keep_id, group_size, kept)`` plus the
    ``extra`` columns.  Of equal texts the row with the largest id is kept."""
    rows = stored(digests(docs, id_col, text_col, extra), "digests")
    names = list(extra or {})
    alone = rows.filter(F.col("_key").isNull()).select(
        "_id", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), *names)
    out = alone.unionByName(_groups(rows, names).drop("_key"))
    return out.select(F.col("_id").alias(id_col), "keep_id", "group_size",
                      F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), *names)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` drops, all columns
    unchanged; of rows with equal id and equal text one stays.  Rows are told
    apart by id and text, as ids may be null or shared by several texts."""
    # One key for join and duplicates, so whole rows are shuffled once.
    key = unused(docs, "_key")
    lost = _groups(stored(digests(docs, id_col, text_col), "digests"), []) \
        .filter(~F.col("_id").eqNullSafe(F.col("keep_id")))
    dropped = lost.select(row_key(F.col("_id"), F.col("_key")).alias(key)).distinct()
    norm = ascii_lower(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    kept = docs.withColumn(key, row_key(docs[id_col], text_digest(norm))).join(dropped, key, "left_anti")
    return kept.dropDuplicates([key]).select(*docs.columns)
