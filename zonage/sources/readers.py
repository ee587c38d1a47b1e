"""File sources (SRC1–SRC11, SRC13, SRC16, SRC17).

Everything is read as **strings** (explicit all-string schema or header
names) and coerced afterwards with the ``try_*`` functions of
:mod:`zonage.functions.clean`, so a bad value never fails a job.  Reads are
plain distributed scans: Spark splits large files into partitions itself and
prunes columns, so no chunked loops are needed.  Files whose quoted fields hold
line breaks are split too: :func:`quoted_records` tells by quote parity where
records begin and joins the lines of one record.

A scan can carry the position of each row (:data:`POSITION`: file, block, row),
which orders rows as they stand in the files, however the scan is split; "keep
the first row" (:func:`zonage.operators.score.keep_first`) can then mean the
first in the file.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
POSITION = "_pos"


@dataclass(frozen=True)
class ReaderSpec:
    """How a delimited landing file is read."""
    sep: str = ";"
    encoding: str = "UTF-8"
    header: bool = True
    multiline: bool = False
    columns: Sequence[str] | None = None     # all-string schema, in file order
    keep: Sequence[str] | None = None        # column pruning after the scan
    rename: dict = field(default_factory=dict)
    drop_long_lines: bool = False            # SRC7/SRC8: skip lines with extra fields


# Landing datasets by domain and how their files are read.
SOURCES: dict[str, ReaderSpec] = {
    "sales": ReaderSpec(sep="|"),
    "income": ReaderSpec(sep=";"),
    "social_housing": ReaderSpec(sep=";"),
    "trees": ReaderSpec(sep=";"),
    "green_spaces": ReaderSpec(sep=";", multiline=True),
    "cool_islands": ReaderSpec(sep=";", multiline=True),
    "sorting_stations": ReaderSpec(sep=";", multiline=True),
    "bike_stations": ReaderSpec(sep=";"),
    "stops": ReaderSpec(sep=";"),
    "rail_stations": ReaderSpec(sep=";"),
    "antennas": ReaderSpec(sep=";", encoding="windows-1252", drop_long_lines=True),
    "qos": ReaderSpec(sep=";", encoding="ISO-8859-1", drop_long_lines=True),
    "fibre": ReaderSpec(sep=","),
    "school_headcounts": ReaderSpec(sep=";"),
    "schools": ReaderSpec(sep=";"),
    "colleges": ReaderSpec(sep=";"),
    "hospitals": ReaderSpec(sep=";"),
    "district_population": ReaderSpec(sep=","),
    "zone_population": ReaderSpec(sep=";"),
    "age_structure": ReaderSpec(sep=";"),
    "health_equipment": ReaderSpec(sep=";", header=False),
}


def _string_schema(names: Iterable[str], corrupt: bool = False) -> T.StructType:
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def header_names(spark: SparkSession, path: str, spec: ReaderSpec) -> list[str]:
    """Column names from the header line (BOM stripped, names trimmed)."""
    first = (spark.read.option("sep", spec.sep).option("encoding", spec.encoding)
             .option("header", "false").csv(path).limit(1).collect())
    if not first:
        return []
    return [(v or f"_c{i}").replace("﻿", "").strip() for i, v in enumerate(first[0])]


def position() -> Column:
    """Where a row of a text or CSV scan stands, ascending as in the files: file,
    start of the block that a task reads, row.  Only for the scan itself (filters
    and projections on it included), as rows are numbered where they are read."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def parquet_position() -> Column:
    """:func:`position` of a Parquet scan, which knows each row's number."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.lit(0).cast("long").alias("block"),
                    F.col("_metadata.row_index").alias("row"))


def quoted_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Records of UTF-8 files whose quoted fields may hold line breaks:
    ``(value, _pos, first)``, one row per record that isn't blank, the lines of a record
    joined by a line feed; ``first`` marks each file's first record.

    A line begins a record if an even number of quotes stands before it in its
    file.  That number is the quotes of the blocks before (one row a block) plus
    those before it in its own block, so files are read in blocks by as many
    tasks as they have.  Records of one line, nearly all, are passed on as they
    are; only the lines of longer ones meet by the position of their first line,
    which may be in another block."""
    lines = spark.read.text(list(paths)).select("value", position().alias("p")).select("value", "p.*") \
                 .withColumn("quotes", F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'))))
    block = Window.partitionBy("file", "block").orderBy("row")
    blocks = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = lines.groupBy("file", "block").agg(F.sum("quotes").alias("q")) \
                  .select("file", "block", F.coalesce(F.sum("q").over(blocks), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("quotes").over(block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.join(before, ["file", "block"]).withColumn("begins", (F.col("before") + inside) % 2 == 0) \
                 .withColumn("head", (F.col("block") == 0) & (F.row_number().over(block) == 1))
    here = F.struct("block", "row", "head")
    own = F.last(F.when(F.col("begins"), here), ignorenulls=True).over(block)
    lines = lines.select("file", "block", "row", "value", "begins", "quotes", own.alias("at"))
    # A block's first lines may belong to a record of an earlier block.
    earlier = lines.groupBy("file", "block").agg(F.max("at").alias("at")) \
                   .select("file", "block", F.last("at", ignorenulls=True).over(blocks).alias("open"))
    alone = F.col("begins") & (F.col("quotes") % 2 == 0)
    single = lines.filter(alone).select("file", "at", "value")
    longer = lines.filter(~alone).join(earlier, ["file", "block"]) \
                  .withColumn("at", F.coalesce("at", "open")).groupBy("file", "at") \
                  .agg(F.sort_array(F.collect_list(F.struct("block", "row", "value"))).alias("lines")) \
                  .select("file", "at", F.array_join(F.col("lines.value"), "\n").alias("value"))
    return single.unionByName(longer).filter(F.col("value") != "").select(
        "value", F.struct("file", "at.block", "at.row").alias(POSITION), F.col("at.head").alias("first"))


def _spanning(spark: SparkSession, paths: list[str], spec: ReaderSpec, names: list[str]) -> DataFrame:
    """All-string columns of files whose records may span lines, and position."""
    records = quoted_records(spark, paths)
    if spec.header:
        records = records.filter(~F.col("first"))
    kinds = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    options = {"sep": spec.sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    return records.select(F.from_csv("value", kinds, options).alias("_r"), POSITION).select("_r.*", POSITION)


def read_delimited(spark: SparkSession, path: str | Sequence[str], spec: ReaderSpec = ReaderSpec(),
                   with_file: bool = False, with_position: bool = False) -> DataFrame:
    """SRC1–SRC5, SRC7–SRC10: delimited scan, every column a string.

    * the UTF-8 BOM is stripped by Spark; header names are trimmed;
    * ``multiline``: quoted fields may hold line breaks (``geo_shape``); UTF-8
      files are read in blocks all the same (:func:`quoted_records`);
    * ``drop_long_lines`` keeps short lines (missing fields -> NULL) and drops
      lines with more fields than the header, like a CSV reader skipping
      bad lines; separators inside quotes don't count;
    * ``with_file`` adds ``_file`` (file name) for provenance;
    * ``with_position`` adds ``_pos``, the order of the rows in the files.
    """
    paths = [path] if isinstance(path, str) else list(path)
    names = list(spec.columns) if spec.columns else None
    if names is None and spec.header:
        # Each file's own header; files of one header are one scan.
        groups: dict[tuple, list[str]] = {}
        for p in paths:
            groups.setdefault(tuple(header_names(spark, p, spec)), []).append(p)
        if len(groups) > 1:
            bare = replace(spec, keep=None, rename={})
            df = None
            for header, files in groups.items():
                one = read_delimited(spark, files, replace(bare, columns=header), with_file, with_position)
                df = one if df is None else df.unionByName(one, allowMissingColumns=True)
            own = [c for c, wanted in (("_file", with_file), (POSITION, with_position)) if wanted]
            return _projected(df.select(*[c for c in df.columns if c not in own], *own), spec, own)
        names = list(next(iter(groups)))
    if spec.multiline and names and spec.encoding.upper() == "UTF-8":
        df = _spanning(spark, paths, spec, names)
        if with_file:
            df = df.withColumn("_file", F.element_at(F.split(F.col(f"{POSITION}.file"), "/"), -1))
        return _projected(df if with_position else df.drop(POSITION), spec, [POSITION] * with_position)
    r = (spark.read.option("sep", spec.sep).option("encoding", spec.encoding)
         .option("header", str(spec.header).lower()).option("quote", '"').option("escape", '"')
         .option("multiLine", str(spec.multiline).lower()).option("mode", "PERMISSIVE"))
    if names:
        r = r.schema(_string_schema(names, corrupt=spec.drop_long_lines))
        if spec.drop_long_lines:
            r = r.option("columnNameOfCorruptRecord", CORRUPT)
    df = r.csv(paths)
    if spec.drop_long_lines and names:
        df = df.filter(F.col(CORRUPT).isNull() | (n_fields(F.col(CORRUPT), spec.sep) <= len(names))).drop(CORRUPT)
    if with_file:
        df = df.withColumn("_file", F.col("_metadata.file_name"))
    if with_position:
        df = df.withColumn(POSITION, position())
    return _projected(df, spec, [POSITION] * with_position)


def n_fields(line: Column, sep: str) -> Column:
    """Number of fields of a line: separators in quoted fields (those that open
    with a quote, a doubled quote being one inside) don't count."""
    quoted = rf'(^|{_regex_escape(sep)})"(?:[^"]++|"")*+("|$)'
    return F.size(F.split(F.regexp_replace(line, quoted, "$1"), _regex_escape(sep)))


def _projected(df: DataFrame, spec: ReaderSpec, own: Sequence[str] = ()) -> DataFrame:
    if spec.keep:
        df = df.select(*spec.keep, *[c for c in own if c not in spec.keep])
    if spec.rename:
        df = df.withColumnsRenamed(dict(spec.rename))
    return df


def _regex_escape(sep: str) -> str:
    return "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep


def read_source(spark: SparkSession, name: str, path: str | Sequence[str], with_position: bool = False,
                **overrides) -> DataFrame:
    """Read a registered landing dataset (:data:`SOURCES`)."""
    spec = SOURCES[name]
    if overrides:
        spec = ReaderSpec(**{**spec.__dict__, **overrides})
    return read_delimited(spark, path, spec, with_position=with_position)


# --------------------------------------------------------------------------
# names and provenance
# --------------------------------------------------------------------------

def year_from_file(col: str = "_file", pattern: str = r"(20\d{2})") -> Column:
    """SRC6: the year embedded in a file name -> int (NULL if absent)."""
    y = F.regexp_extract(F.col(col), pattern, 1)
    return F.when(y != "", y.cast("int"))


def read_yearly(spark: SparkSession, path: str | Sequence[str], spec: ReaderSpec,
                value_prefix: str, zone_col: str, out: str = "value") -> DataFrame:
    """SRC6: files whose value column name depends on the year in the file
    name (``DISP_MED18`` … ``DISP_MED21``): one ``(zone, year, value)`` frame.
    The per-file column is ``value_prefix`` and the last two digits of that
    year, resolved on the driver from the schema; a file without it is skipped,
    as is one without a year.  The files are unioned by name."""
    paths = [path] if isinstance(path, str) else list(path)
    parts = []
    for p in paths:
        df = read_delimited(spark, p, spec, with_file=True)
        year = re.search(r"20(\d{2})", p.rsplit("/", 1)[-1])
        col = f"{value_prefix}{year[1]}" if year else None
        if col not in df.columns:
            continue
        parts.append(df.select(F.col(zone_col), year_from_file().alias("annee"), F.col(col).alias(out)))
    if not parts:
        raise KeyError(f"no file of {paths} has its {value_prefix} column")
    out_df = parts[0]
    for p in parts[1:]:
        out_df = out_df.unionByName(p)
    return out_df


def coverage_layer_keys(col: str = "_file") -> tuple[Column, Column]:
    """SRC13: operator code and technology from a coverage layer file name
    ``YYYY_Tn_couv_Metropole_<OP>_<TECH>_data…`` (5th and 6th ``_`` parts)."""
    parts = F.split(F.col(col), "_")
    return F.get(parts, 4), F.get(parts, 5)


def coverage_layer(path: str, operators: dict[str, str]) -> tuple[str, str]:
    """SRC13: operator name and technology of one coverage layer file; a code
    that is not among ``operators`` stands for itself."""
    parts = path.rsplit("/", 1)[-1].split("_")
    return operators.get(parts[4], parts[4]), parts[5]


def resolve_column(df: DataFrame, candidates: Sequence[str], contains: str | None = None) -> str:
    """SRC16: first candidate present in the schema, else the first column whose
    name contains ``contains`` (case-insensitive).  Runs on the driver over
    the schema only."""
    cols = df.columns
    for c in candidates:
        if c in cols:
            return c
    if contains:
        low = contains.lower()
        for c in cols:
            if low in c.lower():
                return c
    raise KeyError(f"no column among {list(candidates)!r} or containing {contains!r} in {cols}")


def positional(df: DataFrame, positions: dict[int, str]) -> DataFrame:
    """SRC11: select columns by position (sheet exports with unstable names)."""
    return df.select(*[F.col(df.columns[i]).alias(name) for i, name in positions.items()])


def data_rows(df: DataFrame, key: str, pattern: str) -> DataFrame:
    """SRC11: drop the title/header block of a sheet export by keeping only
    rows whose key column looks like data (e.g. a commune code).  A content
    test instead of a row index keeps the scan splittable."""
    return df.filter(F.col(key).rlike(pattern))
