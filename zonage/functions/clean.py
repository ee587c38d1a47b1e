"""Scalar cleaning functions (SF1–SF24, FLT2–FLT8, FLT12–FLT13).

All functions return ``Column`` expressions evaluated JVM-side inside
whole-stage codegen; none of them is a Python UDF.  ANSI mode is on in
Spark 4, so every parse goes through ``try_*`` variants.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A plain decimal number (optionally signed, optional exponent).  Java's
# double parser also accepts "1d", "1f", "NaN" and "Infinity", which a
# coercing numeric parse must treat as missing values.
NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(c: ColumnOrName) -> Column:
    """SF1: string -> double; anything that is not a plain number -> NULL."""
    s = _c(c).cast("string")
    return F.when(s.rlike(NUMERIC_PATTERN), F.trim(s).try_cast("double"))


def to_int(c: ColumnOrName) -> Column:
    """SF1 for integer columns: parse as double first (``"12.0"`` -> 12);
    a value with a fractional part, or beyond 64 bits, becomes NULL.  A plain run
    of digits is read as it is, as doubles are exact up to 2^53 only."""
    s = F.trim(_c(c).cast("string"))
    d = to_number(c)
    fits = (d >= F.lit(-2.0 ** 63)) & (d < F.lit(2.0 ** 63)) & (d == F.floor(d))
    return F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("long")).otherwise(F.when(fits, d.cast("long")))


def comma_decimal(c: ColumnOrName) -> Column:
    """SF2: French decimal comma (``"1042000,00"``) -> double."""
    return to_number(F.regexp_replace(_c(c).cast("string"), ",", "."))


def parse_date(c: ColumnOrName, fmt: str = "dd/MM/yyyy") -> Column:
    """SF3: date text -> DATE; unparseable -> NULL."""
    return F.to_date(F.try_to_timestamp(_c(c), F.lit(fmt)))


def lat_lon(c: ColumnOrName, sep: str = ",") -> tuple[Column, Column]:
    """SF4: ``"48.85, 2.35"`` -> (lat, lon).  Anything but exactly two numeric
    parts gives (NULL, NULL).  ``sep=", "`` requires the space after the
    comma (files whose reader splits on comma-space)."""
    parts = F.split(_c(c), sep)
    ok = F.size(parts) == 2
    lat = to_number(F.trim(F.get(parts, 0)))
    lon = to_number(F.trim(F.get(parts, 1)))
    both = ok & lat.isNotNull() & lon.isNotNull()
    return F.when(both, lat), F.when(both, lon)


def ordinal(c: ColumnOrName) -> Column:
    """SF5: ordinal label -> int (``"11ème"`` -> 11, ``"1er"`` -> 1)."""
    head = F.trim(F.get(F.split(_c(c), "[èer]"), 0))
    return to_int(head).cast("int")


def first_number(c: ColumnOrName) -> Column:
    """SF6/SF7: first stand-alone number, optionally followed by an ordinal
    suffix (``"PARIS 20E ARRDT"`` -> 20, ``"Paris 1er Arrondissement"`` -> 1,
    ``"TOTAL"`` -> NULL)."""
    digits = F.regexp_extract(_c(c), r"(?i)\b(\d+)(er|e|ème)?\b", 1)
    return F.when(digits != "", digits.try_cast("int"))


def code_to_district(c: ColumnOrName, kind: str = "postal",
                     keep_116: bool = False) -> Column:
    """SF8: postal / INSEE / zone code -> district number 1..20.

    kind: ``postal`` (75001 -> 1, 75116 -> 16), ``insee`` (75101 -> 1),
    ``zone`` (751AAIIII -> AA), ``last2`` (last two digits).
    ``keep_116`` reproduces the postal quirk where 75116 maps to 116.
    """
    s = F.regexp_replace(F.trim(_c(c).cast("string")), r"\.0$", "")
    n = to_int(s)
    if kind == "postal":
        d = n - 75000
        if not keep_116:
            d = F.when(d == 116, F.lit(16)).otherwise(d)
        return d.try_cast("int")
    if kind == "insee":
        return (n - 75100).try_cast("int")
    if kind == "zone":
        return to_int(F.substring(s, 4, 2)).try_cast("int")
    if kind == "last2":
        return (n % 100).try_cast("int")
    raise ValueError(f"unknown code kind {kind!r}")


def row_id(*cols: ColumnOrName) -> Column:
    """SF9: deterministic row id = md5 of ``|``-joined columns.  NULLs become
    empty strings so that positions never shift."""
    parts = [F.coalesce(_c(x).cast("string"), F.lit("")) for x in cols]
    return F.md5(F.concat_ws("|", *parts))


def address_key(address: ColumnOrName, district: ColumnOrName) -> Column:
    """SF10: ``trim(address) || ' ' || district || 'e'`` (NULL-propagating)."""
    return F.concat(F.trim(_c(address)), F.lit(" "), _c(district).cast("string"), F.lit("e"))


# Canonical telecom operator names, matched as lower-case
# substrings in this order; anything else is title-cased.
OPERATOR_SUBSTRINGS: list[tuple[str, str]] = [
    ("bouygues", "Bouygues"),
    ("bouygue", "Bouygues"),
    ("free", "Free"),
    ("orange", "Orange"),
    ("sfr", "SFR"),
]
# Coverage-layer file codes -> operator.
COVERAGE_OPERATOR_CODES = {"BOUY": "Bouygues", "FREE": "Free", "OF": "Orange", "SFR0": "SFR"}
# Antenna operator labels (lower-cased) -> operator.
ANTENNA_OPERATORS = {"bouygues": "Bouygues", "free mobile": "Free", "free": "Free",
                     "orange": "Orange", "sfr": "SFR"}
# Fibre infrastructure operator codes -> operator.
FIBRE_OPERATOR_CODES = {"FRTE": "Orange", "SFR0": "SFR", "FREE": "Free", "NURC": "Bouygues"}
# Coverage level -> level score.
LEVEL_SCORES = {"TBC": 100, "BC": 60, "CL": 30}


def canonical(c: ColumnOrName, rules: Sequence[tuple[str, str]] = OPERATOR_SUBSTRINGS,
              python_title: bool = True) -> Column:
    """SF11: first substring rule that matches the lower-cased trimmed value,
    else Title Case.  ``python_title`` capitalises after any non-letter
    (``la-poste`` -> ``La-Poste``) like Python's ``str.title``; Spark's
    ``initcap`` only capitalises after spaces."""
    raw = F.trim(_c(c).cast("string"))
    low = F.lower(raw)
    out = None
    for needle, value in rules:
        cond = low.contains(needle)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    if python_title:
        title = _python_title(raw)
    else:
        title = F.initcap(raw)
    return out.otherwise(title) if out is not None else title


def _python_title(s: Column) -> Column:
    """``str.title``: upper-case letters that follow a non-letter, lower the rest."""
    chars = F.split(F.lower(s), "")
    prev_is_letter = lambda i: F.get(chars, i - 1).rlike(r"^\p{L}$")
    titled = F.transform(
        chars,
        lambda ch, i: F.when((i == 0) | ~prev_is_letter(i), F.upper(ch)).otherwise(ch),
    )
    return F.when(s.isNotNull(), F.array_join(titled, ""))


def map_values(c: ColumnOrName, mapping: dict, passthrough: bool = False,
               normalise: bool = False) -> Column:
    """JN16/SF12: literal lookup map; unmapped -> NULL or the raw value."""
    key = _c(c)
    if normalise:
        key = F.lower(F.trim(key))
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    looked = F.try_element_at(m, key)
    return F.coalesce(looked, _c(c)) if passthrough else looked


def clip(c: ColumnOrName, lo: float = 0.0, hi: float = 100.0) -> Column:
    """SF15: clip to [lo, hi], NULL stays NULL (``greatest``/``least`` skip
    NULLs, so an unguarded NULL would become ``hi``)."""
    x = _c(c)
    return F.when(x.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def round_dec(c: ColumnOrName, digits: int) -> Column:
    """SF17: half-up rounding done in decimal arithmetic so that the result
    does not depend on the binary expansion of the double (matches SQL
    engines that round decimals).  A double beyond decimal(38,10) has no digits
    to round and stays as it is."""
    return F.coalesce(F.round(_c(c).try_cast("decimal(38,10)"), digits).cast("double"), _c(c).cast("double"))


def round_half_even(c: ColumnOrName, digits: int) -> Column:
    """SF17: banker's rounding (parity with pandas/numpy ``round``)."""
    return F.coalesce(F.bround(_c(c).try_cast("decimal(38,10)"), digits).cast("double"), _c(c).cast("double"))


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """SF18: division with a 0 denominator -> NULL (ANSI ``/`` throws)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def row_max(*cols: ColumnOrName) -> Column:
    """SF19: row-wise max ignoring NULLs."""
    return F.greatest(*[_c(x) for x in cols])


def point_geojson(lon: ColumnOrName, lat: ColumnOrName) -> Column:
    """SF20: lat/lon -> GeoJSON Point text (NULL if a coordinate is NULL)."""
    return F.concat(F.lit('{"type": "Point", "coordinates": ['), _c(lon).cast("string"),
                    F.lit(", "), _c(lat).cast("string"), F.lit("]}"))


def district_zone_prefix(district: ColumnOrName) -> Column:
    """SF21: district number -> 5-char commune code prefix ``751AA``."""
    return F.concat(F.lit("751"), F.lpad(_c(district).cast("string"), 2, "0"))


def district_label(district: ColumnOrName) -> Column:
    """SF21: 1 -> ``1er``, n -> ``ne``."""
    d = _c(district)
    return F.when(d == 1, F.lit("1er")).otherwise(F.concat(d.cast("string"), F.lit("e")))


# Affordability bands (upper bounds, exclusive) and labels.
AFFORDABILITY_BANDS: list[tuple[float, str]] = [(5.0, "Bon"), (10.0, "Moyen")]
AFFORDABILITY_OTHER = "Faible"


def band(c: ColumnOrName, thresholds: Sequence[tuple[float, str]] = AFFORDABILITY_BANDS,
         other: str = AFFORDABILITY_OTHER) -> Column:
    """SF22: value -> label by ascending exclusive upper bounds."""
    x = _c(c)
    out = None
    for bound, label in thresholds:
        cond = x < F.lit(bound)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.when(x.isNotNull(), out.otherwise(F.lit(other)))


def gauge(c: ColumnOrName) -> Column:
    """SF22: gauge score of the affordability index: the slope falls from band
    to band, and the last band ends at 10."""
    x = _c(c)
    return F.when(x < 5, 100 - x * 8).when(x < 10, 100 - x * 6).when(x.isNotNull(), F.greatest(F.lit(10.0), 100 - x * 5))


def per_10k(count: ColumnOrName, population: ColumnOrName) -> Column:
    """SF23: rate per 10 000 persons, NULL when the population is 0/NULL."""
    return safe_div(_c(count).cast("double") * 10000.0, population)


def sum_columns(cols: Iterable[ColumnOrName], null_as_zero: bool = True) -> Column:
    """SF24: row-wise sum of several columns."""
    terms = [F.coalesce(_c(x), F.lit(0)) if null_as_zero else _c(x) for x in cols]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def nan_to_null(c: ColumnOrName) -> Column:
    """SNK11: NaN and ±Inf -> NULL for a double column."""
    x = _c(c)
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def sanitize(df: DataFrame) -> DataFrame:
    """SNK11: apply :func:`nan_to_null` to every float/double column."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(nan_to_null(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# --------------------------------------------------------------------------
# Row filters (FLT*) and imputations
# --------------------------------------------------------------------------

def starts_with(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """FLT2: sargable prefix filter (pushed to the Parquet scan)."""
    return df.filter(F.col(col).startswith(prefix))


def positive(df: DataFrame, *cols: str) -> DataFrame:
    """FLT8: keep rows whose measures are > 0 (NULL drops)."""
    cond = None
    for c in cols:
        cond = (F.col(c) > 0) if cond is None else cond & (F.col(c) > 0)
    return df.filter(cond)


def drop_missing(df: DataFrame, subset: Sequence[str], how: str = "any") -> DataFrame:
    """FLT7: drop rows with NULL in any/all of ``subset``."""
    return df.dropna(how=how, subset=list(subset))
