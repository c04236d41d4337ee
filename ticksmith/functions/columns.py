"""Column expressions shared by every layer.

All helpers return built-in Spark expressions (no Python UDFs), so they
stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: ColumnOrName) -> Column:
    """Trim spaces; an empty result becomes NULL (NULL stays NULL)."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def _integral(c: ColumnOrName, target: str) -> Column:
    # Integral text casts directly.  Text with a fraction or exponent
    # ("12.0", "12.7", "1e3") is rounded half away from zero through an exact
    # decimal, never through double, so 17-digit ids keep every digit.
    # Anything else still raises under ANSI casting.
    col = _c(c)
    return F.coalesce(col.try_cast(target), col.cast("decimal(38,0)").cast(target))


def to_int(c: ColumnOrName) -> Column:
    return _integral(c, "int")


def to_bigint(c: ColumnOrName) -> Column:
    return _integral(c, "bigint")


def to_double(c: ColumnOrName) -> Column:
    return _c(c).cast("double")


def to_string(c: ColumnOrName) -> Column:
    return _c(c).cast("string")


def to_bool(c: ColumnOrName) -> Column:
    """Lower-case first, then the usual true/false spellings."""
    return F.lower(_c(c)).cast("boolean")


_U64_MAX = 18446744073709551615


def to_u64(c: ColumnOrName) -> Column:
    """Unsigned 64-bit ids kept exactly as decimal(20,0); out-of-range raises."""
    d = _c(c).cast("decimal(20,0)")
    bad = (d < 0) | (d > F.lit(str(_U64_MAX)).cast("decimal(20,0)"))
    return F.when(bad, F.raise_error(F.lit("value out of range for unsigned 64-bit")).cast("decimal(20,0)")).otherwise(d)


def to_ts(c: ColumnOrName) -> Column:
    return _c(c).cast("timestamp_ntz")


_CASTS = {"s": to_string, "i": to_int, "l": to_bigint, "d": to_double, "b": to_bool, "u": to_u64}


def cast_code(c: ColumnOrName, code: str) -> Column:
    """Blank-to-NULL followed by the typed cast for a schema type code."""
    return _CASTS[code](blank(c))


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as double; a zero denominator gives NULL, not 0."""
    return _c(num).cast("double") / F.nullif(_c(den), F.lit(0))


def tick_to_seconds(tick: ColumnOrName, start: ColumnOrName, rate: ColumnOrName) -> Column:
    """(tick - start) / ticks-per-second; NULL when any input is NULL or the
    rate is zero."""
    return F.try_divide(_c(tick) - _c(start), _c(rate))


# fixed values: grenade entity-name fragments and the category each maps to,
# tested in this order, case-sensitive
GRENADE_CATEGORIES = [
    ("%HEGrenade%", "HE"),
    ("%Flashbang%", "Flash"),
    ("%SmokeGrenade%", "Smoke"),
    ("%Molotov%", "Molotov"),
    ("%Incendiary%", "Incendiary"),
    ("%Decoy%", "Decoy"),
]


def grenade_category(c: ColumnOrName) -> Column:
    col = _c(c)
    expr = None
    for pattern, label in GRENADE_CATEGORIES:
        expr = F.when(col.like(pattern), label) if expr is None else expr.when(col.like(pattern), label)
    return expr.otherwise(col)


def opposite_side(c: ColumnOrName) -> Column:
    """'t' for 'ct', otherwise 'ct' (NULL and unknown sides also map to 'ct')."""
    return F.when(_c(c) == "ct", F.lit("t")).otherwise(F.lit("ct"))


def not_in_list(c: ColumnOrName, values: list) -> Column:
    """SQL NOT IN over literals: NULL input yields NULL, so a filter drops it."""
    return ~_c(c).isin(values)
