"""Numeric column helpers: rounding, clamping, guarded ratios, coercion with defaults, lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp(c: Column | str, lo, hi) -> Column:
    """Bound to [lo, hi]. NULL stays NULL and NaN stays NaN (Spark would order NaN above ``hi``)."""
    c = as_col(c)
    return F.when(c.isNull() | F.isnan(c), c).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def rounded(c: Column | str, digits: int) -> Column:
    """Round half away from zero on the decimal value. Eight decimals are kept before rounding, so
    that a half cent which floating point left a hair below the half still counts as one. Values no
    decimal can hold (NaN, infinity) pass through."""
    c = as_col(c)
    return F.coalesce(F.round(c.try_cast("decimal(28,8)"), digits).cast("double"), c)


def at_least(floor, c: Column | str) -> Column:
    """max(floor, c) that stays NULL for a NULL input (``greatest`` alone would skip the NULL)."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(floor), c))


def at_most(ceiling, c: Column | str) -> Column:
    """min(ceiling, c) that stays NULL for a NULL input."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.least(F.lit(ceiling), c))


def ratio(numerator: Column | str, denominator: Column | str, otherwise=0.0) -> Column:
    """numerator / denominator, or ``otherwise`` where the denominator is zero or NULL."""
    d = as_col(denominator)
    return F.when(d != 0, as_col(numerator) / d).otherwise(F.lit(otherwise))


def exact(c: Column | str, scale: int = 2) -> Column:
    """Fixed-point value: its sums do not depend on the order partitions arrive in. NaN and infinity
    have none and become NULL."""
    return as_col(c).try_cast(f"decimal(28,{scale})")


def exact_sum(c: Column | str, scale: int = 2) -> Column:
    return F.sum(exact(c, scale)).cast("double")


def exact_avg(c: Column | str, scale: int = 6) -> Column:
    """Mean of a fixed-point column: exact sum over the count, divided once. NULL without values."""
    value = exact(c, scale)
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def safe_int(c: Column | str, default=0) -> Column:
    """Whole number, truncating floats; NULL, NaN, infinity and unparsable text give the default.

    Text must be a whole number ('12'); '12.5' is not one and gives the default.
    """
    value = as_col(c).try_cast("bigint")
    fallback = default if isinstance(default, Column) else F.lit(default).cast("bigint")
    return F.coalesce(value, fallback)


def safe_float(c: Column | str, default=0.0, text: bool = False) -> Column:
    """Double; NULL, NaN and unparsable text give the default. ``text`` marks a string column.

    Java number suffixes ('1.5d', '2f'), which a string cast would accept, count as unparsable.
    """
    c = as_col(c)
    if text:
        c = F.when(~F.lower(F.trim(c)).rlike(r"[0-9.][df]$"), c)
    fallback = default if isinstance(default, Column) else F.lit(default).cast("double")
    return F.coalesce(F.nanvl(c.try_cast("double"), F.lit(None).cast("double")), fallback)


def text_or(c: Column | str, default: str) -> Column:
    """Text, or the default for NULL and the empty string."""
    text = as_col(c).cast("string")
    return F.coalesce(F.when(text != "", text), F.lit(default))


def lookup(mapping: dict, key: Column | str, default=None, strict: bool = False) -> Column:
    """Value of a small constant mapping; a default, or with ``strict`` an error, for unknown keys."""
    key = as_col(key)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    value = F.try_element_at(table, key)
    if strict:
        problem = F.concat(F.lit("unknown key: "), F.coalesce(key.cast("string"), F.lit("NULL")))
        return F.when(value.isNull(), F.raise_error(problem)).otherwise(value)
    return value if default is None else F.coalesce(value, F.lit(default))


def truncate_to_int(c: Column | str) -> Column:
    """Drop the fraction, toward zero."""
    return as_col(c).cast("bigint")


def pick(values: list, index: Column) -> Column:
    """Element of a constant list at a 0-based index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))
