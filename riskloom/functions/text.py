"""Text column helpers: keys, labels, truncation, display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.numeric import as_col


def padded_key(prefix: str, number: Column | str, width: int) -> Column:
    """Prefix plus zero-padded number; a longer number keeps all its digits (plain lpad would cut it)."""
    digits = as_col(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def customer_key(number: Column | str) -> Column:
    return padded_key("CUST_", number, 6)


def policy_key(number: Column | str) -> Column:
    return padded_key("POL_", number, 7)


def customer_label(customer_id, first_name, last_name, age, state) -> Column:
    """'CUST_000001 - Mary Smith (42y, CA)'."""
    return F.concat(
        as_col(customer_id), F.lit(" - "), as_col(first_name), F.lit(" "), as_col(last_name),
        F.lit(" ("), as_col(age).cast("string"), F.lit("y, "), as_col(state), F.lit(")"),
    )


def key_of_label(label: Column | str) -> Column:
    return F.split_part(as_col(label), F.lit(" - "), F.lit(1))


def head_chars(c: Column | str, n: int) -> Column:
    return F.substring(as_col(c), 1, n)


def money_text(c: Column | str) -> Column:
    """'$1,234.50'."""
    return F.concat(F.lit("$"), F.format_number(as_col(c).cast("decimal(18,2)"), 2))


def whole_text(c: Column | str) -> Column:
    """Rounded to a whole number, without separators."""
    return F.round(as_col(c), 0).cast("decimal(18,0)").cast("string")
