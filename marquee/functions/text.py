"""String cleaning and tolerant number parsing (column expressions only).

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none of them needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers that mean NULL.
CSV_NULL_MARKERS = ("", "-")
DOC_NULL_MARKER = "N/A"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_ws(c: Column | str) -> Column:
    """Trim blanks at both ends, then collapse every whitespace run to one blank.

    ``trim`` strips blanks only, so a leading tab survives the trim and is
    turned into a single blank by the collapse (same as the source warehouse).
    """
    return F.regexp_replace(F.trim(col_of(c)), r"\s+", " ")


def null_if_marker(c: Column | str, markers=CSV_NULL_MARKERS) -> Column:
    """NULL when the text equals any of ``markers`` (CSV: empty and dash)."""
    col = col_of(c)
    return F.when(~col.isin(*markers), col)


def na_to_null(c: Column | str) -> Column:
    """The document sentinel 'N/A' means NULL."""
    return F.nullif(col_of(c), F.lit(DOC_NULL_MARKER))


def first_digits(c: Column | str) -> Column:
    r"""First run of digits, NULL when there is none (``\d+``)."""
    return F.regexp_substr(col_of(c), F.lit(r"\d+"))


def strip_money(c: Column | str) -> Column:
    """Remove the dollar sign and thousands separators: '$1,234' -> '1234'."""
    return F.replace(F.replace(col_of(c), F.lit("$"), F.lit("")), F.lit(","), F.lit(""))


def try_number(c: Column | str, precision: int = 38, scale: int = 0) -> Column:
    """Tolerant parse to decimal(p,s); text that is not a number becomes NULL."""
    return col_of(c).try_cast(f"decimal({precision},{scale})")


def strict_number(c: Column | str, precision: int, scale: int = 0) -> Column:
    """Strict cast; under ANSI mode a bad value raises and aborts the load."""
    return col_of(c).cast(f"decimal({precision},{scale})")


def truncate(c: Column | str, n: int) -> Column:
    """First ``n`` characters (error messages are kept to 200 / 500)."""
    return F.substring(col_of(c), 1, n)


def strip_prefix(c: Column | str, prefix: str) -> Column:
    """Remove ``prefix`` when the value starts with it."""
    col = col_of(c)
    return F.when(col.startswith(prefix),
                  F.substring(col, len(prefix) + 1, 1 << 30)).otherwise(col)
