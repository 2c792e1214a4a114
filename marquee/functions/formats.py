"""Display formats of the report measures (text columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

# Currency sign, millions suffix, refresh time format.
CURRENCY = "$"
MILLIONS_SUFFIX = "M"
REFRESH_FMT = "yyyy-MM-dd HH:mm"


def half_up(c: Column | str, digits: int) -> Column:
    """Rounded as displayed: halves away from zero (number formats alone round to even)."""
    return F.round(col_of(c).cast("decimal(30,6)"), digits)


def money(c: Column | str) -> Column:
    """'$#,0;($#,0);$#,0': thousands separators, negatives in parentheses."""
    x = col_of(c)
    pos = F.concat(F.lit(CURRENCY), F.format_number(half_up(F.abs(x), 0), 0))
    return F.when(x < 0, F.concat(F.lit("("), pos, F.lit(")"))).otherwise(pos)


def money_millions(c: Column | str) -> Column:
    """'$#,0.0"M"' for a value already divided by one million."""
    return F.concat(F.lit(CURRENCY), F.format_number(half_up(c, 1), 1), F.lit(MILLIONS_SUFFIX))


def one_decimal(c: Column | str) -> Column:
    """'0.0'."""
    return F.format_number(half_up(c, 1), 1)


def whole_number(c: Column | str) -> Column:
    """'#,0'."""
    return F.format_number(half_up(c, 0), 0)


def refresh_time(c: Column | str) -> Column:
    return F.date_format(col_of(c), REFRESH_FMT)
