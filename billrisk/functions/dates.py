"""Casts and dates that give null on bad text instead of failing (ANSI mode stays on)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_number(col: Column) -> Column:
    """Text to double."""
    return col.try_cast("double")


def as_int(col: Column) -> Column:
    """Text to int, dropping a decimal part: ``'12.5'`` gives 12."""
    return col.try_cast("double").try_cast("int")


# Where year, month and day stand in the fixed-width date texts of the files.
_FIXED_WIDTH = {
    "MMddyyyy": (8, lambda c: (F.substring(c, 5, 4), F.substring(c, 1, 2), F.substring(c, 3, 2))),
    "yyyy-MM-dd": (10, lambda c: (F.substring(c, 1, 4), F.substring(c, 6, 2), F.substring(c, 9, 2))),
    "yyMMdd": (6, lambda c: (F.concat(F.lit("20"), F.substring(c, 1, 2)), F.substring(c, 3, 2), F.substring(c, 5, 2))),
}


def parse_date(col: Column, fmt: str) -> Column:
    """Text to date, null on bad text.

    The fixed-width formats of the files are rearranged and cast: a formatter
    throws an exception for every unpaid mark, which is many times slower.
    """
    if fmt not in _FIXED_WIDTH:
        return F.try_to_date(col, fmt)
    width, parts = _FIXED_WIDTH[fmt]
    text = F.concat_ws("-", *parts(col))
    return F.when(F.length(col) == width, text.try_cast("date"))


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def clip_low(col: Column, low: int = 0) -> Column:
    """Raise values below ``low`` to it; null stays null (``greatest`` would drop the null)."""
    return F.when(col < low, F.lit(low)).otherwise(col)
