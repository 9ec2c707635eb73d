"""Column helpers that state how missing values count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_text(*parts: Column | str, separator: str = "") -> Column:
    """Concatenate; the result is null when any part is null."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    if separator:
        spaced = [cols[0]]
        for c in cols[1:]:
            spaced += [F.lit(separator), c]
        cols = spaced
    return F.concat(*[c.cast("string") for c in cols])


# The characters Unicode counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(c: Column | str) -> Column:
    """Remove every kind of white space at both ends (`trim` alone removes blanks only)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def sum_or_zero(c: Column | str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def any_true(c: Column) -> Column:
    """True if some row is true; false when all are null."""
    return F.coalesce(F.bool_or(c), F.lit(False))


def all_true(c: Column) -> Column:
    """True unless some row is false; true when all are null."""
    return F.coalesce(F.bool_and(c), F.lit(True))


def row_sum(*names: str) -> Column:
    """Add columns of one row, counting null as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(n), F.lit(0.0)) for n in names])


def timestamp_text(c: Column | str) -> Column:
    """Timestamp as text with all six fraction digits."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
