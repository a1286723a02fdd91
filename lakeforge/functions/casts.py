"""Lenient casts that give the same answer with ANSI mode on or off.

The raw layer holds every field as text. A value that does not parse turns
into NULL instead of failing the job, the way a non-ANSI cast behaves.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeforge.functions._col import as_col


def to_double(c: Column | str) -> Column:
    """Text -> DOUBLE; unparseable, NaN and infinite -> NULL, so that no later
    average or cast to an integer fails on them.

    A plain ``try_cast``: guarding it against the cast's exception path
    (blank / ``'N/A'`` text) was measured slower on the full cleaner, because
    the larger expressions push the projection out of whole-stage codegen.
    """
    x = as_col(c).try_cast("double")
    return F.when(F.abs(x) <= F.lit(1.7976931348623157e308), x)


def to_int(c: Column | str) -> Column:
    """Text -> INT like a lenient cast: ``'3.0'`` -> 3, ``'3.7'`` -> 3,
    ``' 7 '`` -> 7; empty, non-numeric, NaN and out-of-range -> NULL.

    Going through DOUBLE accepts decimal spellings of whole numbers, and the
    second ``try_cast`` truncates toward zero and nulls overflow.
    """
    return to_double(c).try_cast("int")


def to_long(c: Column | str) -> Column:
    """Like :func:`to_int`, for BIGINT keys; through DECIMAL, so that every
    digit of a 64-bit key is kept."""
    return F.trim(as_col(c)).try_cast("decimal(38,6)").try_cast("bigint")


def to_date_lenient(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> DATE with ``fmt``; malformed text -> NULL."""
    return F.try_to_date(as_col(c), fmt)


def flag(c: Column | str, true_token: str = "t") -> Column:
    """``'t'`` -> true, any other text (including ``''``) -> false, NULL -> NULL."""
    return as_col(c) == F.lit(true_token)
