"""Text parsing helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeforge.functions._col import as_col


def pct_from_text(c: Column | str) -> Column:
    """First run of digits as DOUBLE: ``'97%'`` -> 97, ``'97.5%'`` -> 97,
    ``'0.97'`` -> 0; no digits (``'N/A'``, ``''``) -> NULL."""
    digits = F.regexp_extract(as_col(c), r"(\d+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("double")


def list_length(c: Column | str) -> Column:
    """Item count of a bracketed list kept as text, e.g. ``'["Wifi", "TV"]'``.

    Brackets and double quotes are stripped and the rest split on commas, so
    ``'[]'`` and ``''`` count 1, a comma inside an item over-counts, and NULL
    gives -1 (the legacy ``size(NULL)``), independent of ANSI mode.
    """
    col = as_col(c)
    stripped = F.regexp_replace(col, r'[\[\]"]', "")
    return F.when(col.isNull(), F.lit(-1)).otherwise(F.size(F.split(stripped, ",")))


def title_case(c: Column | str) -> Column:
    """Trim, then upper-case the first letter of each word, lower-case the rest."""
    return F.initcap(F.trim(as_col(c)))
