"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeforge.functions._col import as_col


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of the month as DATE."""
    return F.make_date(as_col(year), as_col(month), F.lit(1))


def month_start_text(year: Column | str, month: Column | str) -> Column:
    """Same date assembled as text ``YYYY-MM-01`` and parsed (the string form)."""
    text = F.concat(as_col(year).cast("string"), F.lit("-"),
                    F.lpad(as_col(month).cast("string"), 2, "0"), F.lit("-01"))
    return F.try_to_date(text, "yyyy-MM-dd")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end`` as BIGINT (``end - start``)."""
    return F.datediff(as_col(end), as_col(start)).cast("bigint")
