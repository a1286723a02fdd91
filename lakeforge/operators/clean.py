"""Bronze -> silver cleaners.

Each cleaner is one projection (casts, flags, parsed text, metadata) plus
row filters and a deterministic key dedup. Unlike an arbitrary-survivor
``dropDuplicates`` on the raw text key, the key is typed and invalid rows are
rejected first, so a bad duplicate can never evict a good row. Columns the
spec does not name pass through unchanged (silver keeps an open column set).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge import schemas as S
from lakeforge.functions import flag, list_length, pct_from_text, title_case, to_date_lenient, to_double, to_int, to_long
from lakeforge.operators.dedup import SortKey, asc, dedup_by_key, desc

# Price validity bounds (exclusive) of the listing cleaner.
PRICE_LOWER = 0
PRICE_UPPER = 10_000


def load_stamp(run_ts: dt.datetime | str | None) -> Column:
    """``ingested_at`` value: a fixed stamp when given (reproducible runs),
    else the query start time."""
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(run_ts).cast("timestamp")


def listing_projection(df: DataFrame, run_ts=None) -> list[Column]:
    """Typed silver columns for a listing record, in input order, with the
    derived columns appended."""
    out: list[Column] = []
    for c in df.columns:
        if c in S.LISTING_PCT_COLUMNS:
            continue  # replaced by the parsed *_pct column
        if c in S.LISTING_LONG_COLUMNS:
            out.append(to_long(c).alias(c))
        elif c in S.LISTING_INT_COLUMNS:
            out.append(to_int(c).alias(c))
        elif c in S.LISTING_DOUBLE_COLUMNS:
            out.append(to_double(c).alias(c))
        elif c in S.LISTING_FLAG_COLUMNS:
            out.append(flag(c).alias(c))
        elif c in S.LISTING_TITLE_CASE_COLUMNS:
            out.append(title_case(c).alias(c))
        else:
            out.append(F.col(c))
    for raw, parsed in S.LISTING_PCT_COLUMNS.items():
        if raw in df.columns:
            out.append(pct_from_text(raw).alias(parsed))
    for raw, counted in S.LISTING_LIST_COUNT_COLUMNS.items():
        if raw in df.columns:
            out.append(list_length(raw).alias(counted))
    out.append(load_stamp(run_ts).alias("ingested_at"))
    out.append(F.lit("silver").alias("source_layer"))
    return out


def clean_listings(df: DataFrame, run_ts=None, price_bounds: tuple[float, float] = (PRICE_LOWER, PRICE_UPPER),
                   key: str = "listing_id", order: Sequence[SortKey | str] = ()) -> DataFrame:
    """Bronze listings -> silver listings.

    Keeps rows with a key, a city and ``lower < price < upper`` (a NULL or
    unparseable price is rejected), then one row per key: the first under
    ``order``, then the one with the fewest NULLs, then by all columns.
    """
    lo, hi = price_bounds
    typed = df.select(*listing_projection(df, run_ts))
    valid = typed.filter(
        F.col(key).isNotNull()
        & F.col("city").isNotNull()
        & (F.col("price") > F.lit(lo))
        & (F.col("price") < F.lit(hi))
    )
    missing = sum((F.col(c).isNull().cast("int") for c in typed.columns if c != key), F.lit(0))
    return dedup_by_key(valid.withColumn("__missing", missing), [key], [*order, asc("__missing")]).drop("__missing")


def review_projection(df: DataFrame, run_ts=None, date_column: str = "date",
                      date_format: str = "yyyy-MM-dd") -> list[Column]:
    return [*_review_fields(df, date_column, date_format), *_review_derived(run_ts, to_date_lenient(date_column, date_format))]


def _review_fields(df: DataFrame, date_column: str = "date", date_format: str = "yyyy-MM-dd") -> list[Column]:
    """Typed silver columns of a review record, the date last."""
    fields = [to_long(c).alias(c) if c in S.REVIEW_LONG_COLUMNS else F.col(c) for c in df.columns if c != date_column]
    return [*fields, to_date_lenient(date_column, date_format).alias("review_date")]


def _review_derived(run_ts, review_date: Column) -> list[Column]:
    """Columns that follow from the date and the run."""
    return [F.year(review_date).alias("review_year"), F.month(review_date).alias("review_month"), load_stamp(run_ts).alias("ingested_at")]


# Survivor among duplicate review ids: a dated row over an undated one, then
# the latest date, then the smallest listing / reviewer id.
REVIEW_DEDUP_ORDER = (desc("review_date"), asc("listing_id"), asc("reviewer_id"))


def clean_reviews(df: DataFrame, run_ts=None, key: str = "review_id",
                  order: Sequence[SortKey | str] = REVIEW_DEDUP_ORDER) -> DataFrame:
    """Bronze reviews -> silver reviews: typed ids, parsed date and its
    year / month, rows with both ids, one row per review id. What follows from the
    other columns is added to the rows that stay, so it is neither sorted nor
    shuffled."""
    typed = df.select(*_review_fields(df))
    valid = typed.filter(F.col(key).isNotNull() & F.col("listing_id").isNotNull())
    kept = dedup_by_key(valid, [key], order)
    return kept.select("*", *_review_derived(run_ts, F.col("review_date")))
