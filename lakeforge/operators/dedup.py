"""Deterministic key deduplication that stays cheap under key skew.

One row per key is kept: the smallest under a caller-given order, with all
remaining columns as the tiebreak, so the survivor never depends on input
order or partitioning. It is a ``groupBy(key).agg(min(struct(...)))``: the
partial aggregate collapses every key to one row per map task before the
shuffle, so a key holding a third of all rows moves one row per task, not a
third of the table (a ``row_number`` window would sort all of it in one task).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SortKey:
    """One ordering term: ``column`` ascending unless ``descending``;
    NULLs first unless ``nulls_last``."""

    column: str
    descending: bool = False
    nulls_last: bool = False


def asc(column: str, nulls_last: bool = False) -> SortKey:
    return SortKey(column, False, nulls_last)


def desc(column: str, nulls_last: bool = True) -> SortKey:
    return SortKey(column, True, nulls_last)


def _descending_value(col: Column, dtype: T.DataType, name: str) -> Column:
    if isinstance(dtype, T.DateType):
        return F.negative(F.unix_date(col).cast("bigint"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.negative(F.unix_micros(col.cast("timestamp")))
    if isinstance(dtype, T.BooleanType):
        return F.not_(col)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return F.negative(col.cast("bigint"))
    if isinstance(dtype, (T.LongType, T.FloatType, T.DoubleType, T.DecimalType)):
        return F.negative(col)
    raise TypeError(f"descending order is not supported for {name} of type {dtype.simpleString()}")


def order_terms(df: DataFrame, order: Sequence[SortKey | str]) -> list[Column]:
    """Struct fields whose ascending, nulls-first comparison equals ``order``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    terms: list[Column] = []
    for i, key in enumerate(order):
        key = SortKey(key) if isinstance(key, str) else key
        col = F.col(key.column)
        if key.nulls_last:
            terms.append(col.isNull().alias(f"__n{i}"))
        value = _descending_value(col, types[key.column], key.column) if key.descending else col
        terms.append(value.alias(f"__o{i}"))
    return terms


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[SortKey | str] = ()) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order`` and then every
    other column ascending (nulls first). Column order is preserved.

    Every column takes part in the comparison, so all of them must be
    orderable (map columns are not; convert them, e.g. ``to_json``, first).
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    # a column that is a term as it stands isn't held a second time
    held: dict[str, str] = {}
    for i, key in enumerate(order):
        key = SortKey(key) if isinstance(key, str) else key
        if key.column in payload and not key.descending:
            held.setdefault(key.column, f"__o{i}")
    row = F.struct(*order_terms(df, order), *[F.col(c) for c in payload if c not in held])
    kept = df.groupBy(*keys).agg(F.min(row).alias("__row"))
    return kept.select(*[F.col(c) if c in keys else F.col("__row")[held.get(c, c)].alias(c) for c in df.columns])


def latest_by_key(df: DataFrame, keys: Sequence[str], version_column: str, as_of=None) -> DataFrame:
    """Newest version per key, optionally among versions stamped ``<= as_of``
    (the as-of read over an append-only history table)."""
    if as_of is not None:
        df = df.filter(F.col(version_column) <= F.lit(as_of))
    return dedup_by_key(df, keys, [desc(version_column)])
