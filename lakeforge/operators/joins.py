"""Joins that stay balanced when one key holds a large share of the rows.

``skew_safe_join`` counts rows per key of the large (fact) side with a
partial aggregate, and gives every key with more than ``hot_key_rows`` rows
``ceil(rows / hot_key_rows)`` salt buckets. Fact rows of a hot key are spread
over its buckets by a hash of the row, so a recomputed task puts each row where
it was; the matching dimension rows are replicated once
per bucket. Every fact row still meets every dimension row of its key, so
inner, left-outer, left-semi and left-anti results are exact, while no join
task receives more than about ``hot_key_rows`` rows of one key.

Keys to split may also come from a frequent-items sketch observed while the fact
side is written (``heavy_hitters``, ``hot_keys_from``), which saves the counting
pass: the sketch's counts are estimates, and they only decide how the work is
spread.

Each hot key has at least ``hot_key_rows`` fact rows, so the hot-key table has
at most ``fact_rows / hot_key_rows`` rows. It grows with the fact side; whether
it is broadcast is left to the optimizer's size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_KEY_ROWS = 2_000_000
# Keys that a sketch reports, and counters it keeps (bounds of its size).
HEAVY_KEYS, HEAVY_COUNTERS = 1_000, 20_000
_SALT, _BUCKETS = "__salt", "__buckets"
_FACT_SIDE_JOINS = ("inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "semi",
                    "left_anti", "leftanti", "anti")


def hot_keys(fact: DataFrame, keys: Sequence[str], hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Keys with more than ``hot_key_rows`` rows and their bucket counts."""
    counts = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return (counts.filter(F.col("__rows") > F.lit(hot_key_rows))
            .select(*keys, F.ceil(F.col("__rows") / F.lit(hot_key_rows)).cast("int").alias(_BUCKETS)))


def heavy_hitters(key: str, keys: int = HEAVY_KEYS, counters: int = HEAVY_COUNTERS) -> Column:
    """Aggregate: the most frequent values of ``key`` with estimated counts, an
    array of bounded size. Counts are off by at most about 3.5 * rows / counters,
    so a key with a larger share of the rows is always among them."""
    return F.expr(f"approx_top_k({key}, {keys}, {counters})")


def hot_keys_from(like: DataFrame, key: str, heavy: Sequence[Row], hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """What :func:`hot_keys` gives, from the result of :func:`heavy_hitters` (at most
    its ``keys`` rows), with the type that ``key`` has in ``like``."""
    schema = T.StructType([T.StructField(key, like.schema[key].dataType), T.StructField(_BUCKETS, T.IntegerType())])
    rows = [(h["item"], -(-h["count"] // hot_key_rows)) for h in heavy or [] if h["item"] is not None and h["count"] > hot_key_rows]
    return like.sparkSession.createDataFrame(rows, schema)


def skew_safe_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner",
                   hot_key_rows: int = HOT_KEY_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """``fact.join(dim, on, how)`` with hot keys of ``fact`` split across tasks.

    ``how`` must keep the fact side on the left (inner, left outer, left
    semi, left anti). NULL keys never match and are never hot. ``hot`` may
    pass precomputed ``(keys..., __buckets)`` rows (e.g. from per-key counts
    a pipeline already has) to skip the counting pass; any set of keys gives
    the exact result, the buckets only decide how the work is spread.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how.lower() not in _FACT_SIDE_JOINS:
        raise ValueError(f"skew_safe_join supports joins that keep the fact side, not {how!r}")
    hot = hot if hot is not None else hot_keys(fact, keys, hot_key_rows)
    f = (fact.join(hot, keys, "left")
         .withColumn(_SALT, F.when(F.col(_BUCKETS).isNull(), F.lit(0))
                     .otherwise(F.pmod(F.xxhash64(*fact.columns), F.col(_BUCKETS)).cast("int")))
         .drop(_BUCKETS))
    d = (dim.join(hot, keys, "left")
         .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_BUCKETS), F.lit(1)) - 1)))
         .drop(_BUCKETS))
    return f.join(d, [*keys, _SALT], how).drop(_SALT)
