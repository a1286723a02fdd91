"""Mergeable quantile sketches kept as table columns.

A sketch is a BINARY column of bounded size. Sketches of parts merge to one of
the whole, so a median per city comes from stored sketches per city and room
type without reading the rows again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeforge.functions._col import as_col

#: Size knob of sketches; about 10 KB each at most.
SKETCH_K = 800


def rank_error(k: int = SKETCH_K) -> float:
    """Error of a value's rank, as a share of the rows, that a sketch or a merge of
    sketches stays under with a probability over 99 %."""
    # The published fit of KLL sketches' single-sided error.
    return 2.296 / k ** 0.9021


def quantile_sketch(c: Column | str, k: int = SKETCH_K) -> Column:
    """Aggregate: sketch of the non-NULL values; NULL where there is none."""
    x = as_col(c).cast("double")
    return F.when(F.count(x) > 0, F.kll_sketch_agg_double(x, F.lit(k)))


def merge_sketches(c: Column | str, k: int = SKETCH_K) -> Column:
    """Aggregate: one sketch of all that the group's sketches saw; NULL sketches
    are ignored."""
    x = as_col(c)
    return F.when(F.count(x) > 0, F.kll_merge_agg_double(x, F.lit(k)))


def sketch_quantile(sketch: Column | str, share: float = 0.5) -> Column:
    """A value whose rank is ``share`` of the rows, within the sketch's error."""
    return F.kll_sketch_get_quantile_double(as_col(sketch), F.lit(float(share)))


def sketch_rank(sketch: Column | str, value: Column | str) -> Column:
    """Share of the rows at or below ``value``, within the sketch's error."""
    return F.kll_sketch_get_rank_double(as_col(sketch), as_col(value).cast("double"))


def sketch_rows(sketch: Column | str) -> Column:
    """Number of values that a sketch saw."""
    return F.kll_sketch_get_n_double(as_col(sketch))
