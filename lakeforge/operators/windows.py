"""Window operators over already-aggregated series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.functions import growth_pct


def lag_growth(df: DataFrame, value: str, partition_by: Sequence[str], order_by: Sequence[str],
               prev_name: str = "prev_value", growth_name: str = "growth_pct", digits: int = 1) -> DataFrame:
    """Previous existing row's ``value`` within each series (rows are not
    densified: a gap compares with the last present period) and the percent
    change against it (NULL for the first row or a previous value of 0).

    Meant for aggregated series (one row per period per group), so each
    window partition is bounded by the number of periods.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    prev = F.lag(F.col(value)).over(w)
    return df.withColumns({
        prev_name: prev,
        growth_name: growth_pct(F.col(value), prev, digits),
    })
