"""Silver -> staging: fixed column lists plus row predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge import schemas as S


def stg_listings(silver: DataFrame, columns: list[str] = S.STG_LISTING_COLUMNS) -> DataFrame:
    return (silver.select(*columns)
            .filter(F.col("listing_id").isNotNull() & (F.col("price") > F.lit(0))))


def stg_reviews(silver: DataFrame, columns: list[str] = S.STG_REVIEW_COLUMNS) -> DataFrame:
    return (silver.select(*columns)
            .filter(F.col("review_id").isNotNull()
                    & F.col("listing_id").isNotNull()
                    & F.col("review_date").isNotNull()))
