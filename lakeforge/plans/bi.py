"""BI datasets on top of the gold marts (and silver listings)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.functions import amenity_bucket, stable_avg


def city_pricing_list(city_pricing: DataFrame) -> DataFrame:
    """City / room type prices, most expensive first."""
    return (city_pricing.select("city", "room_type", "avg_price", "median_price", "total_listings")
            .orderBy(F.col("avg_price").desc_nulls_last(), "city", "room_type"))


def top_cities(city_pricing: DataFrame, room_type: str, k: int = 5) -> DataFrame:
    """Top ``k`` cities by median price for one room type (ties by city)."""
    return (city_pricing.filter(F.col("room_type") == F.lit(room_type))
            .select("city", "avg_price", "median_price", "superhost_pct")
            .orderBy(F.col("median_price").desc_nulls_last(), F.col("city").asc_nulls_last())
            .limit(k))


def city_price(city_pricing: DataFrame) -> DataFrame:
    """Unweighted average of the room-type average prices per city."""
    return (city_pricing.groupBy("city").agg(stable_avg("avg_price", 0).alias("avg_price"))
            .orderBy(F.col("avg_price").desc_nulls_last(), "city"))


def host_tier_price(host_performance: DataFrame) -> DataFrame:
    return (host_performance.groupBy("host_tier").agg(
        stable_avg("avg_listing_price", 0).alias("avg_price"),
        F.count(F.lit(1)).alias("host_count"))
        .orderBy(F.col("avg_price").desc_nulls_last(), "host_tier"))


def reviews_by_year(review_trends: DataFrame) -> DataFrame:
    return (review_trends.groupBy("review_year").agg(F.sum("review_count").alias("total_reviews"))
            .orderBy(F.col("review_year").asc_nulls_last()))


def amenity_vs_rating(silver_listings: DataFrame) -> DataFrame:
    """Average rating and listing count per amenity-count bucket."""
    return (silver_listings.groupBy(amenity_bucket("amenity_count").alias("amenity_bucket"))
            .agg(stable_avg("review_scores_rating", 2).alias("avg_rating"),
                 F.count(F.lit(1)).alias("listing_count"))
            .orderBy(F.col("avg_rating").desc_nulls_last(), "amenity_bucket"))


def rating_vs_price(city_pricing: DataFrame) -> DataFrame:
    """Scatter dataset: one point per (city, room type)."""
    return city_pricing.select("city", "room_type", "avg_rating", "avg_price")


def reviews_by_month(review_trends: DataFrame) -> DataFrame:
    """Line dataset: reviews per calendar month over all cities."""
    return (review_trends.groupBy("month_start_date").agg(F.sum("review_count").alias("review_count"))
            .orderBy("month_start_date"))
