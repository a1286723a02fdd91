"""Gold marts over the staging tables.

Each mart is a function from DataFrames to a DataFrame; thresholds, keys and
labels are parameters. Ordering is a property of the written table
(``sortWithinPartitions`` in :mod:`lakeforge.sources.tables`), not of the
DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.functions import (days_between, host_tier, month_start, pct_of, price_tier,
                                 round_half_up, stable_avg)
from lakeforge.functions.sketches import SKETCH_K, merge_sketches, quantile_sketch, sketch_quantile
from lakeforge.functions.labels import HOST_TIER_ELITE_RATING, HOST_TIER_EXPERIENCED_RATING, PRICE_TIERS
from lakeforge.operators.clean import load_stamp
from lakeforge.operators.joins import HOT_KEY_ROWS, skew_safe_join
from lakeforge.operators.windows import lag_growth

# Fixed value: oldest review year kept by the trends mart.
REVIEW_YEAR_FLOOR = 2015
# Relative accuracy knob of the sketch median (1/accuracy rank error).
MEDIAN_ACCURACY = 10_000


def median_expr(col: str, mode: str = "approx", accuracy: int = MEDIAN_ACCURACY):
    """Median per group: ``approx`` keeps a bounded-size sketch per group
    (memory independent of group size); ``sketch`` does so with one that can be
    stored and merged (:func:`price_sketches`); ``exact`` is the lower median
    (``percentile_disc``), whose buffer grows with distinct values."""
    if mode == "sketch":
        return sketch_quantile(quantile_sketch(col))
    if mode == "approx":
        return F.percentile_approx(F.col(col), 0.5, accuracy)
    if mode == "exact":
        return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {col})")
    raise ValueError(f"median mode must be 'approx', 'sketch' or 'exact', not {mode!r}")


def price_sketches(listings: DataFrame, group_by: Sequence[str] = ("city", "room_type"), value: str = "price",
                   k: int = SKETCH_K) -> DataFrame:
    """A mergeable sketch of ``value`` per group, as a table to keep: any coarser
    grouping's quantiles come from it (:func:`coarser_sketches`)."""
    return listings.groupBy(*group_by).agg(F.count(value).alias("n"), quantile_sketch(value, k).alias("sketch"))


def coarser_sketches(sketches: DataFrame, group_by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """Sketches of fewer keys, merged from :func:`price_sketches`."""
    return sketches.groupBy(*group_by).agg(F.sum("n").alias("n"), merge_sketches("sketch", k).alias("sketch"))


def with_rank(estimates: DataFrame, rows: DataFrame, keys: Sequence[str], value: str, estimate: str) -> DataFrame:
    """``estimates`` (one row per group) with the exact shares of the group's
    non-NULL values below, and at or below, the estimate: ``share_below`` and
    ``share_upto``. NULL is a group value."""
    e = estimates.select(*[F.col(k).alias(f"e_{k}") for k in keys], F.col(estimate).alias("e_value"))
    same = [F.col(k).eqNullSafe(F.col(f"e_{k}")) for k in keys]
    n = F.nullif(F.count(value), F.lit(0).cast("bigint")).cast("double")
    shares = rows.select(*keys, value).join(e, same).groupBy(*[f"e_{k}" for k in keys]).agg(
        (F.count_if(F.col(value) < F.col("e_value")) / n).alias("share_below"),
        (F.count_if(F.col(value) <= F.col("e_value")) / n).alias("share_upto"))
    return estimates.join(shares, same, "left").drop(*[f"e_{k}" for k in keys])


def city_pricing(listings: DataFrame, group_by: Sequence[str] = ("city", "room_type"),
                 median: str = "approx", tiers=PRICE_TIERS, run_ts=None) -> DataFrame:
    """Price, capacity, quality and host statistics per (city, room type)."""
    base = listings.filter(F.col("city").isNotNull())
    stats = base.groupBy(*group_by).agg(
        F.count("listing_id").alias("total_listings"),
        F.countDistinct("property_type").alias("distinct_property_types"),
        stable_avg("price", 2).alias("avg_price"),
        round_half_up(median_expr("price", median), 2).alias("median_price"),
        round_half_up(F.min("price"), 2).alias("min_price"),
        round_half_up(F.max("price"), 2).alias("max_price"),
        round_half_up(F.stddev_samp("price"), 2).alias("stddev_price"),
        stable_avg("bedrooms", 1, whole=True).alias("avg_bedrooms"),
        stable_avg("accommodates", 1, whole=True).alias("avg_accommodates"),
        stable_avg("amenity_count", 1, whole=True).alias("avg_amenities"),
        stable_avg("review_scores_rating", 2).alias("avg_rating"),
        stable_avg("review_scores_cleanliness", 2).alias("avg_cleanliness"),
        stable_avg("review_scores_location", 2).alias("avg_location_score"),
        stable_avg("review_scores_value", 2).alias("avg_value_score"),
        pct_of(F.count_if(F.col("host_is_superhost")), F.count(F.lit(1))).alias("superhost_pct"),
        pct_of(F.count_if(F.col("instant_bookable")), F.count(F.lit(1))).alias("instant_bookable_pct"),
    )
    return stats.withColumns({
        "price_tier": price_tier("median_price", tiers),
        "updated_at": load_stamp(run_ts),
    })


def review_counts(reviews: DataFrame, key: str = "listing_id") -> DataFrame:
    """Per-listing review count and first / last review date.

    Pre-aggregating before the join keeps the join 1:1 per key; the partial
    aggregate collapses a hot listing on the map side.
    """
    return reviews.groupBy(key).agg(
        F.count("review_id").alias("total_reviews"),
        F.min("review_date").alias("first_review_date"),
        F.max("review_date").alias("last_review_date"),
    )


HOST_KEYS = (
    "host_id", "city", "host_is_superhost", "host_response_rate_pct",
    "host_acceptance_rate_pct", "host_total_listings_count", "host_identity_verified",
)


def host_performance(listings: DataFrame, reviews: DataFrame, host_keys: Sequence[str] = HOST_KEYS,
                     elite_rating: float = HOST_TIER_ELITE_RATING,
                     experienced_rating: float = HOST_TIER_EXPERIENCED_RATING, run_ts=None) -> DataFrame:
    """Host roll-up: listings left-joined to per-listing review counts, then
    grouped by the host attributes (NULL is a group value). Listings without
    reviews count 0 reviews; ``active_days`` is NULL for a host without any."""
    counts = review_counts(reviews)
    joined = listings.join(counts, "listing_id", "left")
    reviews_or_zero = F.coalesce(F.col("total_reviews"), F.lit(0).cast("bigint"))
    stats = joined.groupBy(*host_keys).agg(
        F.count("listing_id").alias("listings_count"),
        stable_avg("price", 2).alias("avg_listing_price"),
        stable_avg("review_scores_rating", 2).alias("avg_rating"),
        stable_avg("review_scores_communication", 2).alias("avg_communication_score"),
        F.sum(reviews_or_zero).alias("total_reviews_received"),
        stable_avg(reviews_or_zero, 1, whole=True).alias("avg_reviews_per_listing"),
        days_between(F.min("first_review_date"), F.max("last_review_date")).alias("active_days"),
    )
    return stats.withColumns({
        "host_tier": host_tier("host_is_superhost", "avg_rating", elite_rating, experienced_rating),
        "updated_at": load_stamp(run_ts),
    })


def monthly_reviews(listings: DataFrame, reviews: DataFrame, min_year: int = REVIEW_YEAR_FLOOR,
                    hot_key_rows: int = HOT_KEY_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Reviews joined N:1 to their listing, counted per (year, month, city,
    room type). The join splits listings with more than ``hot_key_rows``
    reviews across tasks (``hot``: those listings, known beforehand, so that reviews
    are scanned once).

    For the exact distinct counts, the joined rows are first grouped to one row per
    listing and one per reviewer of each group, which keep only counts: what a task
    holds for each row is small. The averages' sums are kept for the groups alone,
    where a listing's values count once for each of its reviews. The joined rows are
    dealt anew in parts of about equal bytes, so that what a task groups doesn't
    grow with the reviews."""
    by = ["review_year", "review_month", "city", "room_type"]
    values = ["review_scores_rating", "review_scores_cleanliness", "review_scores_value", "price"]
    r = reviews.filter(F.col("review_year") >= F.lit(min_year)).select(
        "review_id", "listing_id", "reviewer_id", "review_year", "review_month")
    # of rows that repeat a listing in a group, one counts as active
    same = Window.partitionBy("listing_id", "city", "room_type").orderBy("listing_id")
    l = listings.select("listing_id", "city", "room_type", F.struct((F.row_number().over(same) == 1).alias("counts"), *values).alias("listing"))
    joined = skew_safe_join(r, l, "listing_id", "inner", hot_key_rows, hot).withColumn(
        "listing", F.struct("listing_id", "listing.*")).select(*by, "listing", "reviewer_id", "review_id")
    joined = joined.hint("rebalance", *by, F.col("listing.listing_id"))
    of_listing, of_reviewer = [*by, "listing"], [*by, "reviewer_id"]
    each = joined.groupingSets([of_listing, of_reviewer], *by, "listing", "reviewer_id").agg(
        F.count("review_id").alias("reviews"), F.count(F.lit(1)).alias("rows"), (F.grouping("listing") == 0).alias("is_listing"))
    avg = lambda c: stable_avg(F.when(F.col("is_listing"), F.col("listing")[c]), 2, weight="rows")
    return each.groupBy(*by).agg(
        F.sum(F.when(F.col("is_listing"), F.col("reviews")).otherwise(F.lit(0))).alias("review_count"),
        F.count_if(F.col("is_listing") & F.col("listing.counts")).alias("active_listings"),
        F.count_if(~F.col("is_listing") & F.col("reviewer_id").isNotNull()).alias("unique_reviewers"),
        avg("review_scores_rating").alias("avg_rating"),
        avg("review_scores_cleanliness").alias("avg_cleanliness"),
        avg("review_scores_value").alias("avg_value"),
        avg("price").alias("avg_price"),
    )


def review_trends(listings: DataFrame, reviews: DataFrame, min_year: int = REVIEW_YEAR_FLOOR,
                  run_ts=None, hot_key_rows: int = HOT_KEY_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Monthly review trend per (city, room type) with the previous present
    month's count and the growth against it."""
    monthly = monthly_reviews(listings, reviews, min_year, hot_key_rows, hot)
    monthly = monthly.withColumn("month_start_date", month_start("review_year", "review_month"))
    trended = lag_growth(monthly, "review_count", ["city", "room_type"], ["review_year", "review_month"],
                         prev_name="prev_month_reviews", growth_name="review_growth_pct")
    return trended.withColumn("updated_at", load_stamp(run_ts))
