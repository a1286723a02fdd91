"""Searched-CASE labels with SQL NULL semantics (a NULL test falls through)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeforge.functions._col import as_col

# Fixed values that must equal the reference's labels and thresholds.
PRICE_TIERS = [(50, "Budget"), (100, "Mid-range"), (200, "Premium")]
PRICE_TIER_ELSE = "Luxury"
AMENITY_BUCKETS = [(5, "Few (<5)"), (10, "Medium (5-10)")]
AMENITY_BUCKET_ELSE = "Many (10+)"
HOST_TIER_ELITE_RATING = 4.8
HOST_TIER_EXPERIENCED_RATING = 4.5
HOST_TIER_LABELS = ("Elite", "Superhost", "Experienced", "Standard")


def bucketize(c: Column | str, upper_bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose exclusive upper bound exceeds the value; else
    ``otherwise`` (NULL values also land in ``otherwise``)."""
    x = as_col(c)
    expr = None
    for bound, label in upper_bounds:
        expr = (F.when(x < F.lit(bound), F.lit(label)) if expr is None
                else expr.when(x < F.lit(bound), F.lit(label)))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))


def price_tier(c: Column | str, tiers=PRICE_TIERS, otherwise: str = PRICE_TIER_ELSE) -> Column:
    return bucketize(c, tiers, otherwise)


def amenity_bucket(c: Column | str, buckets=AMENITY_BUCKETS, otherwise: str = AMENITY_BUCKET_ELSE) -> Column:
    return bucketize(c, buckets, otherwise)


def host_tier(superhost: Column | str, rating: Column | str,
              elite_rating: float = HOST_TIER_ELITE_RATING,
              experienced_rating: float = HOST_TIER_EXPERIENCED_RATING,
              labels: tuple[str, str, str, str] = HOST_TIER_LABELS) -> Column:
    """superhost and rating >= elite -> Elite; superhost -> Superhost;
    rating >= experienced -> Experienced; else Standard."""
    s, r = as_col(superhost), as_col(rating)
    elite, superh, experienced, standard = labels
    return (F.when(s & (r >= F.lit(elite_rating)), F.lit(elite))
            .when(s, F.lit(superh))
            .when(r >= F.lit(experienced_rating), F.lit(experienced))
            .otherwise(F.lit(standard)))
