"""Column specs for every layer.

Bronze holds text only; silver types are declared here once. Ids are BIGINT,
so that no id of a large table is lost.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ── Fixed values: column names of the listing / review records ─────────────
BRONZE_LISTING_COLUMNS = [
    "listing_id", "name", "host_id", "host_since", "host_is_superhost",
    "host_response_rate", "host_acceptance_rate", "host_total_listings_count",
    "host_has_profile_pic", "host_identity_verified", "neighbourhood", "city",
    "latitude", "longitude", "property_type", "room_type", "accommodates",
    "bedrooms", "amenities", "price", "minimum_nights", "maximum_nights",
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_location",
    "review_scores_value", "instant_bookable",
]
BRONZE_REVIEW_COLUMNS = ["listing_id", "review_id", "date", "reviewer_id"]

# Partition columns the bronze folder layout adds on read (year=/month=/day=).
INGEST_PARTITION_COLUMNS = ["year", "month", "day"]

LISTING_LONG_COLUMNS = ["listing_id", "host_id"]
LISTING_INT_COLUMNS = [
    "accommodates", "bedrooms", "minimum_nights", "maximum_nights", "host_total_listings_count",
]
LISTING_DOUBLE_COLUMNS = [
    "price", "latitude", "longitude",
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_location",
    "review_scores_value",
]
LISTING_FLAG_COLUMNS = [
    "host_is_superhost", "host_has_profile_pic", "host_identity_verified", "instant_bookable",
]
# raw percent text column -> parsed DOUBLE column
LISTING_PCT_COLUMNS = {
    "host_response_rate": "host_response_rate_pct",
    "host_acceptance_rate": "host_acceptance_rate_pct",
}
# raw list text column -> item count column
LISTING_LIST_COUNT_COLUMNS = {"amenities": "amenity_count"}
LISTING_TITLE_CASE_COLUMNS = ["city"]

REVIEW_LONG_COLUMNS = ["review_id", "listing_id", "reviewer_id"]

STG_LISTING_COLUMNS = [
    "listing_id", "name", "host_id", "host_since", "host_is_superhost",
    "host_response_rate_pct", "host_acceptance_rate_pct", "host_total_listings_count",
    "host_identity_verified", "neighbourhood", "city", "latitude", "longitude",
    "property_type", "room_type", "accommodates", "bedrooms", "amenities",
    "amenity_count", "price", "minimum_nights", "maximum_nights",
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_location",
    "review_scores_value", "instant_bookable", "ingested_at",
]
STG_REVIEW_COLUMNS = [
    "review_id", "listing_id", "reviewer_id", "review_date", "review_year", "review_month",
]

# Accepted cities and room types of the quality tests.
ACCEPTED_CITIES = [
    "Paris", "New York", "Sydney", "Rio De Janeiro", "Istanbul", "Rome",
    "Bangkok", "Cape Town", "Mexico City", "Hong Kong",
]
ACCEPTED_ROOM_TYPES = ["Entire place", "Private room", "Hotel room", "Shared room"]

# Topic names (ours) and the message key field of each topic.
LISTINGS_TOPIC = "listings.raw"
REVIEWS_TOPIC = "reviews.raw"
TOPIC_KEYS = {LISTINGS_TOPIC: "listing_id", REVIEWS_TOPIC: "review_id"}
# Fixed value: records per bronze file.
BRONZE_FILE_RECORDS = 5000


def text_schema(columns: list[str]) -> T.StructType:
    """All-STRING schema for raw records (no inference pass over the data)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


TOPIC_MESSAGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])
