"""Bronze listing / review records derived from the TPC-H-style test tables.

The test tables hold no listings or reviews, so raw text records of that
shape are derived with Spark from ``part`` x ``nation`` (listings) and
``lineitem`` x ``orders`` (reviews), covering the edge cases the cleaners
must handle: blank and non-numeric numbers, zero and out-of-range prices,
``'N/A'`` rates, empty flags, padded lower-case cities, empty / nested lists,
blank dates and duplicate keys (an invalid copy and a differing valid copy).
Every row of the source tables is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The amenity texts cycled through by the listing fixture.
AMENITY_TEXTS = [
    "[]",
    '["Wifi"]',
    '["Wifi", "TV"]',
    '["Wifi", "TV, cable"]',
    "",
    '["Wifi", "TV", "Kitchen", "Heating", "Washer", "Dryer", "Iron", '
    '"Hangers", "Essentials", "Shampoo", "Hair dryer"]',
]
# Multipliers of the review sub-scores (rating, accuracy,
# cleanliness, checkin, communication, location, value).
SCORE_MULTIPLIERS = {
    "review_scores_rating": 13, "review_scores_accuracy": 7, "review_scores_cleanliness": 3,
    "review_scores_checkin": 17, "review_scores_communication": 19,
    "review_scores_location": 11, "review_scores_value": 9,
}
# Review year floor and accepted room types that suit this data.
FIXTURE_YEAR_FLOOR = 1997
FIXTURE_ROOM_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
FIXTURE_CITIES = [f"Nation_{i}" for i in range(25)]
FIXTURE_TOP_ROOM_TYPE = "STANDARD"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _listing_price(k: Column, size: Column) -> Column:
    return (F.when(k % 17 == 3, F.lit(""))
            .when(k % 19 == 4, F.lit("0"))
            .when(k % 23 == 5, F.lit("12000"))
            .otherwise(F.concat(_s(size * 6), F.lit(".50"))))


def bronze_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing records (all STRING), two copies of each part.

    The second copy has a blank price on even keys (must never win), a
    different valid price on other multiples of 3 (a tie broken by the
    deterministic dedup order) and is an exact copy otherwise.
    """
    part = read_table(spark, sf_dir, "part")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = part.join(nation, (F.col("p_partkey") % 25) == F.col("n_nationkey"))
    k, size = F.col("p_partkey"), F.col("p_size")
    h = k % 50
    amenity = F.element_at(F.array(*[F.lit(a) for a in AMENITY_TEXTS]), (k % 6 + 1).cast("int"))
    cols = {
        "listing_id": _s(k),
        "name": F.col("p_name"),
        "host_id": _s(h),
        "host_since": F.concat(_s(k % 12 + 2008), F.lit("-01-15")),
        "host_is_superhost": F.when(h % 3 == 0, F.lit("t")).when(h % 3 == 1, F.lit("f")).otherwise(F.lit("")),
        "host_response_rate": (F.when(h % 5 == 0, F.lit("N/A")).when(h % 5 == 1, F.lit(""))
                               .otherwise(F.concat(_s(h), F.lit("%")))),
        "host_acceptance_rate": F.concat(_s(h % 50 + 50), F.lit(".5%")),
        "host_total_listings_count": _s(h % 7 + 1),
        "host_has_profile_pic": F.when(k % 3 == 0, F.lit("f")).otherwise(F.lit("t")),
        "host_identity_verified": F.when(h % 2 == 0, F.lit("t")).otherwise(F.lit("f")),
        "neighbourhood": F.concat(F.lit("District "), _s(k % 9)),
        "city": F.concat(F.lit("  "), F.lower(F.col("n_name")), F.lit(" ")),
        "latitude": F.concat(_s(k % 90), F.lit(".25")),
        "longitude": F.concat(F.lit("-"), _s(k % 180), F.lit(".5")),
        "property_type": F.col("p_brand"),
        "room_type": F.col("p_type"),
        "accommodates": _s(size % 8 + 1),
        "bedrooms": F.when(size % 9 == 0, F.lit("")).otherwise(F.concat(_s(size % 5), F.lit(".0"))),
        "amenities": amenity,
        "price": _listing_price(k, size),
        "minimum_nights": _s(k % 5 + 1),
        "maximum_nights": _s(k % 5 * 30 + 30),
    }
    for name, m in SCORE_MULTIPLIERS.items():
        score = F.concat(F.lit("4."), _s(k * m % 10))
        cols[name] = F.when(k % 11 == 0, F.lit("")).otherwise(score) if name == "review_scores_rating" else score
    cols["instant_bookable"] = F.when(k % 4 == 0, F.lit("t")).otherwise(F.lit("f"))
    first = base.select(*[c.alias(n) for n, c in cols.items()])
    copy_price = (F.when(k % 2 == 0, F.lit(""))
                  .when(k % 3 == 0, F.concat(_s(size * 6 + 1), F.lit(".50")))
                  .otherwise(_listing_price(k, size)))
    second = base.select(*[(copy_price if n == "price" else c).alias(n) for n, c in cols.items()])
    return first.unionByName(second)


def bronze_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw review records (all STRING), one per line item. Review ids repeat
    where the source repeats (order, line) pairs, and need 64 bits; parts with key % 29 == 0
    get blank dates, so their listings end up without staged reviews."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        _s(F.col("l_partkey")).alias("listing_id"),
        _s(F.col("l_orderkey").cast("bigint") * 8 + F.col("l_linenumber") + F.lit(3_000_000_000)).alias("review_id"),
        F.when(F.col("l_partkey") % 29 == 0, F.lit(""))
         .otherwise(F.date_format(F.col("l_shipdate"), "yyyy-MM-dd")).alias("date"),
        _s(F.col("o_custkey")).alias("reviewer_id"),
    )
