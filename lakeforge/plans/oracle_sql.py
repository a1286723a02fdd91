"""DuckDB SQL that states, independently of the Spark code, what each
registered query must return on the derived fixtures.

The driver registers the test tables as views; every statement here starts
from those tables. Expression helpers below spell out the shared semantics
(lenient casts, half-up rounding, exact averages) in DuckDB syntax.
"""

from __future__ import annotations

RUN_TS = "2024-01-01 00:00:00"

# The columns and types that the statements hold the code to,
# spelled out here on purpose and not taken from the code under test.
LISTING_COLUMNS = [
    "listing_id", "name", "host_id", "host_since", "host_is_superhost", "host_response_rate",
    "host_acceptance_rate", "host_total_listings_count", "host_has_profile_pic", "host_identity_verified",
    "neighbourhood", "city", "latitude", "longitude", "property_type", "room_type", "accommodates", "bedrooms",
    "amenities", "price", "minimum_nights", "maximum_nights", "review_scores_rating", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_checkin", "review_scores_communication",
    "review_scores_location", "review_scores_value", "instant_bookable",
]
LONG_COLUMNS = ["listing_id", "host_id"]
INT_COLUMNS = ["host_total_listings_count", "accommodates", "bedrooms", "minimum_nights", "maximum_nights"]
DOUBLE_COLUMNS = [
    "price", "latitude", "longitude", "review_scores_rating", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_checkin", "review_scores_communication",
    "review_scores_location", "review_scores_value",
]
FLAG_COLUMNS = [
    "host_is_superhost", "host_has_profile_pic", "host_identity_verified", "instant_bookable",
]
STAGED_LISTING_COLUMNS = [
    "listing_id", "name", "host_id", "host_since", "host_is_superhost", "host_response_rate_pct",
    "host_acceptance_rate_pct", "host_total_listings_count", "host_identity_verified", "neighbourhood", "city",
    "latitude", "longitude", "property_type", "room_type", "accommodates", "bedrooms", "amenities",
    "amenity_count", "price", "minimum_nights", "maximum_nights", "review_scores_rating",
    "review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin",
    "review_scores_communication", "review_scores_location", "review_scores_value", "instant_bookable",
]
AMENITIES = [
    "[]",
    '["Wifi"]',
    '["Wifi", "TV"]',
    '["Wifi", "TV, cable"]',
    "",
    '["Wifi", "TV", "Kitchen", "Heating", "Washer", "Dryer", "Iron", '
    '"Hangers", "Essentials", "Shampoo", "Hair dryer"]',
]
SCORES = {
    "review_scores_rating": 13, "review_scores_accuracy": 7, "review_scores_cleanliness": 3,
    "review_scores_checkin": 17, "review_scores_communication": 19,
    "review_scores_location": 11, "review_scores_value": 9,
}
YEAR_FLOOR = 1997


# ── expression helpers (DuckDB dialect) ─────────────────────────────────────
def to_int(x: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER)"


def to_long(x: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST(trim({x}) AS DECIMAL(38, 6))) AS BIGINT)"


def to_double(x: str) -> str:
    return f"(CASE WHEN isfinite(TRY_CAST({x} AS DOUBLE)) THEN TRY_CAST({x} AS DOUBLE) END)"


def flag(x: str) -> str:
    return f"({x} = 't')"


def pct_text(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({x}, '(\\d+)', 1), '') AS DOUBLE)"


def list_len(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN -1 ELSE CAST(len(string_split("
            f"regexp_replace({x}, '[\\[\\]\"]', '', 'g'), ',')) AS INTEGER) END")


def title(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(trim({x}), ' '), "
            f"lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')")


def rhu(x: str, digits: int) -> str:
    p = 10 ** digits
    return f"(sign({x}) * floor(abs({x}) * {p}.0 + 0.5) / CAST({p} AS DOUBLE) + CAST(0 AS DOUBLE))"


def exact_sum(x: str, scale: int) -> str:
    p = 10 ** scale
    return (f"(CAST(SUM(CAST(sign(CAST({x} AS DOUBLE)) * floor(abs(CAST({x} AS DOUBLE)) * {p}.0 + 0.5) "
            f"AS BIGINT)) AS DOUBLE) / CAST({p} AS DOUBLE))")


def exact_avg(x: str, digits: int) -> str:
    """The exact mean of doubles, rounded once half away from zero: each value as a
    128-bit whole number of 2**-72 (a scaling by a power of two, so exact)."""
    total = f"SUM(CAST(trunc(CAST({x} AS DOUBLE) * 4722366482869645213696.0::DOUBLE) AS HUGEINT))::HUGEINT"
    p, n = 10 ** digits, f"NULLIF(COUNT({x}), 0)::HUGEINT"
    size = f"((2 * abs({total}) * {p} + {n} * 4722366482869645213696) // (2 * {n} * 4722366482869645213696))"
    return f"(sign({total}) * CAST({size} AS DOUBLE) / CAST({p} AS DOUBLE) + CAST(0 AS DOUBLE))"


def avg2(x: str, digits: int, scale: int | None = None) -> str:
    if scale is None:
        return exact_avg(x, digits)
    return rhu(f"({exact_sum(x, scale)} / NULLIF(COUNT({x}), 0))", digits)


def pct(num: str, den: str, digits: int = 1) -> str:
    return rhu(f"(CAST(100 AS DOUBLE) * CAST({num} AS DOUBLE) / CAST(NULLIF({den}, 0) AS DOUBLE))", digits)


def with_(ctes: dict[str, str], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes.items())
    return f"WITH {body}\n{final}"


# ── bronze fixtures ─────────────────────────────────────────────────────────
_AMENITY_CASE = "CASE p_partkey % 6 " + " ".join(
    f"WHEN {i} THEN '{t}'" for i, t in enumerate(AMENITIES)) + " END"


def _price(k="p_partkey", size="p_size"):
    return (f"CASE WHEN {k} % 17 = 3 THEN '' WHEN {k} % 19 = 4 THEN '0' WHEN {k} % 23 = 5 THEN '12000' "
            f"ELSE CAST({size} * 6 AS VARCHAR) || '.50' END")


def _listing_select(price_sql: str) -> str:
    scores = []
    for name, m in SCORES.items():
        s = f"'4.' || CAST(p_partkey * {m} % 10 AS VARCHAR)"
        if name == "review_scores_rating":
            s = f"CASE WHEN p_partkey % 11 = 0 THEN '' ELSE {s} END"
        scores.append(f"{s} AS {name}")
    return f"""SELECT
  CAST(p_partkey AS VARCHAR) AS listing_id,
  p_name AS name,
  CAST(p_partkey % 50 AS VARCHAR) AS host_id,
  CAST(p_partkey % 12 + 2008 AS VARCHAR) || '-01-15' AS host_since,
  CASE WHEN p_partkey % 50 % 3 = 0 THEN 't' WHEN p_partkey % 50 % 3 = 1 THEN 'f' ELSE '' END AS host_is_superhost,
  CASE WHEN p_partkey % 50 % 5 = 0 THEN 'N/A' WHEN p_partkey % 50 % 5 = 1 THEN ''
       ELSE CAST(p_partkey % 50 AS VARCHAR) || '%' END AS host_response_rate,
  CAST(p_partkey % 50 % 50 + 50 AS VARCHAR) || '.5%' AS host_acceptance_rate,
  CAST(p_partkey % 50 % 7 + 1 AS VARCHAR) AS host_total_listings_count,
  CASE WHEN p_partkey % 3 = 0 THEN 'f' ELSE 't' END AS host_has_profile_pic,
  CASE WHEN p_partkey % 50 % 2 = 0 THEN 't' ELSE 'f' END AS host_identity_verified,
  'District ' || CAST(p_partkey % 9 AS VARCHAR) AS neighbourhood,
  '  ' || lower(n_name) || ' ' AS city,
  CAST(p_partkey % 90 AS VARCHAR) || '.25' AS latitude,
  '-' || CAST(p_partkey % 180 AS VARCHAR) || '.5' AS longitude,
  p_brand AS property_type,
  p_type AS room_type,
  CAST(p_size % 8 + 1 AS VARCHAR) AS accommodates,
  CASE WHEN p_size % 9 = 0 THEN '' ELSE CAST(p_size % 5 AS VARCHAR) || '.0' END AS bedrooms,
  {_AMENITY_CASE} AS amenities,
  {price_sql} AS price,
  CAST(p_partkey % 5 + 1 AS VARCHAR) AS minimum_nights,
  CAST(p_partkey % 5 * 30 + 30 AS VARCHAR) AS maximum_nights,
  {", ".join(scores)},
  CASE WHEN p_partkey % 4 = 0 THEN 't' ELSE 'f' END AS instant_bookable
FROM part JOIN nation ON p_partkey % 25 = n_nationkey"""


BRONZE_LISTINGS = (
    _listing_select(_price())
    + "\nUNION ALL\n"
    + _listing_select("CASE WHEN p_partkey % 2 = 0 THEN '' WHEN p_partkey % 3 = 0 "
                      "THEN CAST(p_size * 6 + 1 AS VARCHAR) || '.50' ELSE " + _price() + " END")
)

BRONZE_REVIEWS = """SELECT
  CAST(l_partkey AS VARCHAR) AS listing_id,
  CAST(CAST(l_orderkey AS BIGINT) * 8 + l_linenumber + 3000000000 AS VARCHAR) AS review_id,
  CASE WHEN l_partkey % 29 = 0 THEN '' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
  CAST(o_custkey AS VARCHAR) AS reviewer_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


# ── silver ──────────────────────────────────────────────────────────────────
def _silver_listing_columns() -> list[tuple[str, str]]:
    out = []
    for c in LISTING_COLUMNS:
        if c in ("host_response_rate", "host_acceptance_rate"):
            continue
        if c in LONG_COLUMNS:
            out.append((c, to_long(c)))
        elif c in INT_COLUMNS:
            out.append((c, to_int(c)))
        elif c in DOUBLE_COLUMNS:
            out.append((c, to_double(c)))
        elif c in FLAG_COLUMNS:
            out.append((c, flag(c)))
        elif c == "city":
            out.append((c, title(c)))
        else:
            out.append((c, c))
    out.append(("host_response_rate_pct", pct_text("host_response_rate")))
    out.append(("host_acceptance_rate_pct", pct_text("host_acceptance_rate")))
    out.append(("amenity_count", list_len("amenities")))
    return out


SILVER_LISTING_COLUMNS = [c for c, _ in _silver_listing_columns()] + ["source_layer"]

SILVER_LISTINGS = f"""SELECT * FROM (
  SELECT {", ".join(f"{e} AS {c}" for c, e in _silver_listing_columns())}, 'silver' AS source_layer
  FROM bronze_listings
) t
WHERE listing_id IS NOT NULL AND city IS NOT NULL AND price > 0 AND price < 10000
QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY
  {" + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in SILVER_LISTING_COLUMNS if c != "listing_id")},
  {", ".join(f"{c} ASC NULLS FIRST" for c in SILVER_LISTING_COLUMNS if c != "listing_id")}) = 1"""

SILVER_REVIEWS = f"""SELECT * FROM (
  SELECT {to_long("listing_id")} AS listing_id, {to_long("review_id")} AS review_id,
         {to_long("reviewer_id")} AS reviewer_id,
         CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS review_date,
         CAST(year(CAST(try_strptime(date, '%Y-%m-%d') AS DATE)) AS INTEGER) AS review_year,
         CAST(month(CAST(try_strptime(date, '%Y-%m-%d') AS DATE)) AS INTEGER) AS review_month
  FROM bronze_reviews
) t
WHERE review_id IS NOT NULL AND listing_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY review_date DESC NULLS LAST,
  listing_id ASC NULLS FIRST, reviewer_id ASC NULLS FIRST) = 1"""

STG_LISTINGS = f"""SELECT {", ".join(STAGED_LISTING_COLUMNS)}
FROM silver_listings WHERE listing_id IS NOT NULL AND price > 0"""

STG_REVIEWS = f"""SELECT review_id, listing_id, reviewer_id, review_date, review_year, review_month FROM silver_reviews
WHERE review_id IS NOT NULL AND listing_id IS NOT NULL AND review_date IS NOT NULL"""

BASE_CTES = {
    "bronze_listings": BRONZE_LISTINGS,
    "bronze_reviews": BRONZE_REVIEWS,
    "silver_listings": SILVER_LISTINGS,
    "silver_reviews": SILVER_REVIEWS,
    "stg_listings": STG_LISTINGS,
    "stg_reviews": STG_REVIEWS,
}


def ctes(*names: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    """The named base CTEs (with their dependencies, in order) plus extras."""
    deps = {
        "bronze_listings": [], "bronze_reviews": [],
        "silver_listings": ["bronze_listings"], "silver_reviews": ["bronze_reviews"],
        "stg_listings": ["silver_listings"], "stg_reviews": ["silver_reviews"],
    }
    need: list[str] = []

    def add(n):
        for d in deps[n]:
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    out = {n: BASE_CTES[n] for n in [m for m in BASE_CTES if m in need]}
    out.update(extra or {})
    return out


# ── gold marts ──────────────────────────────────────────────────────────────
def price_tier_case(x: str) -> str:
    return (f"CASE WHEN {x} < 50 THEN 'Budget' WHEN {x} < 100 THEN 'Mid-range' "
            f"WHEN {x} < 200 THEN 'Premium' ELSE 'Luxury' END")


MART_CITY_PRICING = f"""SELECT *, {price_tier_case("median_price")} AS price_tier FROM (
SELECT city, room_type,
  COUNT(listing_id) AS total_listings,
  COUNT(DISTINCT property_type) AS distinct_property_types,
  {avg2("price", 2)} AS avg_price,
  {rhu("quantile_disc(price, 0.5)", 2)} AS median_price,
  {rhu("MIN(price)", 2)} AS min_price,
  {rhu("MAX(price)", 2)} AS max_price,
  {rhu("stddev_samp(price)", 2)} AS stddev_price,
  {avg2("bedrooms", 1, 0)} AS avg_bedrooms,
  {avg2("accommodates", 1, 0)} AS avg_accommodates,
  {avg2("amenity_count", 1, 0)} AS avg_amenities,
  {avg2("review_scores_rating", 2)} AS avg_rating,
  {avg2("review_scores_cleanliness", 2)} AS avg_cleanliness,
  {avg2("review_scores_location", 2)} AS avg_location_score,
  {avg2("review_scores_value", 2)} AS avg_value_score,
  {pct("count_if(host_is_superhost)", "COUNT(*)")} AS superhost_pct,
  {pct("count_if(instant_bookable)", "COUNT(*)")} AS instant_bookable_pct
FROM stg_listings WHERE city IS NOT NULL
GROUP BY city, room_type) s"""

REVIEW_COUNTS = """SELECT listing_id, COUNT(review_id) AS total_reviews,
  MIN(review_date) AS first_review_date, MAX(review_date) AS last_review_date
FROM stg_reviews GROUP BY listing_id"""

HOST_KEYS = ("host_id, city, host_is_superhost, host_response_rate_pct, host_acceptance_rate_pct, "
             "host_total_listings_count, host_identity_verified")


def host_tier_case(s: str, r: str) -> str:
    return (f"CASE WHEN {s} AND {r} >= 4.8 THEN 'Elite' WHEN {s} THEN 'Superhost' "
            f"WHEN {r} >= 4.5 THEN 'Experienced' ELSE 'Standard' END")


MART_HOST_PERFORMANCE = f"""SELECT *, {host_tier_case("host_is_superhost", "avg_rating")} AS host_tier FROM (
SELECT {", ".join("l." + k.strip() for k in HOST_KEYS.split(","))},
  COUNT(l.listing_id) AS listings_count,
  {avg2("l.price", 2)} AS avg_listing_price,
  {avg2("l.review_scores_rating", 2)} AS avg_rating,
  {avg2("l.review_scores_communication", 2)} AS avg_communication_score,
  CAST(SUM(COALESCE(r.total_reviews, 0)) AS BIGINT) AS total_reviews_received,
  {avg2("COALESCE(r.total_reviews, 0)", 1, 0)} AS avg_reviews_per_listing,
  CAST(date_diff('day', MIN(r.first_review_date), MAX(r.last_review_date)) AS BIGINT) AS active_days
FROM stg_listings l LEFT JOIN review_counts r ON l.listing_id = r.listing_id
GROUP BY {", ".join("l." + k.strip() for k in HOST_KEYS.split(","))}) s"""


def monthly_reviews(min_year: int) -> str:
    return f"""SELECT r.review_year, r.review_month, l.city, l.room_type,
  COUNT(r.review_id) AS review_count,
  COUNT(DISTINCT r.listing_id) AS active_listings,
  COUNT(DISTINCT r.reviewer_id) AS unique_reviewers,
  {avg2("l.review_scores_rating", 2)} AS avg_rating,
  {avg2("l.review_scores_cleanliness", 2)} AS avg_cleanliness,
  {avg2("l.review_scores_value", 2)} AS avg_value,
  {avg2("l.price", 2)} AS avg_price
FROM stg_reviews r JOIN stg_listings l ON r.listing_id = l.listing_id
WHERE r.review_year >= {min_year}
GROUP BY r.review_year, r.review_month, l.city, l.room_type"""


_LAG = "LAG(review_count) OVER (PARTITION BY city, room_type ORDER BY review_year, review_month)"

MART_REVIEW_TRENDS_FINAL = f"""SELECT *,
  make_date(CAST(review_year AS BIGINT), CAST(review_month AS BIGINT), 1) AS month_start_date,
  {_LAG} AS prev_month_reviews,
  {pct(f"(review_count - {_LAG})", _LAG)} AS review_growth_pct
FROM monthly_reviews"""


def marts_ctes(min_year: int = YEAR_FLOOR) -> dict[str, str]:
    return ctes("stg_listings", "stg_reviews", extra={
        "mart_city_pricing": MART_CITY_PRICING,
        "review_counts": REVIEW_COUNTS,
        "mart_host_performance": MART_HOST_PERFORMANCE,
        "monthly_reviews": monthly_reviews(min_year),
        "mart_review_trends": MART_REVIEW_TRENDS_FINAL,
    })


def over_marts(final: str, min_year: int = YEAR_FLOOR) -> str:
    return with_(marts_ctes(min_year), final)
