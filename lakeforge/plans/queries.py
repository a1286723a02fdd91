"""Query registrations (Spark builder + DuckDB oracle) for every operator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge import functions as LF
from lakeforge import schemas as S
from lakeforge.operators import quality as Q
from lakeforge.operators.clean import REVIEW_DEDUP_ORDER, review_projection
from lakeforge.operators.dedup import dedup_by_key
from lakeforge.plans import bi, ledger, marts
from lakeforge.plans import fixtures as FX
from lakeforge.plans import oracle_sql as O
from lakeforge.plans.layers import RUN_TS, FixtureLayers
from lakeforge.plans.pipeline import (STEPS, PipelineConfig, bronze_to_silver, catalog, ingest, land, mart_order, new_run_root, run_concurrently,
                                      run_pipeline, silver_to_staging)
from lakeforge.plans.registry import register
from lakeforge.sources import tables as TB
from lakeforge.sources.bronze import read_bronze
from lakeforge.sources.csv import read_csv_records, write_csv_records
from lakeforge.sources.csv_split import read_csv_split
from lakeforge.streaming.compact import compact, live_files, read_live
from lakeforge.streaming.flush import CountedLanding
from lakeforge.streaming.ingest import land_topics
from lakeforge.sources.topics import ingest_accounting, ingest_counts, parse_messages, read_topic_log, to_topic_messages

NO_TS = ("ingested_at", "updated_at")


def _layers(spark: SparkSession, sf_dir: str, **kw) -> FixtureLayers:
    return FixtureLayers(spark, sf_dir, **kw)


def _gold(spark: SparkSession, sf_dir: str, **kw) -> FixtureLayers:
    """Layers for the review-trend marts: staged reviews are written once, which
    also finds the listings whose reviews the joins split over tasks."""
    return FixtureLayers(spark, sf_dir, materialize=("stg_reviews",), **kw)


def _gold_all(spark: SparkSession, sf_dir: str, **kw) -> FixtureLayers:
    """Layers whose staging tables are both written once (read by many checks)."""
    return FixtureLayers(spark, sf_dir, materialize=("stg_listings", "stg_reviews"), **kw)


def _gold_listings(spark: SparkSession, sf_dir: str, **kw) -> FixtureLayers:
    """Layers whose staged listings are written once."""
    return FixtureLayers(spark, sf_dir, materialize=("stg_listings",), **kw)


def _drop_ts(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in NO_TS if c in df.columns])


# ── cleaning and staging ────────────────────────────────────────────────────
@register("clean_listings", O.with_(O.ctes("silver_listings"), "SELECT * FROM silver_listings"))
def q_clean_listings(spark, sf_dir):
    return _drop_ts(_layers(spark, sf_dir).silver_listings)


@register("clean_reviews", O.with_(O.ctes("silver_reviews"), "SELECT * FROM silver_reviews"))
def q_clean_reviews(spark, sf_dir):
    return _drop_ts(_layers(spark, sf_dir).silver_reviews)


@register("stg_listings", O.with_(O.ctes("stg_listings"), "SELECT * FROM stg_listings"))
def q_stg_listings(spark, sf_dir):
    return _drop_ts(_layers(spark, sf_dir).stg_listings)


@register("stg_reviews", O.with_(O.ctes("stg_reviews"), "SELECT * FROM stg_reviews"))
def q_stg_reviews(spark, sf_dir):
    return _layers(spark, sf_dir).stg_reviews


# ── gold marts ──────────────────────────────────────────────────────────────
@register("mart_city_pricing", O.over_marts("SELECT * FROM mart_city_pricing"))
def q_mart_city_pricing(spark, sf_dir):
    return _drop_ts(_layers(spark, sf_dir).mart_city_pricing)


@register("mart_host_performance", O.over_marts("SELECT * FROM mart_host_performance"))
def q_mart_host_performance(spark, sf_dir):
    return _drop_ts(_layers(spark, sf_dir).mart_host_performance)


@register("mart_review_trends", O.over_marts("SELECT * FROM mart_review_trends"))
def q_mart_review_trends(spark, sf_dir):
    return _drop_ts(_gold(spark, sf_dir).mart_review_trends)


@register("trends_split_keys", O.over_marts("SELECT * FROM mart_review_trends"))
def q_trends_split_keys(spark, sf_dir):
    """The trends mart where a listing of more than 20 reviews is a hot key: its
    join takes the salted path."""
    return _drop_ts(_gold(spark, sf_dir, hot_key_rows=20).mart_review_trends)


# ── scalar functions on raw records ─────────────────────────────────────────



def _bl(ctes=("bronze_listings",)):
    return O.ctes(*ctes)


@register("lenient_casts", O.with_(_bl(), f"""SELECT listing_id AS listing_id_text,
  {O.to_int("listing_id")} AS listing_id, {O.to_int("bedrooms")} AS bedrooms,
  {O.to_int("accommodates")} AS accommodates, {O.to_double("price")} AS price,
  {O.to_double("review_scores_rating")} AS review_scores_rating, bedrooms AS bedrooms_text, price AS price_text
FROM bronze_listings"""))
def q_lenient_casts(spark, sf_dir):
    b = FX.bronze_listings(spark, sf_dir)
    return b.select(F.col("listing_id").alias("listing_id_text"), LF.to_int("listing_id").alias("listing_id"),
                    LF.to_int("bedrooms").alias("bedrooms"), LF.to_int("accommodates").alias("accommodates"),
                    LF.to_double("price").alias("price"),
                    LF.to_double("review_scores_rating").alias("review_scores_rating"),
                    F.col("bedrooms").alias("bedrooms_text"), F.col("price").alias("price_text"))


_FLAGS = S.LISTING_FLAG_COLUMNS


@register("flag_normalize", O.with_(_bl(), "SELECT listing_id, " + ", ".join(
    f"{c} AS {c}_text, {O.flag(c)} AS {c}" for c in _FLAGS) + " FROM bronze_listings"))
def q_flag_normalize(spark, sf_dir):
    b = FX.bronze_listings(spark, sf_dir)
    cols = [F.col("listing_id")]
    for c in _FLAGS:
        cols += [F.col(c).alias(f"{c}_text"), LF.flag(c).alias(c)]
    return b.select(*cols)


@register("pct_parse", O.with_(_bl(), f"""SELECT listing_id, host_response_rate, host_acceptance_rate,
  {O.pct_text("host_response_rate")} AS host_response_rate_pct,
  {O.pct_text("host_acceptance_rate")} AS host_acceptance_rate_pct FROM bronze_listings"""))
def q_pct_parse(spark, sf_dir):
    b = FX.bronze_listings(spark, sf_dir)
    return b.select("listing_id", "host_response_rate", "host_acceptance_rate",
                    LF.pct_from_text("host_response_rate").alias("host_response_rate_pct"),
                    LF.pct_from_text("host_acceptance_rate").alias("host_acceptance_rate_pct"))


@register("amenity_count", O.with_(_bl(), f"""SELECT listing_id, amenities,
  {O.list_len("amenities")} AS amenity_count FROM bronze_listings"""))
def q_amenity_count(spark, sf_dir):
    b = FX.bronze_listings(spark, sf_dir)
    return b.select("listing_id", "amenities", LF.list_length("amenities").alias("amenity_count"))


@register("city_normalize", O.with_(_bl(), f"""SELECT listing_id, city AS city_text,
  {O.title("city")} AS city FROM bronze_listings"""))
def q_city_normalize(spark, sf_dir):
    b = FX.bronze_listings(spark, sf_dir)
    return b.select("listing_id", F.col("city").alias("city_text"), LF.title_case("city").alias("city"))


_DATE = "CAST(try_strptime(date, '%Y-%m-%d') AS DATE)"


@register("review_date_parts", O.with_(O.ctes("bronze_reviews"), f"""SELECT review_id, date,
  {_DATE} AS review_date, CAST(year({_DATE}) AS INTEGER) AS review_year,
  CAST(month({_DATE}) AS INTEGER) AS review_month FROM bronze_reviews"""))
def q_review_date_parts(spark, sf_dir):
    b = FX.bronze_reviews(spark, sf_dir)
    d = LF.to_date_lenient("date")
    return b.select("review_id", "date", d.alias("review_date"), F.year(d).alias("review_year"),
                    F.month(d).alias("review_month"))


@register("month_start", O.with_(O.ctes("stg_reviews"), """SELECT review_year, review_month,
  COUNT(*) AS review_count,
  make_date(CAST(review_year AS BIGINT), CAST(review_month AS BIGINT), 1) AS month_start_date,
  CAST(try_strptime(CAST(review_year AS VARCHAR) || '-' || lpad(CAST(review_month AS VARCHAR), 2, '0') || '-01',
       '%Y-%m-%d') AS DATE) AS month_start_text
FROM stg_reviews GROUP BY review_year, review_month"""))
def q_month_start(spark, sf_dir):
    r = _layers(spark, sf_dir).stg_reviews
    return (r.groupBy("review_year", "review_month").agg(F.count(F.lit(1)).alias("review_count"))
            .withColumns({"month_start_date": LF.month_start("review_year", "review_month"),
                          "month_start_text": LF.month_start_text("review_year", "review_month")}))


# ── dedup ───────────────────────────────────────────────────────────────────
@register("dedup_listings", O.with_(_bl(), "SELECT * FROM bronze_listings QUALIFY row_number() OVER "
          "(PARTITION BY listing_id ORDER BY " + ", ".join(
              f"{c} ASC NULLS FIRST" for c in S.BRONZE_LISTING_COLUMNS if c != "listing_id") + ") = 1"))
def q_dedup_listings(spark, sf_dir):
    """Raw listings, one row per raw key under the all-columns order."""
    return dedup_by_key(FX.bronze_listings(spark, sf_dir), ["listing_id"])


@register("dedup_reviews", O.with_(O.ctes("bronze_reviews"), f"""SELECT * FROM (
  SELECT {O.to_long("listing_id")} AS listing_id, {O.to_long("review_id")} AS review_id,
         {O.to_long("reviewer_id")} AS reviewer_id, {_DATE} AS review_date,
         CAST(year({_DATE}) AS INTEGER) AS review_year, CAST(month({_DATE}) AS INTEGER) AS review_month
  FROM bronze_reviews) t
QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY review_date DESC NULLS LAST,
  listing_id ASC NULLS FIRST, reviewer_id ASC NULLS FIRST) = 1"""))
def q_dedup_reviews(spark, sf_dir):
    """Typed reviews, one row per review id (NULL ids form one group)."""
    typed = FX.bronze_reviews(spark, sf_dir).select(*review_projection(FX.bronze_reviews(spark, sf_dir)))
    return dedup_by_key(typed.drop("ingested_at"), ["review_id"], REVIEW_DEDUP_ORDER)


# ── aggregates and windows (pieces of the marts) ───────────────────────────
@register("review_counts", O.with_(O.ctes("stg_reviews", extra={"rc": O.REVIEW_COUNTS}), "SELECT * FROM rc"))
def q_review_counts(spark, sf_dir):
    return marts.review_counts(_layers(spark, sf_dir).stg_reviews)


@register("multi_distinct", O.over_marts(
    "SELECT review_year, review_month, city, room_type, review_count, active_listings, unique_reviewers "
    "FROM monthly_reviews"))
def q_multi_distinct(spark, sf_dir):
    lay = _gold(spark, sf_dir)
    return marts.monthly_reviews(lay.stg_listings, lay.stg_reviews, lay.min_year, hot=lay.hot_listings).select(
        "review_year", "review_month", "city", "room_type", "review_count", "active_listings", "unique_reviewers")


@register("median_exact", O.over_marts("SELECT city, room_type, median_price FROM mart_city_pricing"))
def q_median_exact(spark, sf_dir):
    return _layers(spark, sf_dir, median="exact").mart_city_pricing.select("city", "room_type", "median_price")


@register("median_approx", O.with_(O.ctes("stg_listings"), """
SELECT 'room' AS level, city, room_type, COUNT(*) AS n, true AS approx_within, true AS sketch_within, true AS merge_within FROM stg_listings GROUP BY city, room_type
UNION ALL SELECT 'city', city, NULL, COUNT(*), true, true, true FROM stg_listings GROUP BY city
UNION ALL SELECT 'all', NULL, NULL, COUNT(*), true, true, true FROM stg_listings"""))
def q_median_approx(spark, sf_dir):
    """The approximate medians against exact ranks, per room type, city and overall:
    the mart's ``percentile_approx``, a sketch of the group's rows, and the sketch
    merged from the stored ones per city and room type. True: the value's exact
    rank is within the stated error."""
    staged = _gold_listings(spark, sf_dir).stg_listings.select("city", "room_type", "price", F.lit("all").alias("everything"))
    path = new_run_root(spark, "queries") + "/gold/price_sketches"
    stored = TB.materialize(marts.price_sketches(staged, ("everything", "city", "room_type")), path=path)
    bounds = {"approx": 1 / marts.MEDIAN_ACCURACY, "sketch": 2 * LF.rank_error(), "merge": 2 * LF.rank_error()}
    out = None
    for level, keys in (("room", ["city", "room_type"]), ("city", ["city"]), ("all", ["everything"])):
        merged = marts.coarser_sketches(stored, keys).select(*[F.col(k).alias(f"m_{k}") for k in keys], LF.sketch_quantile("sketch").alias("merge"), LF.sketch_rows("sketch").alias("merged_rows"))
        direct = staged.groupBy(*keys).agg(F.count("price").alias("n"), marts.median_expr("price", "approx").alias("approx"), marts.median_expr("price", "sketch").alias("sketch"))
        found = direct.join(merged, [F.col(k).eqNullSafe(F.col(f"m_{k}")) for k in keys]).where(F.col("merged_rows") == F.col("n"))
        for name, error in bounds.items():
            found = marts.with_rank(found, staged, keys, "price", name)
            # an observed value holds all ranks from below it to it; one row's share is the least step
            slack = F.lit(error) + 1 / F.col("n")
            found = found.withColumn(f"{name}_within", (F.col("share_below") <= 0.5 + slack) & (F.col("share_upto") >= 0.5 - slack)).drop("share_below", "share_upto")
        rows = found.select(F.lit(level).alias("level"), *[F.col(c) if c in keys else F.lit(None).cast("string").alias(c) for c in ("city", "room_type")], "n", *[f"{b}_within" for b in bounds])
        out = rows if out is None else out.unionByName(rows)
    return out


@register("exact_averages", O.with_(O.ctes("stg_listings", extra={"sevenths": """
SELECT city, room_type, host_id, price / 7 AS x, CASE WHEN host_id % 2 = 0 THEN -price / 3 ELSE price / 7 END AS signed,
  price / 7000000 AS small FROM stg_listings"""}), "\nUNION ALL\n".join(
    f"SELECT '{level}' AS level, {key} AS key, COUNT(*) AS n, {O.exact_avg('x', 2)} AS avg_x, {O.exact_avg('x', 0)} AS avg_x_whole, "
    f"{O.exact_avg('signed', 2)} AS avg_signed, {O.exact_avg('small', 4)} AS avg_small FROM sevenths GROUP BY ALL"
    for level, key in (("city", "city"), ("room", "room_type"), ("host", "CAST(host_id AS VARCHAR)"), ("all", "'all'")))))
def q_exact_averages(spark, sf_dir):
    """Averages of values without a short decimal form, of both signs, at four
    levels of grouping."""
    price = F.col("price")
    base = _layers(spark, sf_dir).stg_listings.select(
        "city", "room_type", F.col("host_id").cast("string").alias("host"), F.lit("all").alias("all"), (price / 7).alias("x"),
        F.when(F.col("host_id") % 2 == 0, -price / 3).otherwise(price / 7).alias("signed"), (price / 7000000).alias("small"))
    keyed = base.select("x", "signed", "small", F.explode(F.create_map(
        *[c for level, col in (("city", "city"), ("room", "room_type"), ("host", "host"), ("all", "all"))
          for c in (F.lit(level), F.col(col))])).alias("level", "key"))
    return keyed.groupBy("level", "key").agg(
        F.count(F.lit(1)).alias("n"), LF.stable_avg("x", 2).alias("avg_x"), LF.stable_avg("x", 0).alias("avg_x_whole"),
        LF.stable_avg("signed", 2).alias("avg_signed"), LF.stable_avg("small", 4).alias("avg_small"))


@register("conditional_pct", O.over_marts(
    "SELECT city, room_type, superhost_pct, instant_bookable_pct FROM mart_city_pricing"))
def q_conditional_pct(spark, sf_dir):
    return _layers(spark, sf_dir).mart_city_pricing.select("city", "room_type", "superhost_pct",
                                                           "instant_bookable_pct")


@register("price_tier", O.over_marts("SELECT city, room_type, median_price, price_tier FROM mart_city_pricing"))
def q_price_tier(spark, sf_dir):
    return _layers(spark, sf_dir).mart_city_pricing.select("city", "room_type", "median_price", "price_tier")


@register("host_tier", O.over_marts(
    f"SELECT {O.HOST_KEYS}, avg_rating, host_tier FROM mart_host_performance"))
def q_host_tier(spark, sf_dir):
    return _layers(spark, sf_dir).mart_host_performance.select(*marts.HOST_KEYS, "avg_rating", "host_tier")


@register("lag_prev_month", O.over_marts(
    "SELECT city, room_type, review_year, review_month, review_count, prev_month_reviews FROM mart_review_trends"))
def q_lag_prev_month(spark, sf_dir):
    return _gold(spark, sf_dir).mart_review_trends.select(
        "city", "room_type", "review_year", "review_month", "review_count", "prev_month_reviews")


@register("mom_growth", O.over_marts(
    "SELECT city, room_type, review_year, review_month, review_growth_pct FROM mart_review_trends"))
def q_mom_growth(spark, sf_dir):
    return _gold(spark, sf_dir).mart_review_trends.select(
        "city", "room_type", "review_year", "review_month", "review_growth_pct")


# ── BI datasets ─────────────────────────────────────────────────────────────
@register("bi_city_pricing_list", O.over_marts(
    "SELECT city, room_type, avg_price, median_price, total_listings FROM mart_city_pricing"))
def q_bi_city_pricing_list(spark, sf_dir):
    return bi.city_pricing_list(_layers(spark, sf_dir).mart_city_pricing)


@register("bi_top_cities", O.over_marts(
    f"SELECT city, avg_price, median_price, superhost_pct FROM mart_city_pricing "
    f"WHERE room_type = '{FX.FIXTURE_TOP_ROOM_TYPE}' ORDER BY median_price DESC NULLS LAST, city LIMIT 5"))
def q_bi_top_cities(spark, sf_dir):
    return bi.top_cities(_layers(spark, sf_dir).mart_city_pricing, FX.FIXTURE_TOP_ROOM_TYPE, 5)


@register("bi_city_price", O.over_marts(
    f"SELECT city, {O.avg2('avg_price', 0)} AS avg_price FROM mart_city_pricing GROUP BY city"))
def q_bi_city_price(spark, sf_dir):
    return bi.city_price(_layers(spark, sf_dir).mart_city_pricing)


@register("bi_host_tier_price", O.over_marts(
    f"SELECT host_tier, {O.avg2('avg_listing_price', 0)} AS avg_price, COUNT(*) AS host_count "
    "FROM mart_host_performance GROUP BY host_tier"))
def q_bi_host_tier_price(spark, sf_dir):
    return bi.host_tier_price(_layers(spark, sf_dir).mart_host_performance)


@register("bi_reviews_by_year", O.over_marts(
    "SELECT review_year, CAST(SUM(review_count) AS BIGINT) AS total_reviews FROM mart_review_trends "
    "GROUP BY review_year"))
def q_bi_reviews_by_year(spark, sf_dir):
    return bi.reviews_by_year(_gold(spark, sf_dir).mart_review_trends)


_AMENITY_BUCKET_SQL = ("CASE WHEN amenity_count < 5 THEN 'Few (<5)' WHEN amenity_count < 10 "
                       "THEN 'Medium (5-10)' ELSE 'Many (10+)' END")


@register("bi_amenity_vs_rating", O.with_(O.ctes("silver_listings"), f"""SELECT
  {_AMENITY_BUCKET_SQL} AS amenity_bucket, {O.avg2("review_scores_rating", 2)} AS avg_rating,
  COUNT(*) AS listing_count FROM silver_listings GROUP BY 1"""))
def q_bi_amenity_vs_rating(spark, sf_dir):
    return bi.amenity_vs_rating(_layers(spark, sf_dir).silver_listings)


@register("bi_rating_vs_price", O.over_marts(
    "SELECT city, room_type, avg_rating, avg_price FROM mart_city_pricing"))
def q_bi_rating_vs_price(spark, sf_dir):
    return bi.rating_vs_price(_layers(spark, sf_dir).mart_city_pricing)


@register("bi_reviews_by_month", O.over_marts(
    "SELECT month_start_date, CAST(SUM(review_count) AS BIGINT) AS review_count FROM mart_review_trends "
    "GROUP BY month_start_date"))
def q_bi_reviews_by_month(spark, sf_dir):
    return bi.reviews_by_month(_gold(spark, sf_dir).mart_review_trends)


# ── sources, topic log, streaming landing ──────────────────────────────────


def _fixture_csv_run(spark, sf_dir, entities=("listings", "reviews"), **kw) -> PipelineConfig:
    """Fresh run folder with the derived records written as CSV source files."""
    root = new_run_root(spark, "queries")
    cfg = PipelineConfig(root=root, listings_csv=f"{root}/csv/listings" if "listings" in entities else None,
                         reviews_csv=f"{root}/csv/reviews" if "reviews" in entities else None,
                         run_ts=RUN_TS, min_year=FX.FIXTURE_YEAR_FLOOR, median="exact",
                         cities=FX.FIXTURE_CITIES, room_types=FX.FIXTURE_ROOM_TYPES, **kw)
    writes = []
    if cfg.listings_csv:
        writes.append(lambda: write_csv_records(FX.bronze_listings(spark, sf_dir), cfg.listings_csv))
    if cfg.reviews_csv:
        writes.append(lambda: write_csv_records(FX.bronze_reviews(spark, sf_dir), cfg.reviews_csv))
    run_concurrently(*writes)
    return cfg


_LISTING_MSG = (f"SELECT '{S.LISTINGS_TOPIC}' AS topic, COALESCE(listing_id, 'unknown') AS key, "
                "CAST(to_json(b) AS VARCHAR) AS value FROM bronze_listings b")


@register("csv_scan", O.with_(_bl(), "SELECT * FROM bronze_listings"))
def q_csv_scan(spark, sf_dir):
    cfg = _fixture_csv_run(spark, sf_dir, entities=("listings",))
    return read_csv_records(spark, cfg.listings_csv)


#: A listing's name in the split fixture: quotes, separators, newlines (one line
#: empty, one that looks like a record), non-ASCII text.
_SPLIT_NAME = {0: '"{}",\n\nsecond, "quoted"\n1,2,3\n', 1: "{}\r\n\u00e9\u4e16, ", 2: "{}"}


def _split_fixture(spark, sf_dir):
    b = FX.bronze_listings(spark, sf_dir)
    kind, name = F.col("listing_id").cast("bigint") % 5, F.col("name")
    texts = [F.concat(F.lit(t.split("{}")[0]), name, F.lit(t.split("{}")[1])) for t in _SPLIT_NAME.values()]
    return b.withColumn("name", F.when(kind == 0, texts[0]).when(kind == 1, texts[1]).otherwise(texts[2]))


@register("csv_split_scan", O.with_(_bl(), """SELECT * REPLACE (CASE CAST(listing_id AS BIGINT) % 5
  WHEN 0 THEN '"' || name || '",' || chr(10) || chr(10) || 'second, "quoted"' || chr(10) || '1,2,3' || chr(10)
  WHEN 1 THEN name || chr(13) || chr(10) || chr(233) || chr(19990) || ', ' ELSE name END AS name) FROM bronze_listings"""))
def q_csv_split_scan(spark, sf_dir):
    """Files in two column orders, with newlines inside quotes, read as byte ranges."""
    root = new_run_root(spark, "queries")
    rows, even = _split_fixture(spark, sf_dir), F.col("listing_id").cast("bigint") % 2 == 0
    write_csv_records(rows.where(even), f"{root}/csv/a")
    write_csv_records(rows.where(~even).select(*reversed(rows.columns)), f"{root}/csv/b")
    return read_csv_split(spark, [f"{root}/csv/a", f"{root}/csv/b"], S.BRONZE_LISTING_COLUMNS)


@register("dead_letters", O.with_(O.ctes("bronze_reviews"), f"""
SELECT '{S.REVIEWS_TOPIC}' AS topic, CAST(count_if(k NOT IN (0, 1, 2)) AS BIGINT) AS sent_records, CAST(count_if(k IN (0, 1, 2)) AS BIGINT) AS error_records,
  CAST(count_if(k IN (0, 1)) AS BIGINT) AS short_records, CAST(count_if(k = 2) AS BIGINT) AS long_records, CAST(0 AS BIGINT) AS quotes_records, CAST(0 AS BIGINT) AS utf8_records,
  CAST(0 AS BIGINT) AS unknown_keys, COUNT(*) AS records
FROM (SELECT CAST(review_id AS BIGINT) % 11 AS k FROM bronze_reviews)"""))
def q_dead_letters(spark, sf_dir):
    """Review lines of which some lack fields and some have too many: published in
    one pass with the errors apart, then counted from the log."""
    cfg = PipelineConfig(root=new_run_root(spark, "queries"), dead_letters=True)
    cfg.reviews_csv = cfg.path("csv/reviews")
    b, k = FX.bronze_reviews(spark, sf_dir), F.col("review_id").cast("bigint") % 11
    line = F.when(k == 0, F.col("listing_id")).when(k == 1, F.concat_ws(",", "listing_id", "review_id", "date")).when(
        k == 2, F.concat_ws(",", *b.columns, F.lit("more"))).otherwise(F.concat_ws(",", *b.columns))
    # lines as they are, under the header's line
    (b.select(line.alias(",".join(b.columns))).write.option("header", True).option("sep", "\u0001").option("quote", "\u0002").csv(cfg.reviews_csv))
    ingest(spark, cfg)
    return ingest_accounting(read_topic_log(spark, cfg.path("topics")))


@register("to_topic_messages", O.with_(_bl(), _LISTING_MSG))
def q_to_topic_messages(spark, sf_dir):
    return to_topic_messages(FX.bronze_listings(spark, sf_dir), S.LISTINGS_TOPIC, "listing_id")


@register("topic_log_roundtrip", O.with_(_bl(), f"SELECT '{S.LISTINGS_TOPIC}' AS topic, listing_id AS key, * "
                                                "FROM bronze_listings"))
def q_topic_log_roundtrip(spark, sf_dir):
    cfg = _fixture_csv_run(spark, sf_dir, entities=("listings",))
    ingest(spark, cfg)
    msgs = read_topic_log(spark, cfg.path("topics"), S.LISTINGS_TOPIC)
    return parse_messages(msgs, S.BRONZE_LISTING_COLUMNS)


@register("ingest_counts", O.with_(O.ctes("bronze_listings", "bronze_reviews"), f"""
SELECT '{S.LISTINGS_TOPIC}' AS topic, COUNT(*) AS sent_records,
  CAST(count_if(listing_id IS NULL) AS BIGINT) AS unknown_keys FROM bronze_listings
UNION ALL
SELECT '{S.REVIEWS_TOPIC}', COUNT(*), CAST(count_if(review_id IS NULL) AS BIGINT) FROM bronze_reviews"""))
def q_ingest_counts(spark, sf_dir):
    cfg = _fixture_csv_run(spark, sf_dir)
    ingest(spark, cfg)
    return ingest_counts(read_topic_log(spark, cfg.path("topics")))


@register("stream_to_bronze", O.with_(_bl(), "SELECT * FROM bronze_listings"))
def q_stream_to_bronze(spark, sf_dir):
    cfg = _fixture_csv_run(spark, sf_dir, entities=("listings",))
    ingest(spark, cfg)
    land(spark, cfg)
    return read_bronze(spark, cfg.path("bronze", S.LISTINGS_TOPIC), S.BRONZE_LISTING_COLUMNS).drop(
        *S.INGEST_PARTITION_COLUMNS)


@register("bronze_scan", O.with_(O.ctes("bronze_reviews"), "SELECT * FROM bronze_reviews"))
def q_bronze_scan(spark, sf_dir):
    cfg = _fixture_csv_run(spark, sf_dir, entities=("reviews",))
    ingest(spark, cfg)
    land(spark, cfg)
    return read_bronze(spark, cfg.path("bronze", S.REVIEWS_TOPIC), S.BRONZE_REVIEW_COLUMNS).drop(
        *S.INGEST_PARTITION_COLUMNS)


@register("stream_resume", O.with_(_bl(), "SELECT * FROM bronze_listings UNION ALL SELECT * FROM bronze_listings"))
def q_stream_resume(spark, sf_dir):
    """Land, land again on the same checkpoint (adds nothing), publish the
    records a second time, land (adds exactly them): two copies in bronze."""
    cfg = _fixture_csv_run(spark, sf_dir, entities=("listings",))
    ingest(spark, cfg)
    land(spark, cfg)
    land(spark, cfg)
    ingest(spark, cfg)
    land(spark, cfg)
    return read_bronze(spark, cfg.path("bronze", S.LISTINGS_TOPIC), S.BRONZE_LISTING_COLUMNS).drop(
        *S.INGEST_PARTITION_COLUMNS)


@register("layer_counts", O.with_(O.ctes("stg_listings", "stg_reviews"), """
SELECT 'bronze' AS layer, 'listings' AS entity, COUNT(*) AS row_count FROM bronze_listings
UNION ALL SELECT 'silver', 'listings', COUNT(*) FROM silver_listings
UNION ALL SELECT 'staging', 'listings', COUNT(*) FROM stg_listings
UNION ALL SELECT 'bronze', 'reviews', COUNT(*) FROM bronze_reviews
UNION ALL SELECT 'silver', 'reviews', COUNT(*) FROM silver_reviews
UNION ALL SELECT 'staging', 'reviews', COUNT(*) FROM stg_reviews"""))
def q_layer_counts(spark, sf_dir):
    """Rows per layer, observed while the layers are written from bronze on, as the
    run's ledger keeps them: no layer is read for its count."""
    cfg = PipelineConfig(root=new_run_root(spark, "queries"), run_ts=RUN_TS)
    run_concurrently(lambda: FX.bronze_listings(spark, sf_dir).write.json(cfg.path("bronze", cfg.listings_topic)),
                     lambda: FX.bronze_reviews(spark, sf_dir).write.json(cfg.path("bronze", cfg.reviews_topic)))
    bronze_to_silver(spark, cfg)
    silver_to_staging(spark, cfg)
    return ledger.latest(spark, cfg.root).where("layer in ('bronze', 'silver', 'staging')")


#: Records of a flush in the fixture's counted landing.
FLUSH = 250


@register("flush_batches", O.with_(_bl(), f"""SELECT CAST(i AS BIGINT) AS flush, CAST(least({FLUSH}, n - i * {FLUSH}) AS BIGINT) AS records
FROM (SELECT COUNT(*) AS n FROM bronze_listings), LATERAL (SELECT unnest(range((n + {FLUSH - 1}) // {FLUSH})) AS i)"""))
def q_flush_batches(spark, sf_dir):
    """Listings landed by record count, some log files at a time, and landed again
    (which adds nothing): records per flush, none over the limit, only the last
    under it."""
    cfg = _fixture_csv_run(spark, sf_dir, entities=("listings",))
    ingest(spark, cfg)
    landing = CountedLanding(spark, cfg.listings_topic, cfg.path("topics"), cfg.path("bronze"), cfg.path("_checkpoints"), FLUSH)
    landing.drain(files_per_trigger=3)
    landing.drain()
    return landing.flushes()


@register("flushed_bronze", O.with_(_bl(), "SELECT * FROM bronze_listings"))
def q_flushed_bronze(spark, sf_dir):
    """The records that a landing by record count leaves in bronze."""
    cfg = _fixture_csv_run(spark, sf_dir, entities=("listings",), flush_records=FLUSH)
    ingest(spark, cfg)
    land(spark, cfg)
    return read_bronze(spark, cfg.path("bronze", cfg.listings_topic), S.BRONZE_LISTING_COLUMNS).select(S.BRONZE_LISTING_COLUMNS)


@register("bronze_compaction", O.with_(_bl(), "SELECT *, true AS landed_today, true AS fewer_files FROM bronze_listings"))
def q_bronze_compaction(spark, sf_dir):
    """Landed in small files, compacted, and read by the manifest: the same rows,
    the UTC date of landing in year, month and day, and fewer files."""
    cfg = _fixture_csv_run(spark, sf_dir, entities=("listings",))
    ingest(spark, cfg)
    path, manifest = cfg.path("bronze", cfg.listings_topic), cfg.path("manifests", cfg.listings_topic)
    dates = [dt.datetime.now(dt.timezone.utc).date()]
    land_topics(spark, [cfg.listings_topic], cfg.path("bronze"), cfg.path("_checkpoints"), log_path=cfg.path("topics"), records_per_file=FLUSH)
    dates.append(dt.datetime.now(dt.timezone.utc).date())
    before = live_files(spark, path, manifest).count()
    compact(spark, path, manifest, closed_before=str(dates[-1] + dt.timedelta(days=1)), target_bytes=1 << 20)
    after = live_files(spark, path, manifest).count()
    rows = read_live(spark, path, manifest, S.BRONZE_LISTING_COLUMNS)
    today = F.concat_ws("-", "year", "month", "day").isin([d.isoformat() for d in dates])
    return rows.select(*S.BRONZE_LISTING_COLUMNS, today.alias("landed_today"), F.lit(after < before).alias("fewer_files"))


# ── table sinks and scans ───────────────────────────────────────────────────
@register("silver_listings_partitions", O.with_(O.ctes("silver_listings"), "SELECT * FROM silver_listings"))
def q_silver_listings_partitions(spark, sf_dir):
    silver = _layers(spark, sf_dir).silver_listings
    path = new_run_root(spark, "queries") + "/silver/listings"
    TB.write_table(silver, path=path, partition_by=["city"])
    return _drop_ts(TB.read_table(spark, path=path, schema=silver.schema))


@register("silver_reviews_partitions", O.with_(O.ctes("silver_reviews"), "SELECT * FROM silver_reviews"))
def q_silver_reviews_partitions(spark, sf_dir):
    silver = _layers(spark, sf_dir).silver_reviews
    path = new_run_root(spark, "queries") + "/silver/reviews"
    TB.write_table(silver, path=path, partition_by=["review_year", "review_month"])
    return _drop_ts(TB.read_table(spark, path=path, schema=silver.schema))


@register("gold_materialize", O.over_marts("SELECT * FROM mart_city_pricing"))
def q_gold_materialize(spark, sf_dir):
    mart = _layers(spark, sf_dir).mart_city_pricing
    path = new_run_root(spark, "queries") + "/gold/mart_city_pricing"
    return _drop_ts(TB.materialize(mart, path=path, partition_by=["city"], sort_by=["city", "room_type"]))


_SAMPLE_COLS = ["listing_id", "city", "room_type", "price", "host_is_superhost", "review_scores_rating",
                "amenity_count"]


@register("silver_sample", O.with_(O.ctes("silver_listings"),
                                   f"SELECT {', '.join(_SAMPLE_COLS)} FROM silver_listings ORDER BY listing_id LIMIT 5"))
def q_silver_sample(spark, sf_dir):
    """The 5-row preview, made deterministic by ordering on the key."""
    return _layers(spark, sf_dir).silver_listings.select(*_SAMPLE_COLS).orderBy("listing_id").limit(5)


@register("catalog_listing", O.over_marts("\nUNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, true AS listed, COUNT(*) AS row_count FROM {cte}"
    for layer, name, cte in (("silver", "listings", "silver_listings"), ("silver", "reviews", "silver_reviews"),
                             ("gold", "mart_city_pricing", "mart_city_pricing"), ("gold", "mart_host_performance", "mart_host_performance"),
                             ("gold", "mart_review_trends", "mart_review_trends")))))
def q_catalog_listing(spark, sf_dir):
    """Steps run one by one into fresh namespaces; the tables that the ledger knows,
    with their rows, against ``SHOW NAMESPACES`` and ``SHOW TABLES``."""
    cfg = _fixture_csv_run(spark, sf_dir)
    tag = "lf_" + cfg.root.rsplit("/", 1)[-1]
    cfg.silver_namespace, cfg.gold_namespace = f"{tag}_silver", f"{tag}_gold"
    for step in ("ingest", "land", "silver", "staging", "gold"):
        STEPS[step](spark, cfg)
    return catalog(spark, cfg)


_T1, _T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


@register("as_of_snapshot", O.with_(O.ctes("silver_listings", extra={"history": f"""
SELECT *, TIMESTAMP '{_T1}' AS version_ts FROM silver_listings
UNION ALL
SELECT * REPLACE (CASE WHEN instant_bookable THEN price + 1 ELSE price END AS price), TIMESTAMP '{_T2}'
FROM silver_listings"""}), f"""
SELECT * EXCLUDE (version_ts), 'v1' AS snapshot FROM history WHERE version_ts <= TIMESTAMP '{_T1}'
UNION ALL
SELECT * EXCLUDE (version_ts), 'v2' FROM history WHERE version_ts <= TIMESTAMP '{_T2}'
QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY version_ts DESC) = 1"""))
def q_as_of_snapshot(spark, sf_dir):
    """Append-only history with two versions of each listing (the second
    reprices instantly bookable ones); read as of each version stamp."""
    silver = _drop_ts(_layers(spark, sf_dir).silver_listings)
    v1 = silver.withColumn("version_ts", F.lit(_T1).cast("timestamp"))
    v2 = silver.withColumns({
        "price": F.when(F.col("instant_bookable"), F.col("price") + 1).otherwise(F.col("price")),
        "version_ts": F.lit(_T2).cast("timestamp")})
    history = v1.unionByName(v2)
    snaps = [TB.as_of(history, ["listing_id"], "version_ts", ts).drop("version_ts")
             .withColumn("snapshot", F.lit(tag)) for tag, ts in (("v1", _T1), ("v2", _T2))]
    return snaps[0].unionByName(snaps[1])


@register("schema_evolution_union", O.with_(O.ctes("silver_reviews"), """
SELECT review_id, listing_id, reviewer_id, review_date, review_year, review_month,
  CASE WHEN COALESCE(review_year >= 1998, false) THEN CAST(quarter(review_date) AS INTEGER) END AS review_quarter
FROM silver_reviews"""))
def q_schema_evolution_union(spark, sf_dir):
    """Two appends to one folder: older reviews without ``review_quarter``,
    newer ones with it; read with schema merging."""
    silver = _drop_ts(_layers(spark, sf_dir).silver_reviews)
    newer = F.coalesce(F.col("review_year") >= 1998, F.lit(False))
    path = new_run_root(spark, "queries") + "/silver/reviews_evolving"
    TB.write_table(silver.filter(~newer), path=path, mode="append", rebalance=False)
    TB.write_table(silver.filter(newer).withColumn("review_quarter", F.quarter("review_date")),
                   path=path, mode="append", rebalance=False)
    return TB.read_table(spark, path=path, merge_schema=True)


@register("mart_ordering", O.over_marts("\nUNION ALL ".join(
    f"SELECT '{m}' AS mart, COUNT(*) AS row_count, true AS files_in_order FROM {m}"
    for m in ("mart_city_pricing", "mart_host_performance", "mart_review_trends"))))
def q_mart_ordering(spark, sf_dir):
    """The marts written in their order; whether every file's rows follow it."""
    lay, root, out = _gold_all(spark, sf_dir), new_run_root(spark, "queries"), None
    for mart, parts in (("mart_city_pricing", ["city"]), ("mart_host_performance", []), ("mart_review_trends", [])):
        df, path = getattr(lay, mart), f"{root}/gold/{mart}"
        TB.write_table(df, path=path, partition_by=parts, sort_by=mart_order(mart))
        files = TB.file_order(spark, path, mart_order(mart), schema=df.schema)
        row = files.agg(F.sum("rows").alias("row_count"), (F.sum("violations") == 0).alias("files_in_order")).select(F.lit(mart).alias("mart"), "row_count", "files_in_order")
        out = row if out is None else out.unionByName(row)
    return out


# ── data quality ────────────────────────────────────────────────────────────
@register("dq_unique", O.with_(O.ctes("bronze_reviews"), """SELECT review_id, COUNT(*) AS n_records
FROM bronze_reviews WHERE review_id IS NOT NULL GROUP BY review_id HAVING COUNT(*) > 1"""))
def q_dq_unique(spark, sf_dir):
    """``unique`` on the raw review ids (where the duplicates are)."""
    return Q.unique_failures(FX.bronze_reviews(spark, sf_dir), "review_id")


@register("dq_not_null", O.with_(O.ctes("silver_reviews"), "SELECT * FROM silver_reviews WHERE review_date IS NULL"))
def q_dq_not_null(spark, sf_dir):
    """``not_null(review_date)`` on silver, before staging drops undated rows."""
    return _drop_ts(Q.not_null_failures(_layers(spark, sf_dir).silver_reviews, "review_date"))


_ROOM_TYPES_MINUS_ONE = [t for t in FX.FIXTURE_ROOM_TYPES if t != "PROMO"]


@register("dq_accepted_values", O.with_(O.ctes("stg_listings"), "SELECT room_type, COUNT(*) AS n_records "
          "FROM stg_listings WHERE room_type IS NOT NULL AND room_type NOT IN ("
          + ", ".join(f"'{t}'" for t in _ROOM_TYPES_MINUS_ONE) + ") GROUP BY room_type"))
def q_dq_accepted_values(spark, sf_dir):
    """``accepted_values(room_type)`` with one real value left out of the list."""
    return Q.accepted_values_failures(_layers(spark, sf_dir).stg_listings, "room_type", _ROOM_TYPES_MINUS_ONE)


@register("dq_expression", O.with_(O.ctes("stg_listings"), "SELECT * FROM stg_listings WHERE "
          "review_scores_rating IS NOT NULL AND NOT (review_scores_rating BETWEEN 0 AND 4.5)"))
def q_dq_expression(spark, sf_dir):
    """``expression_is_true`` with a ``where`` filter, on a tighter range."""
    return _drop_ts(Q.expression_failures(_layers(spark, sf_dir).stg_listings,
                                          "review_scores_rating between 0 and 4.5",
                                          where="review_scores_rating is not null"))


@register("dq_relationships", O.with_(O.ctes("stg_listings", "stg_reviews"), """SELECT r.* FROM stg_reviews r
WHERE r.listing_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_listings l WHERE l.listing_id = r.listing_id)"""))
def q_dq_relationships(spark, sf_dir):
    lay = _gold(spark, sf_dir)
    return Q.relationships_failures(lay.stg_reviews, "listing_id", lay.stg_listings, "listing_id", hot=lay.hot_listings)


def _dq_summary_sql() -> str:
    cities = ", ".join(f"'{c}'" for c in FX.FIXTURE_CITIES)
    rooms = ", ".join(f"'{t}'" for t in FX.FIXTURE_ROOM_TYPES)

    def nn(t, c):
        return f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'not_null' AS test_name, " \
               f"CAST(count_if({c} IS NULL) AS BIGINT) AS failures FROM {t}"

    def uq(t, c):
        return (f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'unique' AS test_name, "
                f"CAST(COUNT(*) AS BIGINT) AS failures FROM (SELECT {c} FROM {t} "
                f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1) d")

    def av(t, c, vals):
        return (f"SELECT '{t}', '{c}', 'accepted_values', CAST(COUNT(DISTINCT {c}) AS BIGINT) FROM {t} "
                f"WHERE {c} IS NOT NULL AND {c} NOT IN ({vals})")

    def ex(t, c, e, w=None):
        cond = f"({w}) AND NOT ({e})" if w else f"NOT ({e})"
        return f"SELECT '{t}', '{c}', 'expression', CAST(count_if({cond}) AS BIGINT) FROM {t}"

    parts = [
        uq("stg_listings", "listing_id"), nn("stg_listings", "listing_id"), nn("stg_listings", "city"),
        av("stg_listings", "city", cities), nn("stg_listings", "room_type"),
        av("stg_listings", "room_type", rooms), nn("stg_listings", "price"),
        ex("stg_listings", "price", "price > 0"),
        ex("stg_listings", "review_scores_rating", "review_scores_rating BETWEEN 0 AND 100",
           "review_scores_rating IS NOT NULL"),
        uq("stg_reviews", "review_id"), nn("stg_reviews", "review_id"), nn("stg_reviews", "listing_id"),
        "SELECT 'stg_reviews', 'listing_id', 'relationships', CAST(COUNT(*) AS BIGINT) FROM stg_reviews r "
        "WHERE r.listing_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_listings l WHERE l.listing_id = r.listing_id)",
        nn("stg_reviews", "review_date"),
        nn("mart_city_pricing", "city"), nn("mart_city_pricing", "room_type"),
        ex("mart_city_pricing", "avg_price", "avg_price > 0"),
        nn("mart_host_performance", "host_id"), nn("mart_review_trends", "month_start_date"),
    ]
    return O.over_marts("\nUNION ALL\n".join(parts))


def _fixture_tables(lay: FixtureLayers) -> dict:
    return {"stg_listings": lay.stg_listings, "stg_reviews": lay.stg_reviews,
            "mart_city_pricing": lay.mart_city_pricing, "mart_host_performance": lay.mart_host_performance,
            "mart_review_trends": lay.mart_review_trends}


@register("dq_summary", _dq_summary_sql())
def q_dq_summary(spark, sf_dir):
    """All 19 checks in one summary (fixture accepted-value lists), run like
    the reference on materialised staging tables: every check and mart scans
    the written copies instead of recomputing bronze -> silver -> staging."""
    return Q.run_suite(_fixture_tables(_gold_all(spark, sf_dir)),
                       Q.default_suite(FX.FIXTURE_CITIES, FX.FIXTURE_ROOM_TYPES))


@register("pipeline_steps", O.over_marts("SELECT * FROM mart_host_performance"))
def q_pipeline_steps(spark, sf_dir):
    """Every step on its own, each knowing nothing but the root (the first one also
    the CSV files); returns a mart as written."""
    first = _fixture_csv_run(spark, sf_dir, dead_letters=True)
    STEPS["ingest"](spark, first)
    for step in ("land", "silver", "staging", "gold", "test"):
        cfg = PipelineConfig(root=first.root, run_ts=RUN_TS, min_year=FX.FIXTURE_YEAR_FLOOR, median="exact",
                             cities=FX.FIXTURE_CITIES, room_types=FX.FIXTURE_ROOM_TYPES)
        try:
            STEPS[step](spark, cfg)
        except Q.QualityError:  # the fixture has orphan reviews on purpose
            assert step == "test"
    failed = ledger.entries(spark, first.root).where("layer = 'quality'").count()
    assert failed == 1, "the quality step left no entry"
    return _drop_ts(TB.read_table(spark, path=first.path("gold", "mart_host_performance")))


# ── end to end ──────────────────────────────────────────────────────────────
@register("pipeline_end_to_end", O.over_marts("SELECT * FROM mart_review_trends"))
def q_pipeline_end_to_end(spark, sf_dir):
    """CSV -> topics -> streamed bronze -> silver -> staging -> gold -> checks;
    returns the last mart as written. The fixture has orphan reviews on
    purpose, so the quality gate reports instead of raising here."""
    cfg = _fixture_csv_run(spark, sf_dir, fail_on_quality=False)
    res = run_pipeline(spark, cfg)
    assert res.quality, "quality suite did not run"
    return _drop_ts(TB.read_table(spark, path=cfg.path("gold", "mart_review_trends")))
