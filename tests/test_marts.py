import datetime as dt

from pyspark.sql import functions as F

from lakeforge.plans import marts
from tests.conftest import SF_SMALL

LISTING_COLS = ("listing_id int, host_id int, city string, room_type string, property_type string, "
                "price double, bedrooms int, accommodates int, amenity_count int, review_scores_rating double, "
                "review_scores_cleanliness double, review_scores_location double, review_scores_value double, "
                "review_scores_communication double, host_is_superhost boolean, instant_bookable boolean, "
                "host_response_rate_pct double, host_acceptance_rate_pct double, "
                "host_total_listings_count int, host_identity_verified boolean")


def listings(spark, rows):
    full = []
    for r in rows:
        base = dict(listing_id=1, host_id=1, city="Paris", room_type="Entire place", property_type="Flat",
                    price=100.0, bedrooms=1, accommodates=2, amenity_count=3, review_scores_rating=4.5,
                    review_scores_cleanliness=4.0, review_scores_location=4.0, review_scores_value=4.0,
                    review_scores_communication=4.0, host_is_superhost=True, instant_bookable=False,
                    host_response_rate_pct=90.0, host_acceptance_rate_pct=80.0, host_total_listings_count=1,
                    host_identity_verified=True)
        base.update(r)
        full.append(base)
    names = [c.strip().split(" ")[0] for c in LISTING_COLS.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], LISTING_COLS)


def reviews(spark, rows):
    out = [(i, l, rv, d, d.year, d.month) for i, (l, rv, d) in enumerate(rows)]
    return spark.createDataFrame(out, "review_id int, listing_id int, reviewer_id int, review_date date, "
                                      "review_year int, review_month int")


def test_city_pricing_single_listing(spark):
    out = marts.city_pricing(listings(spark, [{}]), median="exact").first()
    assert out["stddev_price"] is None and out["total_listings"] == 1
    assert out["median_price"] == 100.0 and out["price_tier"] == "Premium"
    assert out["superhost_pct"] == 100.0 and out["instant_bookable_pct"] == 0.0


def test_superhost_pct_null_counts_in_denominator(spark):
    l = listings(spark, [{"listing_id": 1, "host_is_superhost": True}, {"listing_id": 2, "host_is_superhost": None},
                         {"listing_id": 3, "host_is_superhost": False}])
    assert marts.city_pricing(l).first()["superhost_pct"] == 33.3


def test_host_performance_active_days(spark):
    l = listings(spark, [{"listing_id": 1, "host_id": 1}, {"listing_id": 2, "host_id": 2}])
    r = reviews(spark, [(1, 7, dt.date(2016, 1, 1))])
    out = {row["host_id"]: row for row in marts.host_performance(l, r).collect()}
    assert out[1]["active_days"] == 0 and out[1]["total_reviews_received"] == 1
    assert out[2]["active_days"] is None and out[2]["total_reviews_received"] == 0
    assert out[2]["avg_reviews_per_listing"] == 0.0


def test_review_trends_lag_and_growth(spark):
    l = listings(spark, [{"listing_id": 1}])
    days = [dt.date(2016, 1, 5)] * 2 + [dt.date(2016, 2, 5)] * 3 + [dt.date(2016, 5, 5)] * 3
    r = reviews(spark, [(1, i, d) for i, d in enumerate(days)])
    out = marts.review_trends(l, r, min_year=2015).orderBy("review_month").collect()
    assert [x["review_count"] for x in out] == [2, 3, 3]
    assert [x["prev_month_reviews"] for x in out] == [None, 2, 3]  # May compares with February
    assert [x["review_growth_pct"] for x in out] == [None, 50.0, 0.0]
    assert out[0]["month_start_date"] == dt.date(2016, 1, 1)


def test_growth_previous_zero_is_null(spark):
    from lakeforge.operators.windows import lag_growth
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 5)], "g string, t int, v long")
    out = lag_growth(df, "v", ["g"], ["t"]).orderBy("t").collect()
    assert out[1]["prev_value"] == 0 and out[1]["growth_pct"] is None


def test_median_approx_rank_error(spark):
    n = 20001
    df = spark.range(n).select(F.lit("c").alias("city"), F.lit("r").alias("room_type"),
                               F.col("id").cast("int").alias("listing_id"),
                               F.lit("p").alias("property_type"),
                               ((F.col("id") * 7919) % n).cast("double").alias("price"),
                               *[F.lit(None).cast(t).alias(c) for c, t in [
                                   ("bedrooms", "int"), ("accommodates", "int"), ("amenity_count", "int"),
                                   ("review_scores_rating", "double"), ("review_scores_cleanliness", "double"),
                                   ("review_scores_location", "double"), ("review_scores_value", "double"),
                                   ("host_is_superhost", "boolean"), ("instant_bookable", "boolean")]])
    approx = marts.city_pricing(df, median="approx").first()["median_price"]
    exact = marts.city_pricing(df, median="exact").first()["median_price"]
    assert exact == 10000.0
    assert abs(approx - exact) <= n / 1000


def test_marts_invariant_to_partitioning(spark):
    from lakeforge.plans.layers import FixtureLayers
    a = FixtureLayers(spark, SF_SMALL)
    b = FixtureLayers(spark, SF_SMALL)
    b.__dict__["bronze_reviews"] = a.bronze_reviews.repartition(11).orderBy(F.rand(7))
    b.__dict__["bronze_listings"] = a.bronze_listings.repartition(5).orderBy(F.rand(3))
    for name in ("mart_city_pricing", "mart_host_performance", "mart_review_trends"):
        x = getattr(a, name).drop("updated_at")
        y = getattr(b, name).drop("updated_at")
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name


def test_monthly_reviews_group_in_parts_and_hold_no_sums_a_row(spark):
    l = listings(spark, [{"listing_id": 1, "price": 0.1}, {"listing_id": 1, "price": 0.3}, {"listing_id": 2, "price": None},
                         {"listing_id": 3, "city": None}, {"listing_id": 3, "city": None, "price": float("nan")}])
    day = dt.date(2020, 5, 1)
    r = reviews(spark, [(1, 7, day), (1, 7, day), (1, None, day), (2, 8, day), (3, 7, day), (None, 9, day)])
    r = r.unionByName(r.where("reviewer_id = 8").withColumn("review_id", F.lit(None).cast("int")))
    out = {x["city"]: x for x in marts.monthly_reviews(l, r).collect()}
    paris, other = out["Paris"], out[None]
    # three reviews meet two rows of listing 1, one of the two of listing 2 has no id
    assert (paris["review_count"], paris["active_listings"], paris["unique_reviewers"], paris["avg_price"]) == (7, 2, 2, 0.2)
    assert (other["review_count"], other["active_listings"], other["unique_reviewers"], other["avg_price"]) == (2, 1, 1, None)
    plan = marts.monthly_reviews(l, r)._jdf.queryExecution().optimizedPlan().toString()
    narrow = [ln for ln in plan.splitlines() if "Aggregate" in ln and "grouping_id" in ln]
    assert "RebalancePartitions" in plan and len(narrow) == 1 and "sum(" not in narrow[0]
