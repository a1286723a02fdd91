from pyspark.sql import functions as F

from lakeforge import schemas as S
from lakeforge.operators.clean import clean_listings, clean_reviews
from lakeforge.operators.dedup import asc, dedup_by_key, desc, latest_by_key


def listing(**kw):
    row = {c: "" for c in S.BRONZE_LISTING_COLUMNS}
    row.update({"listing_id": "1", "city": " paris ", "price": "100", "host_is_superhost": "t"})
    row.update(kw)
    return row


def frame(spark, rows, cols):
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], S.text_schema(cols))


def test_bad_duplicate_never_evicts_good_row(spark):
    rows = [listing(price=""), listing(price="120"), listing(price="0")]
    for order in (rows, list(reversed(rows))):
        out = clean_listings(frame(spark, order, S.BRONZE_LISTING_COLUMNS).repartition(3)).collect()
        assert len(out) == 1 and out[0]["price"] == 120.0 and out[0]["city"] == "Paris"


def test_price_bounds_are_exclusive(spark):
    prices = ["0", "10000", "-5", "$12", "", "0.01", "9999.99"]
    rows = [listing(listing_id=str(i), price=p) for i, p in enumerate(prices)]
    out = clean_listings(frame(spark, rows, S.BRONZE_LISTING_COLUMNS))
    assert sorted(r["price"] for r in out.collect()) == [0.01, 9999.99]


def test_clean_listings_columns(spark):
    out = clean_listings(frame(spark, [listing(host_response_rate="97%", amenities='["a", "b"]')],
                               S.BRONZE_LISTING_COLUMNS), run_ts="2024-01-01 00:00:00")
    r = out.first()
    assert "host_response_rate" not in out.columns and r["host_response_rate_pct"] == 97.0
    assert r["amenity_count"] == 2 and r["source_layer"] == "silver" and r["host_is_superhost"] is True
    assert dict(out.dtypes)["listing_id"] == "bigint"


def test_dedup_is_deterministic_under_partitioning(spark):
    data = [(k % 7, i, f"v{i % 5}") for i, k in enumerate(range(400))]
    df = spark.createDataFrame(data, "k int, i int, v string")
    a = dedup_by_key(df, ["k"], [desc("i")]).orderBy("k").collect()
    b = dedup_by_key(df.repartition(13).orderBy(F.rand(3)), ["k"], [desc("i")]).orderBy("k").collect()
    assert a == b and len(a) == 7
    assert all(r["i"] >= 393 for r in a)
    c = dedup_by_key(df, ["k"], [asc("v"), desc("i")]).orderBy("k").collect()
    assert all(r["v"] == "v0" for r in c)


def test_dedup_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (1, 3)], "k int, d int")
    assert dedup_by_key(df, ["k"], [desc("d", nulls_last=True)]).first()["d"] == 5
    assert dedup_by_key(df, ["k"], [asc("d")]).first()["d"] is None


def test_reviews_prefer_dated_latest(spark):
    rows = [("1", "9", "", "3"), ("1", "9", "2015-01-01", "4"), ("2", "9", "2016-05-01", "4"),
            ("x", "9", "2017-01-01", "4")]
    df = spark.createDataFrame(rows, S.text_schema(S.BRONZE_REVIEW_COLUMNS))
    out = clean_reviews(df).collect()
    assert len(out) == 1
    assert out[0]["listing_id"] == 2 and out[0]["review_year"] == 2016


def test_latest_by_key_as_of(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 10.0), (1, dt.datetime(2024, 2, 1), 11.0)],
                               "k int, ts timestamp, price double")
    assert latest_by_key(df, ["k"], "ts", as_of="2024-01-15 00:00:00").first()["price"] == 10.0
    assert latest_by_key(df, ["k"], "ts").first()["price"] == 11.0


def test_ids_over_32_bits_are_kept(spark):
    ids = ["2147483646", "2147483647", "2147483648", "48000000001", "9007199254740993"]
    df = spark.createDataFrame([(i, i, "2020-01-02", i) for i in ids], S.text_schema(S.BRONZE_REVIEW_COLUMNS))
    out = clean_reviews(df).collect()
    assert sorted(r["review_id"] for r in out) == [int(i) for i in ids]
    assert all(r["listing_id"] == r["review_id"] == r["reviewer_id"] for r in out)
    rows = [listing(listing_id=i, host_id=i) for i in ids]
    out = clean_listings(frame(spark, rows, S.BRONZE_LISTING_COLUMNS)).collect()
    assert sorted(r["listing_id"] for r in out) == sorted(r["host_id"] for r in out) == [int(i) for i in ids]


def test_the_fuller_listing_survives(spark):
    rows = [listing(name=None, price="10"), listing(name="Loft", price="20", review_scores_rating="4.9")]
    for order in (rows, rows[::-1]):
        kept = clean_listings(frame(spark, order, S.BRONZE_LISTING_COLUMNS)).first()
        assert (kept["name"], kept["price"], kept["review_scores_rating"]) == ("Loft", 20.0, 4.9)
