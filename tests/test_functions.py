"""Edge rows for the scalar helpers (ANSI on and off give the same answer)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lakeforge import functions as LF


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn("x")).collect()]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", old)


def test_to_int(spark, ansi):
    got = one_col(spark, ["3.0", " 7 ", "", "abc", "9999999999", "3.7", "-2", None, "NaN"], LF.to_int)
    assert got == [3, 7, None, None, None, 3, -2, None, None]


def test_to_double(spark, ansi):
    assert one_col(spark, ["12.50", "", "x", None], LF.to_double) == [12.5, None, None, None]


def test_flag(spark, ansi):
    assert one_col(spark, ["t", "f", "", "T", None], LF.flag) == [True, False, False, False, None]


def test_pct_from_text(spark, ansi):
    assert one_col(spark, ["97%", "97.5%", "0.97", "N/A", "", None], LF.pct_from_text) == [
        97.0, 97.0, 0.0, None, None, None]


def test_list_length_legacy(spark, ansi):
    got = one_col(spark, ["[]", "", '["Wifi", "TV, cable"]', None, '["a"]'], LF.list_length)
    assert got == [1, 1, 3, -1, 1]


def test_title_case(spark):
    assert one_col(spark, ["  rio de janeiro ", "", "PARIS"], LF.title_case) == ["Rio De Janeiro", "", "Paris"]


def test_to_date_lenient(spark, ansi):
    got = one_col(spark, ["2015-13-01", "2015-1-5", "", "2015-03-09", None], LF.to_date_lenient)
    assert got == [None, None, None, dt.date(2015, 3, 9), None]


def test_round_half_up(spark):
    # half away from zero on the binary value: 0.285 is stored as 0.28499...
    got = one_col(spark, [0.285, 2.5, -2.5, 0.125, -0.125, None, 0.0], lambda c: LF.round_half_up(c, 2), "double")
    assert got == [0.28, 2.5, -2.5, 0.13, -0.13, None, 0.0]
    assert one_col(spark, [0.5, 1.5, -0.5], lambda c: LF.round_half_up(c, 0), "double") == [1.0, 2.0, -1.0]


@pytest.mark.parametrize("value,label", [
    (49.99, "Budget"), (50.0, "Mid-range"), (99.99, "Mid-range"), (100.0, "Premium"),
    (199.99, "Premium"), (200.0, "Luxury"), (None, "Luxury")])
def test_price_tier(spark, value, label):
    assert one_col(spark, [value], LF.price_tier, "double") == [label]


@pytest.mark.parametrize("superhost,rating,label", [
    (True, 4.8, "Elite"), (True, 4.79, "Superhost"), (True, None, "Superhost"),
    (False, 4.5, "Experienced"), (None, 4.9, "Experienced"), (False, None, "Standard"),
    (None, None, "Standard")])
def test_host_tier(spark, superhost, rating, label):
    df = spark.createDataFrame([(superhost, rating)], "s boolean, r double")
    assert df.select(LF.host_tier("s", "r")).first()[0] == label


def test_amenity_bucket(spark):
    assert one_col(spark, [4, 5, 9, 10, None], LF.amenity_bucket, "int") == [
        "Few (<5)", "Medium (5-10)", "Medium (5-10)", "Many (10+)", "Many (10+)"]


def test_stable_avg_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 1e-2, 123.45, 0.28] * 50
    a = spark.createDataFrame([(v,) for v in vals], "x double")
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").repartition(7)
    ra = a.agg(LF.stable_avg("x", 2)).first()[0]
    rb = b.agg(LF.stable_avg("x", 2)).first()[0]
    assert ra == rb == 20.72


def test_exact_avg_keeps_every_decimal(spark):
    avg = lambda vals, d: spark.createDataFrame([(v,) for v in vals], "x double").agg(LF.stable_avg("x", d)).first()[0]
    # inputs cut to two decimals would give 0.01
    assert avg([0.005, 0.005, 0.004, 0.004], 2) == 0.0
    assert avg([1e15, 0.125, -1e15], 2) == 0.04 and avg([2.5], 0) == 3.0 and avg([-2.5], 0) == -3.0 and avg([-0.001], 2) == 0.0
    assert avg([0.285], 2) == 0.28 and avg([0.125], 2) == 0.13 and avg([-0.125, -0.125], 2) == -0.13
    # tiny bits decide a tie
    assert avg([0.5, 0.5 + 2**-40], 0) == 1.0 and avg([0.5, 0.5 - 2**-40], 0) == 0.0
    assert avg([float("nan"), 1.0], 2) is None and avg([2.0**63, 1.0], 2) is None


def test_exact_avg_has_one_sum_a_unit(spark):
    df = spark.range(5).select((F.col("id") / 7).alias("x"), (F.col("id") % 2).alias("g")).groupBy("g").agg(LF.stable_avg("x", 2).alias("a"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") == 4 and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_sketches_merge(spark):
    df = spark.range(40_000).select((F.col("id") % 7).alias("part"), F.col("id").cast("double").alias("x"))
    whole = df.agg(LF.quantile_sketch("x").alias("s")).select(LF.sketch_quantile("s", 0.3).alias("q"), LF.sketch_rank("s", F.lit(12000.0)).alias("r"), LF.sketch_rows("s").alias("n")).first()
    parts = df.groupBy("part").agg(LF.quantile_sketch("x").alias("s"))
    merged = parts.agg(LF.merge_sketches("s").alias("s")).select(LF.sketch_quantile("s", 0.3).alias("q"), LF.sketch_rank("s", F.lit(12000.0)).alias("r"), LF.sketch_rows("s").alias("n")).first()
    for got in (whole, merged):
        assert got["n"] == 40_000
        assert abs(got["q"] / 40_000 - 0.3) < 2 * LF.rank_error() and abs(got["r"] - 0.3) < 2 * LF.rank_error()
    nothing = spark.createDataFrame([(None,)], "x double").agg(LF.quantile_sketch("x").alias("s"))
    assert nothing.first()["s"] is None and nothing.select(LF.sketch_quantile("s")).first()[0] is None
    assert nothing.agg(LF.merge_sketches("s")).first()[0] is None


def test_stable_avg_nulls(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert df.agg(LF.stable_avg("x", 2)).first()[0] is None
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "x double")
    assert df.agg(LF.stable_avg("x", 1)).first()[0] == 1.5


def test_pct_of_zero_denominator(spark, ansi):
    df = spark.createDataFrame([(1, 0), (1, 3)], "n long, d long")
    assert [r[0] for r in df.select(LF.pct_of(F.col("n"), F.col("d"))).collect()] == [None, 33.3]


def test_month_start_and_days_between(spark):
    df = spark.createDataFrame([(2015, 3, dt.date(2015, 1, 1), dt.date(2015, 1, 31))],
                               "y int, m int, a date, b date")
    r = df.select(LF.month_start("y", "m"), LF.month_start_text("y", "m"), LF.days_between("a", "b")).first()
    assert r[0] == r[1] == dt.date(2015, 3, 1)
    assert r[2] == 30


def test_to_double_is_finite(spark, ansi):
    vals = ["NaN", "+NaN", " inf ", "-Infinity", "nan", "+nan", "N/A", "n", "0x1p3", "1e3", "3d", "", "  "]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in df.select(LF.to_double("x")).collect()]
    cast = [r[0] for r in df.select(F.col("x").try_cast("double")).collect()]
    assert got == [v if v is not None and math.isfinite(v) else None for v in cast]


def test_to_long_keeps_every_digit(spark, ansi):
    vals = ["9007199254740993", " 7 ", "3.7", "48000000001", "99999999999999999999", "x", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    assert [r[0] for r in df.select(LF.to_long("x")).collect()] == [9007199254740993, 7, 3, 48000000001, None, None, None, None]


def test_small_negative_growth_is_plain_zero(spark):
    out = spark.range(1).select(LF.growth_pct(F.lit(99999), F.lit(100000)).cast("string")).first()[0]
    assert out == "0.0"
