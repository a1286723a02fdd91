from pyspark.sql import functions as F

from lakeforge.operators.joins import hot_keys, skew_safe_join
from lakeforge.plans import marts
from lakeforge.plans.layers import FixtureLayers
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_hot_key_split_is_exact(spark):
    # key 1 holds 70 % of the fact rows, key 9 has no dimension row, key NULL never matches
    fact = spark.range(1000).select(
        F.when(F.col("id") < 700, F.lit(1)).when(F.col("id") < 990, F.col("id") % 7 + 2)
         .when(F.col("id") < 995, F.lit(9)).otherwise(F.lit(None)).cast("int").alias("k"),
        F.col("id").alias("v"))
    dim = spark.createDataFrame([(i, f"d{i}") for i in range(1, 9)], "k int, d string")
    assert {r["k"]: r["__buckets"] for r in hot_keys(fact, ["k"], 100).collect()} == {1: 7}
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(skew_safe_join(fact, dim, "k", how, hot_key_rows=100)) == rows(fact.join(dim, "k", how)), how


def test_salted_path_matches_in_marts(spark):
    lay = FixtureLayers(spark, SF_SMALL)
    plain = marts.monthly_reviews(lay.stg_listings, lay.stg_reviews, lay.min_year)
    salted = marts.monthly_reviews(lay.stg_listings, lay.stg_reviews, lay.min_year, hot_key_rows=3)
    assert hot_keys(lay.stg_reviews, ["listing_id"], 3).count() > 0
    assert rows(plain) == rows(salted)


def test_run_concurrently_returns_in_order_and_raises(spark):
    import pytest
    from lakeforge.plans.pipeline import run_concurrently
    a, b = run_concurrently(lambda: spark.range(10).count(), lambda: spark.range(20).count())
    assert (a, b) == (10, 20)
    with pytest.raises(Exception):
        run_concurrently(lambda: spark.range(5).count(),
                         lambda: spark.sql("SELECT * FROM no_such_table_anywhere").count())


def test_precomputed_hot_keys_any_set_is_exact(spark):
    fact = spark.range(300).select((F.col("id") % 4).cast("int").alias("k"), F.col("id").alias("v"))
    dim = spark.createDataFrame([(i, f"d{i}") for i in range(3)], "k int, d string")
    given = spark.createDataFrame([(0, 5), (2, 3), (7, 2)], "k int, __buckets int")
    for how in ("inner", "left", "left_anti"):
        assert rows(skew_safe_join(fact, dim, "k", how, hot=given)) == rows(fact.join(dim, "k", how)), how
