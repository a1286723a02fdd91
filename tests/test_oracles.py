"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import check, duck_connect

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = check(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL, verbose=True)
    assert res["status"] in ("match", "rows-only"), res
    assert res["spark_rows"] > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "median_price" in df.columns


ANSI_SENSITIVE = ["lenient_casts", "review_date_parts", "clean_listings", "clean_reviews",
                  "mart_city_pricing", "mart_host_performance", "mart_review_trends"]


@pytest.mark.parametrize("name", ANSI_SENSITIVE)
def test_query_matches_oracle_with_ansi_off(spark, con, name):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        res = check(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert res["status"] == "match", res
