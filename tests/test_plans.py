"""Scale properties of the physical plans (checked without AQE so the whole
plan is visible before execution)."""

import pytest
from pyspark.sql import functions as F

from lakeforge.operators import quality as Q
from lakeforge.operators.dedup import dedup_by_key, desc
from lakeforge.sources import tables as TB


@pytest.fixture
def no_aqe(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_aggregates_before_the_shuffle(no_aqe):
    df = no_aqe.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    p = plan(dedup_by_key(df, ["k"], [desc("v")]))
    lines = [ln for ln in p.splitlines() if "Aggregate" in ln or "Exchange" in ln]
    # final aggregate, exchange on the key, partial aggregate below it
    assert "Aggregate" in lines[0] and "Exchange hashpartitioning(k" in lines[1] and "Aggregate" in lines[2]
    assert "partial_min" in p


def test_row_level_checks_scan_each_table_once(no_aqe, tmp_root):
    path = f"{tmp_root}/t"
    no_aqe.range(100).select(F.col("id"), (F.col("id") % 5).cast("string").alias("v")).write.parquet(path)
    t = TB.read_table(no_aqe, path=path)
    checks = [Q.Check("not_null", "t", "id"), Q.Check("not_null", "t", "v"),
              Q.Check("accepted_values", "t", "v", values=("1", "2")),
              Q.Check("expression", "t", "id", expression="id >= 0")]
    p = plan(Q.run_suite({"t": t}, checks))
    assert p.count("FileScan parquet") == 1


def test_filters_and_columns_reach_the_scan(no_aqe, tmp_root):
    path = f"{tmp_root}/p"
    no_aqe.range(100).select(F.col("id"), (F.col("id") % 7).alias("g"), F.lit("x").alias("pad")) \
        .write.partitionBy("g").parquet(path)
    q = TB.read_table(no_aqe, path=path).filter((F.col("g") == 3) & (F.col("id") > 10)).select("id")
    p = plan(q)
    assert "PartitionFilters: [isnotnull(g" in p and "(g#" in p
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,10)]" in p
    assert "ReadSchema: struct<id:bigint>" in p
