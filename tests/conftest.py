import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    builder = (SparkSession.builder.master("local[*]").appName("lakeforge-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               # what is written where the environment names no spark.checkpoint.dir
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lakeforge-tests-")))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def tmp_root(spark):
    from lakeforge.plans.pipeline import new_run_root
    return new_run_root(spark, "tests")
