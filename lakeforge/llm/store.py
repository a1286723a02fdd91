"""Shared storage of a session: intermediate tables and written files.

Every intermediate result that must survive a lost executor, or must not be
computed twice, is a Parquet table in the folder that ``spark.checkpoint.dir``
names. Run folders are removed when the session's JVM ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Where it is unset, local mode, in which driver and
    executors are one process, takes the warehouse's; elsewhere it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/") + "/llm"


def new_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared one; it goes when the JVM ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def save(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once and return the written table: cuts lineage, and the
    Parquet sizes let the optimizer choose joins from real figures."""
    path = new_dir(df.sparkSession, tag) + "/t"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts; sets partition counts from the data's size."""
    return int(df.select(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0)
