"""Run ledger: what each pipeline step wrote, and how many rows.

A few JSON lines per step in files of their own under the pipeline's root, each
named when it is whole. Counts are observed while a layer is written, so nothing
is read again for them. Steps that run on their own find in it what earlier ones
left.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "step string, layer string, entity string, row_count bigint, recorded_at timestamp"
FOLDER = "_ledger"


def _place(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _place(spark, path)
    return fs.exists(place)


def put_lines(spark: SparkSession, folder: str, rows: Iterable[dict]) -> None:
    """Write a few rows as one JSON-lines file of the folder, without a Spark job."""
    name = uuid.uuid4().hex[:16]
    fs, staged = _place(spark, f"{folder}/.{name}")
    out = fs.create(staged)
    try:
        out.write(bytearray("".join(json.dumps(r) + "\n" for r in rows).encode()))
    finally:
        out.close()
    if not fs.rename(staged, _place(spark, f"{folder}/{name}.json")[1]):
        raise OSError(f"could not name {folder}/{name}.json")


def record(spark: SparkSession, root: str, step: str, counts: Iterable[tuple[str, str, int]]) -> None:
    """Append (layer, entity, rows) of a step."""
    now = dt.datetime.now(dt.timezone.utc).isoformat()
    rows = [{"step": step, "layer": layer, "entity": entity, "row_count": int(n), "recorded_at": now} for layer, entity, n in counts]
    if rows:
        put_lines(spark, f"{root}/{FOLDER}", rows)


def entries(spark: SparkSession, root: str) -> DataFrame:
    """All entries of a root; none before the first step."""
    path = f"{root}/{FOLDER}"
    return spark.read.schema(SCHEMA).json(path) if exists(spark, path) else spark.createDataFrame([], SCHEMA)


def latest(spark: SparkSession, root: str) -> DataFrame:
    """(layer, entity, row_count): the last entry of each."""
    order = Window.partitionBy("layer", "entity").orderBy(F.desc("recorded_at"))
    return entries(spark, root).withColumn("k", F.row_number().over(order)).where("k = 1").select("layer", "entity", "row_count")
