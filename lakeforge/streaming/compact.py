"""Compaction of landed files, by a manifest that readers follow.

A landing stream writes many small files. ``compact`` takes the files of closed
days, packs them into bins of about ``target_bytes`` by their sizes alone,
rewrites each bin as one file, and commits a new version of the manifest, which
lists the files replaced and those that replace them. Readers take the landed
files less the replaced ones, and the replacements, so a reader sees a bin's rows
in one form only, and files landed later without a new manifest.

A version is a folder that gets its name by renaming when it is whole; if another
compaction was faster, the rename fails and the rewritten files count for nothing.
Replaced files stay for readers of older versions.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeforge import schemas as S

TARGET_BYTES = 256 << 20
ENTRY = "path string, bytes bigint, replaced boolean, day string"
_DAY = r"year=(\d{4})/month=(\d{2})/day=(\d{2})/"


@dataclass
class Compaction:
    """What a run did: files rewritten, files made, and the manifest's version
    (None if there was nothing to do)."""

    replaced: int
    made: int
    version: int | None


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def versions(spark: SparkSession, manifest: str) -> list[int]:
    """Versions of a manifest, rising."""
    fs, path = _fs(spark, manifest)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[2:]) for n in names if n.startswith("v-"))


def _entries(spark: SparkSession, manifest: str, version: int | None) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(f"{manifest}/v-{version:09d}")


def _landed(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, day) of landed files; only their metadata is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("bytes"))
    day = F.concat_ws("-", *[F.regexp_extract("path", _DAY, k) for k in (1, 2, 3)])
    return files.withColumn("day", day)


def live_files(spark: SparkSession, path: str, manifest: str, version: int | None = None) -> DataFrame:
    """(path, bytes, day) of the files that hold the topic's rows, each once, by a
    version of the manifest (default: the latest)."""
    known = versions(spark, manifest)
    version = version if version is not None else (known[-1] if known else None)
    entries = _entries(spark, manifest, version)
    left = _landed(spark, path).join(entries.where("replaced").select("path"), "path", "left_anti")
    return left.unionByName(entries.where("not replaced").select("path", "bytes", "day"))


def read_live(spark: SparkSession, path: str, manifest: str, columns: list[str], version: int | None = None) -> DataFrame:
    """The topic's records, with year, month and day of their landing. The list of
    live files is the driver's, as any file listing is."""
    paths = [r["path"] for r in live_files(spark, path, manifest, version).select("path").collect()]
    schema = S.text_schema(columns)
    if not paths:
        return spark.createDataFrame([], schema.add("year", "string").add("month", "string").add("day", "string"))
    file = F.col("_metadata.file_path")
    return spark.read.schema(schema).json(paths).select(*columns, *[F.regexp_extract(file, _DAY, k).alias(c) for k, c in enumerate(("year", "month", "day"), 1)])


def plan_bins(files: DataFrame, closed_before: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(path, bytes, day, bin): files of days before ``closed_before`` (yyyy-MM-dd)
    that share a bin with another file. A bin ends where the sum of the day's
    sizes, by path, passes a multiple of the target; larger files stay."""
    small = files.where((F.col("day") < F.lit(closed_before)) & (F.col("day") != "--") & (F.col("bytes") < target_bytes))
    before = Window.partitionBy("day").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    bins = small.withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes).cast("bigint"))
    shared = F.count(F.lit(1)).over(Window.partitionBy("day", "bin"))
    return bins.withColumn("shared", shared).where("shared > 1").drop("shared")


def compact(spark: SparkSession, path: str, manifest: str, closed_before: str, target_bytes: int = TARGET_BYTES) -> Compaction:
    """Rewrite the small live files of closed days, and commit the new manifest."""
    known = versions(spark, manifest)
    current = known[-1] if known else None
    run = f"{manifest}/data/{uuid.uuid4().hex[:16]}"
    bins_path = f"{run}/bins"
    plan_bins(live_files(spark, path, manifest, current), closed_before, target_bytes).write.parquet(bins_path)
    bins = spark.read.schema("path string, bytes bigint, day string, bin bigint").parquet(bins_path)
    count = bins.select("day", "bin").distinct().count()
    if not count:
        return Compaction(0, 0, current)
    sources = [r["path"] for r in bins.select("path").collect()]
    lines = spark.read.text(sources).select("value", F.col("_metadata.file_path").alias("file"))
    # both names of a file as paths without a scheme's empty host
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    placed = lines.join(bins.select(plain(F.col("path")).alias("of"), "day", "bin"), plain(F.col("file")) == F.col("of"))
    parts = {c: F.split("day", "-")[k] for k, c in enumerate(("year", "month", "day"))}
    out = placed.repartition(count, "day", "bin").select("value", *[v.alias(f"p_{c}") for c, v in parts.items()]).withColumnsRenamed({f"p_{c}": c for c in parts})
    out.write.partitionBy("year", "month", "day").text(f"{run}/files")
    made = _landed(spark, f"{run}/files")
    kept = _entries(spark, manifest, current).join(bins.select("path"), "path", "left_anti")
    entries = (kept.unionByName(bins.select("path", "bytes", F.lit(True).alias("replaced"), "day"))
               .unionByName(made.select("path", "bytes", F.lit(False).alias("replaced"), "day")))
    version = (current if current is not None else -1) + 1
    staged = f"{manifest}/.staged-{uuid.uuid4().hex[:16]}"
    entries.write.parquet(staged)
    fs, source = _fs(spark, staged)
    target = _fs(spark, f"{manifest}/v-{version:09d}")[1]
    if fs.exists(target) or not fs.rename(source, target):
        raise RuntimeError(f"another compaction committed version {version} of {manifest}; run again")
    return Compaction(len(sources), made.count(), version)
