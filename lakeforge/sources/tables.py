"""Table sinks and scans: namespaces, partitioned replace, CTAS-style
materialisation, catalog listing, as-of reads and additive schema evolution.

The default provider is Parquet through the session catalog; ``iceberg``
uses ``DataFrameWriterV2`` when that catalog is configured.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.operators.dedup import latest_by_key


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{loc}")


def _prepare(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str], rebalance: bool) -> DataFrame:
    if partition_by and rebalance:
        # Groups rows of a partition value into few tasks (few files) while
        # AQE splits a value that holds a large share of the rows.
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        # the writer wants rows by partition value; unless the order begins with
        # that, it sorts once more, by the value alone, and the order is lost
        lead = [c for c in partition_by if c not in [s for s in sort_by if isinstance(s, str)][:len(partition_by)]]
        df = df.sortWithinPartitions(*lead, *sort_by)
    return df


def write_table(df: DataFrame, name: str | None = None, path: str | None = None,
                partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
                provider: str = "parquet", mode: str = "overwrite", rebalance: bool = True,
                properties: dict[str, str] | None = None) -> None:
    """Create-or-replace a (partitioned) table by ``name``, or files at ``path``.

    ``sort_by`` orders rows within each written file (the read side gives
    no global order guarantee anyway). Never overwrite a table that ``df``
    itself reads from.
    """
    df = _prepare(df, partition_by, sort_by, rebalance)
    if provider == "iceberg":
        if name is None:
            raise ValueError("iceberg tables need a name")
        w = df.writeTo(name).using("iceberg")
        for k, v in (properties or {"format-version": "2"}).items():
            w = w.tableProperty(k, v)
        if partition_by:
            w = w.partitionedBy(*[F.col(c) for c in partition_by])
        w.createOrReplace()
        return
    w = df.write.mode(mode).format(provider)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name is None:
        if path is None:
            raise ValueError("give a table name or a path")
        w.save(path)
        return
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(name)


def read_table(spark: SparkSession, name: str | None = None, path: str | None = None,
               schema: T.StructType | None = None, provider: str = "parquet",
               merge_schema: bool = False) -> DataFrame:
    """Scan a table by name or path. A ``schema`` fixes partition column types
    (no inference from folder names); ``merge_schema`` unions the columns of
    files written at different schema versions."""
    if name is not None:
        return spark.table(name)
    reader = spark.read.format(provider)
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def materialize(df: DataFrame, name: str | None = None, path: str | None = None,
                partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """CTAS: write ``df`` as a table and return the scan of what was written."""
    write_table(df, name=name, path=path, partition_by=partition_by, sort_by=sort_by)
    return read_table(df.sparkSession, name=name, path=path, schema=None if name else df.schema)


def list_catalog(spark: SparkSession, namespace: str | None = None) -> DataFrame:
    """``SHOW TABLES`` (in one namespace) or ``SHOW NAMESPACES``."""
    if namespace:
        return spark.sql(f"SHOW TABLES IN {namespace}")
    return spark.sql("SHOW NAMESPACES")


def file_order(spark: SparkSession, path: str, sort_by: Sequence[str | Column], schema: T.StructType | None = None) -> DataFrame:
    """(file, rows, violations) of a Parquet table's written files: how often a row's
    place in its file is not after that of a row that ``sort_by`` puts before it."""
    rows = read_table(spark, path=path, schema=schema)
    placed = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    by = [F.col(c) if isinstance(c, str) else c for c in sort_by]
    ranked = placed.withColumn("__rank", F.dense_rank().over(Window.partitionBy("__file").orderBy(*by)))
    before = F.lag("__rank").over(Window.partitionBy("__file").orderBy("__at"))
    return ranked.withColumn("__before", before).groupBy(F.col("__file").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("__before") > F.col("__rank")).alias("violations"))


def as_of(history: DataFrame, keys: Sequence[str], version_column: str, timestamp) -> DataFrame:
    """Snapshot of an append-only history table as it was at ``timestamp``:
    per key, the newest version stamped at or before it."""
    return latest_by_key(history, keys, version_column, as_of=timestamp)


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Additive schema evolution in memory: columns missing on one side are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def read_table_as_of(spark: SparkSession, name: str, timestamp: str) -> DataFrame:
    """Time-travel read of a catalog table that keeps snapshots (Iceberg,
    Delta): the table as of ``timestamp``. Plain Parquet tables keep no
    snapshots; use :func:`as_of` over an append-only history for them."""
    return spark.sql(f"SELECT * FROM {name} TIMESTAMP AS OF '{timestamp}'")


def add_columns(spark: SparkSession, name: str, columns: dict[str, str]) -> None:
    """Additive schema evolution of a catalog table without rewriting data:
    existing files read the new columns as NULL."""
    spec = ", ".join(f"{c} {t}" for c, t in columns.items())
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({spec})")
