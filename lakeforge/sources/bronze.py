"""Bronze JSON-lines scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeforge import schemas as S


def read_bronze(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Read a bronze topic folder (``year=/month=/day=`` partitions).

    With ``columns`` the record schema is fixed (all STRING) and no inference
    pass runs; fields outside it are ignored. ``columns=None`` infers the
    schema, which costs a full extra scan. Partition columns ``year, month,
    day`` are added from the folder names.
    """
    reader = spark.read.option("multiLine", False)
    if columns is not None:
        reader = reader.schema(S.text_schema(columns))
    return reader.json(path)
