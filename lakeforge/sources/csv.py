"""Raw CSV record source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     multiline: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """Header CSV -> all-STRING records; an empty field is ``''``.

    No type inference pass runs (every field stays text). ``multiline``
    allows quoted newlines inside fields; a multi-line CSV file cannot be
    split, so at scale land many moderate files rather than one huge one, or
    pass ``multiline=False`` when fields never contain newlines.
    """
    reader = (spark.read.option("header", True).option("multiLine", multiline)
              .option("quote", '"').option("escape", '"').option("encoding", encoding)
              .option("mode", "PERMISSIVE")
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    df = reader.csv(path)
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill("", subset=text_cols)


def write_csv_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write records as header CSV with RFC 4180 quoting (quotes doubled);
    surrounding spaces of a field are kept."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("encoding", "UTF-8").csv(path))
