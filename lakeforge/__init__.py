"""lakeforge — a Spark-native medallion lakehouse toolkit.

Layers: CSV records -> keyed topic log -> date-partitioned bronze JSON ->
typed silver tables -> gold marts -> data-quality checks and BI datasets.
Everything is expressed with DataFrame / Structured Streaming operators and
built-in ``pyspark.sql.functions``; no Python UDFs run in the hot path.
"""

__version__ = "0.1.0"
