"""Topic log -> bronze JSON lines, as a checkpointed Structured Streaming job.

One query per topic lands the raw message values verbatim (schema-free
bronze) under ``year=YYYY/month=MM/day=DD`` folders of the UTC processing
date, gzipped, at most ``records_per_file`` lines per file. The checkpoint makes the
landing exactly-once: a rerun resumes after the last committed batch and
adds nothing for files it has already seen.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge import schemas as S

LOG_VALUE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])


@dataclass
class StreamRun:
    """Progress of one landing run, from the query's recent progress (the
    last ``spark.sql.streaming.numRecentProgressUpdates`` batches)."""

    topic: str
    batches: int
    input_rows: int


def topic_stream(spark: SparkSession, topic: str, log_path: str | None = None,
                 kafka_servers: str | None = None, max_per_trigger: int | None = None,
                 min_per_trigger: int | None = None, max_trigger_delay: str = "30s") -> DataFrame:
    """Streaming DataFrame of (key, value) text for one topic, from the
    earliest retained message. ``max_per_trigger`` caps a micro-batch: files
    for the log folder, offsets (messages) for Kafka. For Kafka,
    ``min_per_trigger`` holds a micro-batch back until that many messages
    are waiting or ``max_trigger_delay`` has passed (flush at N messages or
    when the topic goes quiet)."""
    if kafka_servers:
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", kafka_servers)
                  .option("subscribe", topic)
                  .option("startingOffsets", "earliest"))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        if min_per_trigger:
            reader = (reader.option("minOffsetsPerTrigger", min_per_trigger)
                      .option("maxTriggerDelay", max_trigger_delay))
        return reader.load().select(F.col("key").cast("string").alias("key"),
                                    F.col("value").cast("string").alias("value"))
    reader = spark.readStream.schema(LOG_VALUE_SCHEMA)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.json(f"{log_path}/topic={topic}")


def with_ingest_date(df: DataFrame, session_tz: str) -> DataFrame:
    """UTC processing-date partition columns (zero-padded month / day)."""
    utc = F.to_utc_timestamp(F.current_timestamp(), session_tz)
    return df.withColumns({
        "year": F.date_format(utc, "yyyy"),
        "month": F.date_format(utc, "MM"),
        "day": F.date_format(utc, "dd"),
    })


def start_landing(spark: SparkSession, topic: str, bronze_root: str, checkpoint_root: str,
                  log_path: str | None = None, kafka_servers: str | None = None,
                  max_per_trigger: int | None = None, records_per_file: int = S.BRONZE_FILE_RECORDS,
                  trigger_interval: str | None = None, min_per_trigger: int | None = None):
    """Start the landing query for ``topic``. By default it drains what is
    available and stops (``availableNow``); with ``trigger_interval`` (e.g.
    ``"30 seconds"``) it keeps running as a continuous consumer and the
    caller owns the returned query."""
    stream = topic_stream(spark, topic, log_path, kafka_servers, max_per_trigger, min_per_trigger)
    tz = spark.conf.get("spark.sql.session.timeZone")
    out = with_ingest_date(stream.select("value"), tz)
    return (out.writeStream.format("text")
            .partitionBy("year", "month", "day")
            .option("path", f"{bronze_root}/{topic}")
            .option("checkpointLocation", f"{checkpoint_root}/{topic}")
            .option("maxRecordsPerFile", records_per_file)
            .option("compression", "gzip")
            .queryName(f"land_{topic.replace('.', '_')}_{uuid.uuid4().hex[:8]}")
            .trigger(**({"processingTime": trigger_interval} if trigger_interval else {"availableNow": True}))
            .start())


def _finish(topic: str, q) -> StreamRun:
    q.awaitTermination()
    progress = q.recentProgress
    return StreamRun(topic, len([p for p in progress if p.get("numInputRows", 0) > 0]),
                     sum(int(p.get("numInputRows", 0)) for p in progress))


def land_topic(spark: SparkSession, topic: str, bronze_root: str, checkpoint_root: str, **kw) -> StreamRun:
    """Drain everything available for ``topic`` into bronze, then stop."""
    return _finish(topic, start_landing(spark, topic, bronze_root, checkpoint_root, **kw))


def land_topics(spark: SparkSession, topics: list[str], bronze_root: str, checkpoint_root: str,
                **kw) -> list[StreamRun]:
    """One independent streaming query per topic (separate buffers, batch
    numbering and checkpoints), all running at the same time."""
    started = [(t, start_landing(spark, t, bronze_root, checkpoint_root, **kw)) for t in topics]
    return [_finish(t, q) for t, q in started]
