"""Keyed topic log: records -> (topic, key, JSON value) messages.

With ``kafka_servers`` the messages go to Kafka (needs the Kafka connector
jar); otherwise to a JSON-lines folder partitioned by topic, which the
streaming landing job reads like a topic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeforge import schemas as S
from lakeforge.sources.csv_split import ERROR, RECORD

UNKNOWN_KEY = "unknown"
#: The log's files are compressed, so a file is read by one task: this bounds it.
LOG_FILE_RECORDS, LOG_COMPRESSION = 200_000, "gzip"
#: Records that could not be read go to a topic of this suffix.
ERRORS = ".errors"


def message_key(df: DataFrame, key_field: str):
    if key_field not in df.columns:
        return F.lit(UNKNOWN_KEY)
    return F.coalesce(F.col(key_field).cast("string"), F.lit(UNKNOWN_KEY))


def to_topic_messages(df: DataFrame, topic: str, key_field: str) -> DataFrame:
    """One message per record: the record as a JSON object (NULL fields kept
    as ``null``, non-ASCII text kept as is) keyed by ``key_field``, or
    ``'unknown'`` when the field is missing or NULL."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(F.lit(topic).alias("topic"), message_key(df, key_field).alias("key"), value.alias("value"))


def with_dead_letters(df: DataFrame, topic: str, key_field: str) -> DataFrame:
    """Like :func:`to_topic_messages`, for records with the columns that
    ``read_csv_split(keep_errors=True)`` adds: a record with an error becomes a
    message of the topic's errors, keyed by the kind, with the record's text."""
    bad = F.col(ERROR).isNotNull()
    fields = [c for c in df.columns if c not in (ERROR, RECORD)]
    keep = {"ignoreNullFields": "false"}
    value = F.to_json(F.struct(*fields), keep)
    letter = F.to_json(F.struct(F.col(ERROR).alias("error"), F.col(RECORD).alias("record")), keep)
    return df.select(F.when(bad, topic + ERRORS).otherwise(topic).alias("topic"),
                     F.when(bad, F.col(ERROR)).otherwise(message_key(df, key_field)).alias("key"),
                     F.when(bad, letter).otherwise(value).alias("value"))


@dataclass
class PublishResult:
    topic: str
    sent: int
    unknown_keys: int
    errors: int = 0


def write_topic_log(messages: DataFrame, path: str | None = None, mode: str = "append",
                    key_partitions: int | None = None, kafka_servers: str | None = None,
                    topic: str | None = None) -> None:
    """Append messages to the log, as gzipped JSON lines of at most
    ``LOG_FILE_RECORDS`` records a file.

    ``key_partitions`` hash-partitions by key first, so all messages of a
    key land in one file per batch (the broker's key affinity); it is off by
    default because a hot key would then pile into one task. When every
    message has the same ``topic``, the files go straight into its
    ``topic=`` folder, so publishers of different topics never share a
    commit folder and can run at the same time.
    """
    if key_partitions:
        messages = messages.repartition(key_partitions, "key")
    if kafka_servers:
        (messages.select("topic", "key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", kafka_servers).option("kafka.acks", "all")
         .option("kafka.retries", "3").save())
        return
    files = {"compression": LOG_COMPRESSION, "maxRecordsPerFile": LOG_FILE_RECORDS}
    if topic is not None:
        messages.drop("topic").write.mode(mode).options(**files).json(f"{path}/topic={topic}")
        return
    messages.write.mode(mode).options(**files).partitionBy("topic").json(path)


def publish_records(df: DataFrame, topic: str, key_field: str, path: str | None = None,
                    kafka_servers: str | None = None, key_partitions: int | None = None) -> PublishResult:
    """Records -> messages -> log in one pass, counting sent messages and
    unknown keys with an observation (no second scan). Records that carry an error
    (``read_csv_split(keep_errors=True)``) are counted apart and go to the topic's
    errors in the same pass; such publishers share the log's commit folder, so run
    them one after the other. The counts are
    reporting only: a stage that Spark re-executes after a lost executor
    may be counted again; ``ingest_counts`` gives exact counts from the log."""
    obs = Observation(f"publish_{topic}")
    split = ERROR in df.columns
    messages = with_dead_letters(df, topic, key_field) if split else to_topic_messages(df, topic, key_field)
    sent = F.col("topic") == F.lit(topic)
    messages = messages.observe(obs, F.count_if(sent).alias("sent"), F.count_if(~sent).alias("errors"),
                                F.count_if(sent & (F.col("key") == F.lit(UNKNOWN_KEY))).alias("unknown_keys"))
    write_topic_log(messages, path, key_partitions=key_partitions, kafka_servers=kafka_servers, topic=None if split else topic)
    m = obs.get
    return PublishResult(topic, int(m["sent"]), int(m["unknown_keys"]), int(m["errors"]))


def read_topic_log(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """Batch read of the log folder; a ``topic`` filter prunes partitions."""
    df = spark.read.schema(S.TOPIC_MESSAGE_SCHEMA).json(path)
    return df if topic is None else df.filter(F.col("topic") == F.lit(topic))


def parse_messages(messages: DataFrame, columns: list[str]) -> DataFrame:
    """Message values -> typed-as-text record columns."""
    rec = F.from_json(F.col("value"), S.text_schema(columns))
    return messages.select("topic", "key", rec.alias("r")).select("topic", "key", "r.*")


def ingest_counts(messages: DataFrame) -> DataFrame:
    """Per-topic sent and unknown-key counts (the producer's accounting)."""
    return messages.groupBy("topic").agg(
        F.count(F.lit(1)).alias("sent_records"),
        F.count_if(F.col("key") == F.lit(UNKNOWN_KEY)).alias("unknown_keys"))


def ingest_accounting(messages: DataFrame) -> DataFrame:
    """Per topic the records sent, those that went to its errors, by kind, and both
    together."""
    bad = F.endswith("topic", F.lit(ERRORS))
    base = F.when(bad, F.substring("topic", F.lit(1), F.char_length("topic") - len(ERRORS))).otherwise(F.col("topic"))
    kinds = [F.count_if(bad & (F.col("key") == kind)).alias(f"{kind}_records") for kind in ("short", "long", "quotes", "utf8")]
    return messages.groupBy(base.alias("topic")).agg(
        F.count_if(~bad).alias("sent_records"), F.count_if(bad).alias("error_records"), *kinds,
        F.count_if(~bad & (F.col("key") == F.lit(UNKNOWN_KEY))).alias("unknown_keys"), F.count(F.lit(1)).alias("records"))
