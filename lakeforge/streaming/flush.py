"""Landing by record count: one bronze file for every N records.

A micro-batch admits files, not records. Its rows are numbered in the order of
the log (file, then place), after the rows that the micro-batch before left over;
every N of them are one flush, and fewer than N are left over again. When the
topic is drained, what is left is flushed as the last, shorter one.

Everything a micro-batch writes goes to folders named by its id, in overwrite
mode, and its state (next flush, rows left over) last. A micro-batch that is run
again after a failure therefore writes the same flushes, and a drained topic that
is landed again writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeforge import schemas as S
from lakeforge.plans.ledger import exists
from lakeforge.streaming.ingest import LOG_VALUE_SCHEMA, with_ingest_date

STATE = "micro bigint, next_flush bigint, left_over bigint"


def _numbered(rows: DataFrame) -> DataFrame:
    """(seq, value) of rows (file, start, at, value), numbered from 0 by file and
    place. Counts of files' byte ranges make each range's first number, so rows are
    only ordered within a range, however large its file is."""
    part = ("file", "start")
    ranges = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("n"))
    ranges = ranges.withColumn("first", F.coalesce(F.sum("n").over(Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")))
    place = F.row_number().over(Window.partitionBy(*part).orderBy("at")) - 1
    return rows.withColumn("place", place).join(ranges.select(*part, "first"), [*part]).select((F.col("first") + F.col("place")).alias("seq"), "value")


class CountedLanding:
    """Folders and state of one topic's landing in flushes of ``records`` rows."""

    def __init__(self, spark: SparkSession, topic: str, log_path: str, bronze_root: str, checkpoint_root: str, records: int = S.BRONZE_FILE_RECORDS):
        if records < 1:
            raise ValueError("records must be at least 1")
        self.spark, self.topic, self.records = spark, topic, records
        self.log = f"{log_path}/topic={topic}"
        self.bronze = f"{bronze_root}/{topic}"
        self.side = f"{checkpoint_root}/{topic}-flush"

    def _state(self) -> tuple[int, int, int]:
        """The latest (micro, next flush, rows left over); micro -1 before any."""
        if not exists(self.spark, f"{self.side}/state"):
            return -1, 0, 0
        r = self.spark.read.schema(STATE).parquet(f"{self.side}/state").orderBy(F.desc("micro")).first()
        return (r["micro"], r["next_flush"], r["left_over"]) if r else (-1, 0, 0)

    def _keep_state(self, micro: int, next_flush: int, left_over: int) -> None:
        self.spark.createDataFrame([(micro, next_flush, left_over)], STATE).coalesce(1).write.mode("overwrite").parquet(f"{self.side}/state/at={micro}")

    def _write_flushes(self, numbered: DataFrame, micro: int, tag: str, first_flush: int, flushes: int) -> None:
        tz = self.spark.conf.get("spark.sql.session.timeZone")
        flush = F.lit(first_flush) + F.floor(F.col("seq") / self.records)
        rows = with_ingest_date(numbered.withColumn("flush", F.lpad(flush.cast("string"), 12, "0")), tz)
        (rows.repartition(max(1, flushes), "flush").sortWithinPartitions("flush", "seq").select("value", "year", "month", "day", "flush")
         .write.mode("overwrite").partitionBy("year", "month", "day", "flush").text(f"{self.bronze}/micro={micro:09d}{tag}"))

    def _pending(self, micro: int) -> str:
        return f"{self.side}/pending/at={micro}"

    def take(self, batch: DataFrame, micro: int) -> None:
        """One micro-batch of rows (file, start, value; ``at``, their order within a
        file's part, is added where it isn't there): write full flushes, keep the rest."""
        last, next_flush, left_over = self._state()
        if last >= micro:
            # this micro-batch was written, but the stream didn't note it: its state,
            # and the rows left before it, are those of the one before
            last, next_flush, left_over = self._state_before(micro)
        rows = batch if "at" in batch.columns else batch.withColumn("at", F.monotonically_increasing_id())
        n = batch.count()
        numbered = _numbered(rows).withColumn("seq", F.col("seq") + left_over)
        if left_over:
            numbered = self.spark.read.schema("seq bigint, value string").parquet(self._pending(last)).unionByName(numbered)
        full = (left_over + n) // self.records
        rest = left_over + n - full * self.records
        if full:
            self._write_flushes(numbered.where(F.col("seq") < full * self.records), micro, "", next_flush, full)
        numbered.where(F.col("seq") >= full * self.records).withColumn("seq", F.col("seq") - full * self.records).write.mode("overwrite").parquet(self._pending(micro))
        self._keep_state(micro, next_flush + full, rest)

    def _state_before(self, micro: int) -> tuple[int, int, int]:
        r = self.spark.read.schema(STATE).parquet(f"{self.side}/state").where(F.col("micro") < micro).orderBy(F.desc("micro")).first()
        return (r["micro"], r["next_flush"], r["left_over"]) if r else (-1, 0, 0)

    def finish(self) -> None:
        """Flush what is left over, as one shorter flush."""
        micro, next_flush, left_over = self._state()
        if left_over:
            pending = self.spark.read.schema("seq bigint, value string").parquet(self._pending(micro))
            self._write_flushes(pending, micro, "-last", next_flush, 1)
            self._keep_state(micro, next_flush + 1, 0)

    def drain(self, files_per_trigger: int | None = None) -> int:
        """Land everything that is there and stop; the number of flushes so far."""
        reader = self.spark.readStream.schema(LOG_VALUE_SCHEMA)
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        stream = reader.json(self.log).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
        query = stream.writeStream.foreachBatch(self.take).option("checkpointLocation", f"{self.side}/stream").trigger(availableNow=True).start()
        query.awaitTermination()
        self.finish()
        return self._state()[1]

    def landed_rows(self) -> int:
        """Rows in the flushes so far: all have ``records`` but the shorter ones that
        ended a drain."""
        return self.flushes().agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0] if self._state()[1] else 0

    def flushes(self) -> DataFrame:
        """(flush, records) of every flush written."""
        rows = self.spark.read.schema("value string, micro string, year string, month string, day string, flush string").text(self.bronze)
        return rows.groupBy(F.col("flush").cast("bigint").alias("flush")).agg(F.count(F.lit(1)).alias("records"))

