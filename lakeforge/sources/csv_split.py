"""Parallel scan of CSV files whose quoted fields may hold newlines.

A file of any size is read as byte ranges. Each range's lines are read where
they lie; a range is summed up to three numbers (is its count of quotes odd, and
how many records end in it if it begins outside or inside quotes). A prefix sum
over a file's ranges gives the state in which each begins and the number of its
first record. From then on a line knows its record by itself. Nearly all records
are one line; only those of several lines are grouped. Counts run along the lines
in the order in which a task reads them, so lines are neither shuffled nor sorted;
what is broadcast is a row for each range and each file.

Records are parsed as arrays of text, and a file's own header gives the arrays'
places their names, so the files of a folder may order their columns differently.

Rules of the format (RFC 4180): fields are separated by commas, a field with
commas, quotes or newlines is quoted, a quote inside is doubled, and quotes occur
nowhere else. UTF-8, with or without a byte order mark; lines end in LF or CRLF.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Columns that ``keep_errors`` adds: what is wrong with a record, and its text.
ERROR, RECORD = "_error", "_record"
_RANGE = ("file", "start")


def file_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, start, at, line): the lines of all files, in a file by the start of
    their byte range and ``at``. A line that crosses a range's end is of the range
    where it begins."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                      F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def _odd(line: Column) -> Column:
    """1 if the line has an odd number of quotes."""
    return F.pmod(F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit(""))), F.lit(2))


def line_states(lines: DataFrame, *keep: str) -> DataFrame:
    """(file, start, odd), the columns of ``keep``, and what holds within the range:
    ``odd``, whether the line has an odd number of quotes; ``upto``, the quotes'
    parity up to the line's end if the range begins outside quotes; and the records
    that end before the line, if it begins outside (``out_ends``) or inside
    (``in_ends``). ``lines``: whole ranges, as :func:`file_lines` reads them."""

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches (file, start, odd, ...) of a task's lines in their order, with
        ``upto``, ``out_ends`` and ``in_ends`` behind."""
        key, carried = None, np.zeros(3, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            file, start, odd = batch.column(0).dictionary_encode(), batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.int64)
            index, names = file.indices.to_numpy(), file.dictionary
            here = (names[int(index[0])].as_py(), int(start[0]))
            new = np.concatenate(([here != key], (index[1:] != index[:-1]) | (start[1:] != start[:-1])))
            first = np.maximum.accumulate(np.where(new, np.arange(len(odd)), 0))  # of the line's range, in this batch
            going_on = ~np.logical_or.accumulate(new)  # in the range that the batch before ended with

            def count(values: np.ndarray, k: int) -> np.ndarray:
                total = np.cumsum(values)
                return total - (total - values)[first] + going_on * carried[k]

            upto = count(odd, 0) % 2
            outside, inside = count(1 - upto, 1), count(upto, 2)
            key, carried = (names[int(index[-1])].as_py(), int(start[-1])), np.array([upto[-1], outside[-1], inside[-1]])
            more = [pa.array(x) for x in (upto, outside - (1 - upto), inside - upto)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "upto", "out_ends", "in_ends"])

    rows = lines.select(*_RANGE, _odd(F.col("line")).cast("int").alias("odd"), *keep)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(running, f"{kinds}, upto bigint, out_ends bigint, in_ends bigint")


def range_states(states: DataFrame) -> DataFrame:
    """(file, start, inside, first, several): whether each byte range begins inside
    quotes, the number in its file of the record that is open there, and whether it
    has lines of records of several lines. One row per range, so a window over a
    file is small."""
    ranges = states.groupBy(*_RANGE).agg(
        F.sum("odd").alias("odds"), F.sum(1 - F.col("upto")).alias("out_ends"), F.sum("upto").alias("in_ends"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    ranges = ranges.withColumn("inside", F.pmod(F.coalesce(F.sum("odds").over(before), zero), F.lit(2)))
    ends = F.when(F.col("inside") == 1, F.col("in_ends")).otherwise(F.col("out_ends"))
    several = (F.col("inside") == 1) | (F.col("odds") > 0)
    return ranges.withColumn("ends", ends).select(*_RANGE, "inside", F.coalesce(F.sum("ends").over(before), zero).alias("first"), several.alias("several"))


def _placed(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """(file, start, at, line, number, whole): the lines of ``ranges`` with the number
    of their record and whether they are all of it."""
    ranges = ranges.select(F.col("file").alias("r_file"), F.col("start").alias("r_start"), "inside", "first")
    known = lines.join(F.broadcast(ranges), (F.col("file") == F.col("r_file")) & (F.col("start") == F.col("r_start")))
    known = line_states(known, "at", "line", "inside", "first")
    ends = F.when(F.col("inside") == 1, F.col("in_ends")).otherwise(F.col("out_ends"))
    after = F.pmod(F.col("upto") + F.col("inside"), F.lit(2))
    before = F.pmod(F.col("upto") - F.col("odd") + F.col("inside"), F.lit(2))
    return known.select("file", "start", "at", "line", (F.col("first") + ends).alias("number"), ((after == 0) & (before == 0)).alias("whole"))


def _records(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """(file, number, record) of the records in ``ranges``. Only the ranges that have
    lines of longer records are read for these."""
    single = _placed(lines, ranges).where("whole").select("file", "number", F.col("line").alias("record"))
    of_record = F.array_sort(F.collect_list(F.struct("start", "at", "line")))
    several = _placed(lines, ranges.where("several")).where("not whole").groupBy("file", "number").agg(
        F.array_join(F.transform(of_record, lambda x: x["line"]), "\n").alias("record"))
    # not by a regular expression, which would replace bytes that aren't UTF-8
    bare = F.when(F.endswith("record", F.lit("\r")), F.left("record", F.char_length("record") - 1)).otherwise(F.col("record"))
    return single.unionByName(several).withColumn("record", bare)


def split_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, number, record): every record's text, headers (number 0) included.
    A quote that is never closed makes the rest of its file one record."""
    lines = file_lines(spark, paths)
    return _records(lines, range_states(line_states(lines)))


def header_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Like :func:`split_records`, the headers alone: only the ranges in which a
    file's first record begins or goes on are numbered."""
    lines = file_lines(spark, paths)
    return _records(lines, range_states(line_states(lines)).where("first = 0")).where("number = 0")


def _header_names(text: str) -> list[str]:
    return next(csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline="")), [])


def read_csv_split(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, keep_errors: bool = False) -> DataFrame:
    """Header CSV files -> all-STRING records with columns by name; an empty or
    missing field is ``''``, a column that a file lacks too.

    ``columns`` None: the names of all headers, those of the file first by path
    first. Fields beyond the header are dropped, empty lines are no records.
    ``keep_errors`` adds ``_error`` (NULL if the record is sound) and ``_record``
    (the text of one that isn't): ``utf8`` for bytes that aren't UTF-8, ``quotes``
    for a quote that is never closed, ``short`` or ``long`` for fewer or more
    fields than the header's. Without it such records are read as far as they go.

    The distinct header lines come to the driver, one row for each layout.
    """
    records = split_records(spark, paths)
    headers = header_records(spark, paths).select(F.col("file").alias("h_file"), F.col("record").alias("header"))
    layouts = headers.groupBy("header").agg(F.min("h_file").alias("h_file")).orderBy("h_file").collect()
    names = {r["header"]: _header_names(r["header"]) for r in layouts}
    columns = list(columns) if columns is not None else list(dict.fromkeys(n for layout in names.values() for n in layout))
    width = max([len(n) for n in names.values()], default=0) + 1
    fields = [f"c{i}" for i in range(width)]
    body = records.where((F.col("number") > 0) & (F.col("record") != "")).join(
        F.broadcast(headers), F.col("file") == F.col("h_file"))
    valid = F.is_valid_utf8("record")
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "maxCharsPerColumn": "-1", "emptyValue": "", "nullValue": "\u0000",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    parsed = body.select("record", "header", valid.alias("valid"), F.from_csv(F.make_valid_utf8("record"), ", ".join(f"{c} string" for c in fields), options).alias("f"))

    def place(layout: list[str], name: str) -> Column:
        return F.coalesce(F.col(f"f.{fields[layout.index(name)]}"), F.lit("")) if name in layout else F.lit("")

    def by_layout(of) -> Column:
        out = None
        for header, layout in names.items():
            value = of(layout)
            out = F.when(F.col("header") == F.lit(header), value) if out is None else out.when(F.col("header") == F.lit(header), value)
        return out if out is not None else F.lit(None)

    # fields of a record: separators outside quotes, and one
    outside = F.regexp_replace("record", '"[^"]*"', "")
    count = F.octet_length(outside) - F.octet_length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    expected = by_layout(lambda layout: F.lit(len(layout)))
    error = (F.when(~F.col("valid"), "utf8").when(_odd(F.col("record")) == 1, "quotes")
             .when(count < expected, "short").when(count > expected, "long"))
    out = [by_layout(lambda layout, n=n: place(layout, n)).cast("string").alias(n) for n in columns]
    if keep_errors:
        out += [error.alias(ERROR), F.when(error.isNotNull(), F.make_valid_utf8("record")).alias(RECORD)]
    return parsed.select(*out)
