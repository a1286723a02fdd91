"""URL filters by a sort-merge range join.

A rule is a host and a path prefix; it fits its host and all subdomains where
the page's path starts with the rule's, and the longest fitting rule (in
characters of host and path, then of host) gives the verdict.

Keys are canonical: the host's labels reversed, each followed by 0x01, then the
path. A rule is the interval of all keys that start with its key. As a rule with
a path must also meet subdomains, a page is keyed once for each number of labels
that rules have: by that many last labels of its host, and its path. Rules and
page keys are range-sorted together; a sweep over each sorted range keeps the
stack of rules whose interval is open, so a page key meets just the nested rules
that hold it, and takes each one's length and verdict from the stack's top.
Intervals that opened in an earlier range are found by the prefixes of a range's
first key, and are the sweep's first stack.

Keys are sorted with the page id, so a page or host that holds a large share of
the rows is dealt over several ranges.

Nulls: a null url, or one without ``://``, has an empty host and path; no rule
fits, as a rule has a host. Very long urls are used whole. Each row of pages gives
one row, also where rows repeat a page id and url, or differ after ``?`` or ``#``
alone. An empty rule table leaves the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm import store

END = "\x01"
#: Rows that one array makes where a page's row is repeated.
COPIES = 10_000


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: str) -> Column:
    return F.reverse(F.split(F.col(host), r"\."))


def _key(labels: Column, path: Column) -> Column:
    """Canonical key of reversed labels and a path."""
    return F.concat(F.array_join(F.transform(labels, lambda x: F.concat(x, F.lit(END))), ""), path)


def sweep(rows: Iterator[tuple], opened: dict[int, list[tuple[str, str, str]]]) -> Iterator[tuple[int, str | None, str | None]]:
    """Over rows (range, key, kind, rule, verdict), each range sorted by key,
    rules (kind 0) before pages: number, rule and verdict of every row, the last two
    null but for page rows that an open rule holds. ``opened``: the first stack of each range, of rules
    (key, rule, verdict)."""
    stack: list[tuple[str, str, str]] = []
    seen = None
    for i, (part, key, kind, rule, verdict) in enumerate(rows):
        if part != seen:
            seen, stack = part, list(opened.get(part, ()))
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        if kind == 0:
            stack.append((key, rule, verdict))
        yield (i, stack[-1][1], stack[-1][2]) if kind and stack else (i, None, None)


def _opened(placed: DataFrame, lengths: list[int]) -> dict[int, list[tuple[str, str, str]]]:
    """The rules of earlier ranges that are open where a range begins. It has at
    most as many rows as there are ranges times nested rules."""
    firsts = placed.groupBy("range").agg(F.min("key").alias("first"))
    prefixes = firsts.select("range", "first", F.explode(F.array(*map(F.lit, lengths))).alias("n")).where(F.col("n") <= F.length("first")).select("range", F.expr("left(first, n)").alias("key"))
    rules = placed.where("kind = 0").select("key", "rule", "rule_verdict", F.col("range").alias("of"))
    out: dict[int, list[tuple[str, str, str]]] = {}
    for r in rules.join(prefixes, "key").where("of < range").select("range", "key", "rule", "rule_verdict").collect():
        out.setdefault(r["range"], []).append((r["key"], r["rule"], r["rule_verdict"]))
    for stack in out.values():
        stack.sort(key=lambda x: len(x[0]))
    return out


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every page. ``rules``: host, path,
    verdict; of equal rules the smallest verdict (allow before block) counts."""
    base = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rules = (
        rules.select(_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .where("host <> ''").groupBy("host", "path").agg(F.min("verdict").alias("rule_verdict"))
        .select(_key(_labels("host"), F.col("path")).alias("key"), F.concat("host", "path").alias("rule"), "rule_verdict", F.size(_labels("host")).alias("labels"))
    )
    # distinct numbers of labels and lengths of rules, not rules: no more than a host name has labels, and a url characters
    shape = rules.agg(F.sort_array(F.collect_set("labels")).alias("labels"), F.sort_array(F.collect_set(F.length("key"))).alias("lengths")).first()
    nothing = F.lit(None).cast("string")
    # a row of each page row; what the sweep finds comes beside it
    plain = base.select("id", "host", "path", nothing.alias("rule"), nothing.alias("rule_verdict"), F.lit(1).alias("rows"))
    if shape["labels"]:
        kinds = F.array(*map(F.lit, shape["labels"]))
        pages_ = base.where("host <> ''").select("id", "host", "path", F.explode(F.filter(kinds, lambda n: n <= F.size(_labels("host")))).alias("n"))
        pages_ = pages_.select(_key(F.slice(_labels("host"), F.lit(1), F.col("n")), F.col("path")).alias("key"), F.lit(1).alias("kind"), F.struct("id", "host", "path").alias("row"), nothing.alias("rule"), nothing.alias("rule_verdict"))
        both = pages_.unionByName(rules.select("key", F.lit(0).alias("kind"), F.lit(None).cast(pages_.schema["row"].dataType).alias("row"), "rule", "rule_verdict"))
        placed = store.save(both.repartitionByRange("key", "kind", "row").withColumn("range", F.spark_partition_id()), "url-ranges")
        opened = _opened(placed, shape["lengths"])
        row_type = placed.schema["row"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows():
                for batch in batches:
                    held.append(batch)
                    yield from zip(*(batch.column(n).to_pylist() for n in ("range", "key", "kind", "rule", "rule_verdict")), strict=True)

            held: list[pa.RecordBatch] = []
            at, found = 0, []
            for i, rule, verdict in sweep(rows(), opened):
                while i >= at + held[0].num_rows:  # the row is in a later batch
                    yield from out(held[0], found, at)
                    at, found = at + held.pop(0).num_rows, []
                if rule is not None:
                    found.append((i, rule, verdict))
            for batch in held:
                yield from out(batch, found, at)
                at, found = at + batch.num_rows, []

        def out(batch: pa.RecordBatch, found: list[tuple[int, str, str]], at: int) -> Iterator[pa.RecordBatch]:
            if found:
                taken = batch.column("row").take(pa.array([i - at for i, _, _ in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([taken, pa.array([r for _, r, _ in found], pa.string()), pa.array([v for _, _, v in found], pa.string())], ["row", "rule", "rule_verdict"])

        swept = placed.repartition("range").sortWithinPartitions("range", "key", "kind", "row").mapInArrow(run, f"row {row_type}, rule string, rule_verdict string")
        plain = plain.unionByName(swept.select("row.*", "rule", "rule_verdict", F.lit(0).alias("rows")))
    best = F.max(F.struct(F.length("rule").alias("a"), F.length(F.regexp_extract("rule", "^[^/]*", 0)).alias("b"), "rule", "rule_verdict")).alias("best")
    judged = plain.groupBy("id", "host", "path").agg(best, F.sum("rows").alias("rows"))
    # as many rows as there were, a limited number from one array
    judged = judged.withColumn("k", F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / COPIES))))
    judged = judged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.lit(COPIES), F.col("rows") - F.col("k") * COPIES))))
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))
