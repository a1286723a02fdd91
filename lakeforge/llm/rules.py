"""Quality rules, per document and per host.

Per document: word counts, characters in words, symbols, repeated lines, and
words in repeated windows of three; a document fails if it is too short or too
repetitive. Per host (here: a source): failures are counted, the host's failure
rate is shrunk towards an empirical beta prior, which is fitted to the rates of
all hosts by the method of moments, and a host whose shrunk rate is over
``max_rate`` is rejected. Its verdict is joined back to its documents. The prior
keeps a host with few documents from being rejected on two or three failures.

Counting is by host with partial aggregation, so a host that holds a third of
all rows is no hot key; the verdict join is left to the optimizer.

Nulls: a null text counts as empty, which fails. A null host is a host of its
own. Texts are read whole. Repeated rows are each counted and judged. Other
columns of the input don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm import store

# White space between words; symbol characters.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """The words of a text (no nulls)."""
    return F.array_remove(F.split(text, "[ \\t-\\r]+"), "")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)
    of every row. Windows are told apart by a 64-bit hash of their words."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.select(
        "id", "host", words_of(F.col("text")).alias("words"),
        F.char_length(F.translate("text", SPACES, "")).cast("bigint").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: F.translate(x, SPACES, "") != "").alias("lines"),
    )
    rows = rows.select(
        "id", "host", "word_chars", "n_symbols", F.size("words").cast("bigint").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr("if(size(words) < 3, array(), transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])))").alias("windows"),
    )
    # documents without a repeated window, most of them, skip the sort
    rows = rows.withColumn("sorted", F.expr("if(size(array_distinct(windows)) = size(windows), null, sort_array(transform(windows, (h, i) -> struct(h, i))))"))
    rows = rows.withColumn("at", F.expr("""
        sort_array(transform(
            filter(sorted, (x, k) -> (k > 0 and sorted[greatest(k - 1, 0)].h = x.h) or (k < size(sorted) - 1 and sorted[least(k + 1, size(sorted) - 1)].h = x.h)),
            x -> x.i))"""))
    return rows.select(
        "id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(F.expr("aggregate(transform(at, (p, k) -> if(k = 0, 3, least(3, p - at[greatest(k - 1, 0)]))), 0L, (s, x) -> s + x)"), F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def host_verdicts(measured: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """(host, n_docs, n_failed, rate, host_kept) of every host."""
    hosts = measured.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("bigint")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).first()  # two numbers
    m, v = moments["m"] or 0.0, moments["v"] or 0.0
    # the beta distribution with the rates' mean and variance; hosts that are all alike count as ten documents
    strength = m * (1 - m) / v - 1 if v > 0 else 10.0
    strength = strength if strength > 0 else 10.0
    shrunk = (F.col("n_failed") + m * strength) / (F.col("n_docs") + strength)
    return hosts.select("host", "n_docs", "n_failed", shrunk.alias("rate"), (shrunk <= max_rate).alias("host_kept"))


def apply_rules(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, max_rate: float = 0.5, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The measures of every row with base_failed and kept."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    measured = store.save(measures(docs, id_col, text_col, host_col).withColumn("base_failed", failed), "rule-measures")
    hosts = host_verdicts(measured, max_rate).select(F.col("host").alias("of"), "host_kept")
    return measured.join(hosts, F.col("host").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.col("host_kept")).alias("kept")
    )
