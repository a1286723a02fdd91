"""Exact dedup by deterministic block naming.

Equal texts are found without hashes of them. A set of strings is named by
sorting its distinct members: a member's name is an integer in sort order, so
two have one name if and only if they are equal.

1. The pair (length, first block) of every text is named. A text whose name no
   other has equals no other, and is done; only the rest is looked at further.
2. Those texts are cut into blocks of ``block`` characters, and the blocks are
   named.
3. Names of neighbouring blocks are paired, and the pairs are named; this is
   repeated until each document has a single name, its identity. Texts of one
   first name have one length, so they reach it in the same round.

Names are drawn from grouped strings, so copies are combined before they are
shuffled, and joined back from written tables, so that a large group of copies
is split over tasks.

Nulls: a null text counts as empty; empty texts are equal. A null doc_id is a
document like others, and the smallest. Every row is returned and counts in its
group's size, also where rows repeat both doc_id and text; a doc_id with several
texts is several documents. Texts are compared whole, after no change. Other
columns of the input don't matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm import store

FIRST, BLOCK = 256, 4096


def name_sorted(rows: DataFrame, keys: list[str], repeated: bool = False) -> DataFrame:
    """(keys, name): an integer for each distinct key, or for those that stand in
    more than one row; in sort order within a task's part of the keys."""
    groups = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    groups = groups.where("__n > 1") if repeated else groups
    # grouping has dealt the keys by hash: no second exchange, and no sample of keys on the driver
    ordered = groups.select(*keys).sortWithinPartitions(*keys)
    return store.save(ordered.withColumn("name", F.monotonically_increasing_id()), "names")


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: int = FIRST, block: int = BLOCK) -> DataFrame:
    """(id, sha, stem, name) of the rows whose first name is not unique: two
    have equal texts if and only if stem and name are equal."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).select("id", "text", F.char_length("text").alias("size"), F.expr(f"left(text, {first})").alias("start"))
    stems = name_sorted(rows.select("size", "start"), ["size", "start"], repeated=True).withColumnRenamed("name", "stem")
    near = rows.join(stems, ["size", "start"]).select("id", F.sha2("text", 256).alias("sha"), "stem", F.expr(f"if(text = '', array(''), regexp_extract_all(text, '(?s).{{1,{block}}}', 0))").alias("blocks"))
    blocks = store.save(near.select("id", "sha", "stem", (F.size("blocks") - 1).alias("last"), F.posexplode("blocks").alias("i", "block")), "blocks")
    level = store.save(blocks.join(name_sorted(blocks, ["block"]), "block").select("id", "sha", "stem", "last", "i", "name").distinct(), "level")
    done = None
    while True:
        ended = level.where("last = 0").select("id", "sha", "stem", "name")
        done = ended if done is None else done.unionByName(ended)
        level = level.where("last > 0")
        pairs = level.groupBy("id", "sha", "stem", F.shiftright("last", 1).alias("last"), F.shiftright("i", 1).alias("i")).agg(
            F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(-1).cast("bigint")).alias("b")
        )
        pairs = store.save(pairs, "pairs")
        if pairs.isEmpty():
            return done
        level = store.save(pairs.join(name_sorted(pairs, ["a", "b"]), ["a", "b"]).select("id", "sha", "stem", "last", "i", "name"), "level")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every document; of equal
    texts the one with the largest id stays."""
    named = store.save(identities(docs, id_col, text_col), "identities")
    every = store.save(docs.select(F.col(id_col).alias("id"), F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("sha")), "rows")
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("sha") == F.col("of_sha"))
    # rows of each document among those that may have copies
    of_each = every.join(named.select(F.col("id").alias("of"), F.col("sha").alias("of_sha"), "stem", "name"), same)
    counted = of_each.groupBy("of", "of_sha", "stem", "name").agg(F.count("*").alias("rows"))
    counted = store.save(counted, "counted")
    groups = counted.groupBy("stem", "name").agg(F.max("of").alias("keep"), F.sum("rows").alias("size")).where("size > 1")
    copies = counted.join(store.save(groups, "groups"), ["stem", "name"]).select("of", "of_sha", "keep", "size")
    found = every.join(copies, same, "left")
    keep = F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep"))
    return found.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        keep.eqNullSafe(F.col("id")).alias("kept"), F.col("sha").alias("text_sha256"),
    )
