"""Mixing sources to target weights: a token budget for a tree of domains,
languages and sources.

Available tokens are summed per leaf, once. The budget then goes down the tree:
at each node it is split over the children by weight. A child whose documents,
read ``max_epochs`` times, can't fill its share gets what it has, and its
shortage goes to its siblings by weight; a node's capacity is its leaves' sum, so
only what all siblings together can't take is left to the parent's siblings.

A leaf reads its documents in epochs. It takes as many whole epochs as its
budget holds, then a prefix of the next: each epoch has an order of its own, by
the MD5 of seed, epoch and document id. The prefix ends within a document; that
one is taken for the tokens that are left.

The order within a leaf is cut into buckets by the leading digits of the MD5.
Sums per bucket tell which bucket holds the end of the prefix; only that
bucket's rows are sorted. A leaf with a third of all documents thus needs no
task of its own.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` of the whole text. All arithmetic is on
integers. Nulls: a null text has no tokens; a null language or source counts as
''. Documents without tokens are never taken. Rows that repeat a document count
each. Nodes that the weights don't name have weight 1; a weight of 0 takes
nothing. A budget over what there is takes everything.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm import store
from lakeforge.llm.rules import words_of

LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mix:
    """``weights``: integer weight of a node, by its path from the root, such as
    ``("web", "en")``. The budget is ``percent`` of the tokens there are."""

    weights: dict[tuple[str, ...], int] = field(default_factory=dict)
    percent: int = 75
    max_epochs: int = 3
    seed: str = "mix-1"
    bucket_digits: int = 3


def tokens_of(docs: DataFrame, domain: Column, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, also, domain, lang, source, n_tokens) of every row; ``also`` are
    columns to carry along, such as what tells rows of one doc_id apart."""
    return docs.select(
        "doc_id", *also, F.coalesce(domain, F.lit("")).alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        F.size(words_of(F.coalesce("text", F.lit("")))).cast("bigint").alias("n_tokens"),
    )


def _weight(mix: Mix, depth: int) -> Column:
    """A node's weight, from its path's columns."""
    named = [(path, w) for path, w in mix.weights.items() if len(path) == depth + 1]
    out = F.lit(1).cast("bigint")
    for path, w in named:
        here = F.lit(True)
        for level, name in zip(LEVELS, path, strict=False):
            here = here & (F.col(level) == name)
        out = F.when(here, F.lit(w).cast("bigint")).otherwise(out)
    return out


def split_budget(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Split ``budget`` (of the parent, in every row) over children with
    capacity ``cap`` and ``weight``: adds ``share``.

    Children are ordered by capacity per weight. One is filled up if its
    capacity is no more than its part, by weight, of what those before it left;
    so are then all before it. The others share the rest by weight, rounded by
    differences of running sums, which add up to the rest and stay within
    capacity."""
    order = [F.col("cap") / F.col("weight"), F.col(child)]
    at = Window.partitionBy(*parent).orderBy(*order)
    wide = Window.partitionBy(*parent)
    big = lambda c: c.cast("decimal(38,0)")
    rows = children.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0).cast("bigint"))).withColumn("weight", F.greatest("weight", F.lit(1).cast("bigint")))
    rows = rows.withColumn("budget", F.least("budget", F.sum("cap").over(wide)))
    rows = rows.withColumn("before", F.sum("cap").over(at) - F.col("cap")).withColumn("open", F.sum("weight").over(wide) - F.sum("weight").over(at) + F.col("weight"))
    rows = rows.withColumn("full", big(F.col("cap")) * big(F.col("open")) <= big(F.col("weight")) * big(F.col("budget") - F.col("before")))
    rows = rows.withColumn("rest", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(wide), F.lit(0)))
    light = F.when(F.col("full"), F.lit(0).cast("bigint")).otherwise(F.col("weight"))
    rows = rows.withColumn("upto", F.sum(light).over(at)).withColumn("all_open", F.sum(light).over(wide)).withColumn("own", light)
    part = lambda c: F.expr(f"(cast(rest as decimal(38,0)) * cast({c} as decimal(38,0))) div cast(all_open as decimal(38,0))")
    share = F.when(F.col("full"), F.col("cap")).otherwise(part("upto") - part("(upto - own)"))
    return rows.withColumn("share", share).drop("before", "open", "full", "rest", "upto", "all_open", "own", "budget", "weight")


def leaf_budgets(tokens: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, total, share) of every leaf."""
    leaves = tokens.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("total")).where("total > 0").withColumn("cap", F.col("total") * mix.max_epochs)
    leaves = store.save(leaves, "mix-leaves")
    total = leaves.agg(F.sum("total").alias("t")).first()["t"] or 0
    budgets = None
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"), F.sum("total").alias("total")).withColumn("weight", _weight(mix, depth))
        nodes = nodes.withColumn("budget", F.lit(total * mix.percent // 100).cast("bigint")) if budgets is None else nodes.join(budgets, path[:-1])
        shared = split_budget(nodes.withColumn("root", F.lit(0)), path[:-1] or ["root"], level)
        budgets = shared.select(*path, F.col("share").alias("budget"))
    return shared.select(*LEVELS, "total", "share")


def select(tokens: DataFrame, leaves: DataFrame, mix: Mix, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, also, domain, lang, source, epoch, n_tokens, take_tokens): a row
    for each document and epoch in which it is taken."""
    plan = leaves.where("share > 0").select(*LEVELS, F.expr("share div total").alias("whole"), (F.col("share") % F.col("total")).alias("rest"))
    rows = tokens.where("n_tokens > 0").join(plan, list(LEVELS))
    out = ["doc_id", *also, *LEVELS, "epoch", "n_tokens", "take_tokens"]
    whole = rows.where("whole > 0").select("doc_id", *also, *LEVELS, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1)).alias("epoch"), "n_tokens").withColumn("take_tokens", F.col("n_tokens"))
    key = F.md5(F.concat_ws(":", F.lit(mix.seed), F.col("whole").cast("string"), F.col("doc_id").cast("string")))
    last = rows.where("rest > 0").withColumn("key", key).withColumn("bucket", F.substring("key", 1, mix.bucket_digits))
    sums = last.groupBy(*LEVELS, "bucket", "rest").agg(F.sum("n_tokens").alias("size"))
    sums = sums.withColumn("upto", F.sum("size").over(Window.partitionBy(*LEVELS).orderBy("bucket"))).withColumn("before", F.col("upto") - F.col("size")).where("before < rest")
    sums = store.save(sums.select(*LEVELS, "bucket", "upto", "before"), "mix-buckets")
    placed = last.join(sums, [*LEVELS, "bucket"])
    inner = placed.where("upto <= rest").withColumn("take_tokens", F.col("n_tokens"))
    run = F.sum("n_tokens").over(Window.partitionBy(*LEVELS).orderBy("key", "doc_id", "n_tokens", *also).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edge = placed.where("upto > rest").withColumn("take_tokens", F.least(F.col("n_tokens"), F.col("rest") - F.col("before") - run + F.col("n_tokens"))).where("take_tokens > 0")
    partial = inner.unionByName(edge).withColumn("epoch", F.col("whole")).select(*out)
    return whole.select(*out).unionByName(partial)


def mix_documents(docs: DataFrame, domain: Column, mix: Mix, also: tuple[str, ...] = ()) -> DataFrame:
    """``select`` over the documents' own tokens; texts are read once."""
    tokens = store.save(tokens_of(docs, domain, also), "mix-tokens")
    return select(tokens, store.save(leaf_budgets(tokens, mix), "mix-budgets"), mix, also)
