"""MinHash near-dedup with tensored banding.

Two documents are linked if the Jaccard similarity of their shingle sets is at
least a threshold. Candidates come from tables of MinHash keys. Instead of
computing each table's key from minima of its own, two collections of ``side``
sub-keys, each of ``ROWS`` minima, are computed, and every pair of a sub-key of
one with a sub-key of the other is a table's key: ``side**2`` tables from
``2 * side * ROWS`` minima, about the square root of what they would need. A pair
of similarity s shares a table unless all sub-keys of a collection differ:
(1 - s**ROWS)**side for each. ``side`` is the smallest number for which a pair at
the threshold is missed with probability ``MISS`` at most: 9 at 0.85 (1 in
51,000), 12 at 0.8 (1 in 105,000).

Every link is confirmed on the full shingle sets:

1. Documents with equal sets are one node from here on; its text is that of its
   smallest document, by id and then by the text's SHA-256.
2. In each table, members of a key are candidates with its smallest member, not
   with each other. Confirmed links make components.
3. Where members of a key are in different components still, the components'
   smallest members there are compared with the smallest of all, and components
   merged; twice.
4. Of what is left, all members of a key that are in different components are
   compared if the threshold is within reach, by the sizes of their sets, the
   rare shingles they share, their numbers of frequent ones, and their parity maps.
   A map has a bit for each value of a hash, flipped by each shingle of that hash;
   bits that differ between two sets' maps are at most the shingles that only one
   of them has, so the sets' overlap is bounded exactly. No candidate link
   between different components is left untested, and none is within one.

A set of words is confirmed in streams: a center's set, then its candidates'.
Centers with many candidates are dealt over several streams.

Nulls: a null text has no shingles; such documents, and those without words, are
linked with nothing. A null id is a document, smaller than others. A document is
its id with its text: an id with several texts is several documents, each linked
by its own text, and rows that repeat both are one, each returned. Of a component
the smallest document is kept. Texts are read whole. Other columns of the input
don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm import store, words
from lakeforge.llm.components import components

#: Minima of a sub-key; share of pairs at the threshold that may share no table.
ROWS, MISS = 2, 2e-5
#: Candidates of a center in one stream.
STREAM = 400
#: A shingle in more documents of a family counts as frequent.
RARE = 20
_NULL = -(1 << 63)


def missed(similarity: float, side: int) -> float:
    """At most this share of the pairs of a similarity share no table."""
    return 2 * (1 - similarity**ROWS) ** side


def sides(percent: int) -> int:
    """Sub-keys of a collection for a threshold."""
    side = 1
    while missed(percent / 100, side) > MISS:
        side += 1
    return side


@lru_cache(maxsize=4)
def _factors(side: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of the minima's hash functions."""
    rng = np.random.default_rng(20240607)
    a = rng.integers(0, 1 << 63, 2 * side * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, 2 * side * ROWS, dtype=np.uint64)


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: of ``k`` words, A-Z as a-z;
    of all words if there are fewer."""
    counts, (h,) = words.word_hashes(texts, lower=True)
    grams = words.gram_hashes(h, k)
    out, at = [], 0
    for n in counts.tolist():
        if n >= k:
            out.append(np.unique(grams[at:at + n - k + 1]))
        else:
            out.append(words.gram_hashes(h[at:at + n], n) if n else np.zeros(0, dtype=np.uint64))
        at += n
    return out


def sub_keys(sets: list[np.ndarray], side: int) -> np.ndarray:
    """The two collections' sub-keys of each non-empty set: 2 * side columns."""
    every = np.concatenate(sets)
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    first = np.cumsum(sizes) - sizes
    low = np.stack([np.minimum.reduceat(every * a + b, first) for a, b in zip(*_factors(side), strict=True)], axis=1)
    out = low[:, 0::ROWS].copy()
    for r in range(1, ROWS):
        out = words.mix(out) + low[:, r::ROWS]
    return words.mix(out)


def table_keys(subs: np.ndarray) -> np.ndarray:
    """All pairs of a sub-key of each collection: side**2 columns."""
    side = subs.shape[1] // 2
    left, right = words.mix(subs[:, :side].copy()), subs[:, side:]
    number = np.arange(side * side, dtype=np.uint64).reshape(side, side) * np.uint64(0x9E3779B97F4A7C15)
    return words.mix((left[:, :, None] + right[:, None, :] + number[None]).reshape(len(subs), -1))


def parity_map(shingles: np.ndarray) -> np.ndarray:
    """The bits that an odd number of shingles hash to, four bits a shingle at
    least; as numbers of 64 bits, a power of two of them, so that a longer map
    becomes a shorter one by XOR of its halves."""
    width = max(64, 1 << int(4 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def _differ(a: str, b: str) -> Column:
    """Bits that differ between two maps, of which one may be twice as long."""

    def folded(x: str, other: str) -> Column:
        half = (F.size(x) / 2).cast("int")
        fold = F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > F.size(other), fold).otherwise(F.col(x))

    counts = F.zip_with(folded(a, b), folded(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("bigint"))
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda total, c: total + c)


def may_reach(percent: int) -> Column:
    """Whether sets of sizes n, n_y with maps map, map_y can be similar enough: their
    sizes are, and the overlap is (n + n_y - difference) / 2 at most."""
    sizes = F.expr(f"100 * least(n, n_y) >= {percent} * greatest(n, n_y)")
    d, both = _differ("map", "map_y"), F.col("n") + F.col("n_y")
    return F.when(sizes, 100 * (both - d) >= percent * (both + d)).otherwise(False)


def signatures(docs: DataFrame, k: int, side: int) -> DataFrame:
    """(id, sha, n, f1, f2, subs, map) of (id, text, sha): set size, its 128-bit
    fingerprint, sub-keys, parity map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, size in words.pieces(batch.column(1)):
                part = batch.slice(start, size)
                sets = shingle_sets(part.column(1).to_pylist(), k)
                n = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
                f = [np.asarray([np.add.reduce(words.mix(s + np.uint64(c))) for s in sets], dtype=np.uint64) for c in (0x51, 0xA7)]
                some = np.flatnonzero(n)
                subs = [None] * len(sets)
                if len(some):
                    for i, row in zip(some.tolist(), sub_keys([sets[i] for i in some], side), strict=True):
                        subs[i] = row.tobytes()
                maps = pa.array([parity_map(s) if len(s) else None for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n), pa.array(f[0].view(np.int64)), pa.array(f[1].view(np.int64)), pa.array(subs, pa.binary()), maps], ["id", "sha", "n", "f1", "f2", "subs", "map"])

    return docs.select("id", "text", "sha").mapInArrow(run, "id bigint, sha string, n bigint, f1 bigint, f2 bigint, subs binary, map array<bigint>")


def keyed(nodes: DataFrame) -> DataFrame:
    """(key, id) of every table, for nodes (id, subs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                subs = np.stack([np.frombuffer(x, dtype=np.uint64) for x in part.column(1).to_pylist()])
                found = table_keys(subs)
                ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), found.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(found.reshape(-1).view(np.int64)), pa.array(ids)], ["key", "id"])

    return nodes.select("id", "subs").mapInArrow(run, "key bigint, id bigint")


def confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the pairs (x, y) whose sets reach the threshold, as edges (a, b).
    ``texts``: (id, text), a row for each id."""
    load = pairs.groupBy("y").agg(F.count("*").alias("load"))
    dealt = store.save(pairs.join(load, "y").select("x", "y", F.pmod(F.xxhash64("x"), F.ceil(F.col("load") / STREAM)).cast("int").alias("salt")), "pairs")
    centers = dealt.select("y", "salt").distinct().join(texts, F.col("y") == F.col("id")).select("y", "salt", F.lit(None).cast("bigint").alias("x"), "text")
    others = dealt.join(texts, F.col("x") == F.col("id")).select("y", "salt", "x", "text")
    rows = centers.unionByName(others).repartition("y", "salt").sortWithinPartitions("y", "salt", F.col("x").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            a, b = [], []
            for start, size in words.pieces(batch.column(3)):
                ys, _, xs, texts_ = (c.to_pylist() for c in batch.slice(start, size).columns)
                for y, x, own in zip(ys, xs, shingle_sets(texts_, k), strict=True):
                    if x is None:
                        center = own
                        continue
                    small, large = sorted((own, center), key=len)
                    if not len(small):
                        continue
                    both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                    if 100 * both >= percent * (len(small) + len(large) - both):
                        a.append(x)
                        b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


def _could_link(open_: DataFrame, nodes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (x, y) in different components that could reach the threshold.

    Shingles are counted within families: components that keys of mixed members
    connect, so that all members of a key are of one family. Those in at most
    ``RARE`` documents are joined, which gives each pair that shares some and how
    many; a pair shares no more shingles in all than that, and the lesser number of
    frequent shingles of the two. Pairs that share no rare shingle are taken from a
    family, where the frequent ones alone can suffice; its largest component isn't
    paired with itself."""
    families = components(open_.select(F.col("component").alias("a"), F.col("low").alias("b"))).select("node", F.col("component").alias("family"))
    members = store.save(open_.select(F.col("x").alias("of"), "component").distinct().join(families, F.col("component") == F.col("node")).drop("node"), "members")
    ids = members.select("of", "family")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, size in words.pieces(batch.column(1)):
                part = batch.slice(start, size)
                sets = shingle_sets(part.column(1).to_pylist(), k)
                own, family = (np.repeat(part.column(i).to_numpy(zero_copy_only=False), [len(s) for s in sets]) for i in (0, 2))
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.concatenate(sets).view(np.int64)), pa.array(family)], ["id", "h", "family"])

    rows = texts.join(ids, F.col("id") == F.col("of")).select("id", "text", "family").mapInArrow(run, "id bigint, h bigint, family bigint")
    counts = store.save(rows.groupBy("h", "family").agg(F.count("*").alias("times")).where("times > 1"), "shared")
    shared = store.save(rows.join(counts, ["h", "family"]), "shared")
    of_each = shared.groupBy("id").agg(F.count("*").alias("shared"), F.count_if(F.col("times") > RARE).alias("frequent"))
    facts = members.join(nodes.select("id", "n", "map"), F.col("of") == F.col("id")).drop("of").join(of_each, "id")
    # a document that shares too few of its own shingles links with nothing
    facts = store.save(facts.where(f"100 * shared >= {percent} * n").select(F.col("id").alias("x"), "component", "family", "n", "shared", "frequent", "map"), "facts")
    second = facts.select(F.col("x").alias("y"), F.col("component").alias("component_y"), "family", F.col("n").alias("n_y"), F.col("shared").alias("shared_y"), F.col("frequent").alias("frequent_y"), F.col("map").alias("map_y"))

    def reach(both: str) -> str:
        return f"100 * ({both}) >= {percent} * (n + n_y - ({both}))"

    rare = shared.where(f"times <= {RARE}").select("h", "family", "id")
    one = rare.join(facts.drop("family", "map"), F.col("id") == F.col("x")).drop("id")
    two = rare.join(second.drop("family", "map_y"), F.col("id") == F.col("y")).drop("id")
    sized = ["x", "y", "n", "n_y", "frequent", "frequent_y"]
    by_rare = one.join(two, ["h", "family"]).where(f"component > component_y and {reach('least(shared, shared_y)')}").groupBy(*sized).agg(F.count("*").alias("common"))
    by_rare = by_rare.where(reach("least(frequent, frequent_y) + common"))
    by_rare = by_rare.join(facts.select("x", "map"), "x").join(second.select("y", "map_y"), "y").where(may_reach(percent)).select("x", "y")
    able = facts.where(f"100 * frequent >= {percent} * n")
    main = able.groupBy("family", "component").agg(F.count("*").alias("size")).groupBy("family").agg(F.max_by("component", F.struct("size", "component")).alias("main"))
    rest = able.join(main, "family").where("component <> main")
    by_family = rest.join(second.where(f"100 * frequent_y >= {percent} * n_y"), "family")
    by_family = by_family.where(f"(component_y = main or component > component_y) and {reach('least(frequent, frequent_y)')}").where(may_reach(percent)).select("x", "y")
    return by_rare.unionByName(by_family)


def near_groups(docs: DataFrame, k: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", distinct_texts: bool = True) -> DataFrame:
    """(id, n_shingles, component_id, kept, text_sha256) of every row. The last
    tells the texts of an id apart; a null text has an empty one's. ``kept``: the
    component's smallest document; without ``distinct_texts`` every row that has its
    id, as where an id is taken for the document."""
    docs = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NULL)).alias("id"), F.col(text_col).alias("text"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("sha"))
    signed = store.save(signatures(docs, k, sides(percent)), "signatures")
    equal = ["f1", "f2", "n"]
    # a node is a set, by a number of its own; (own, sha) is its smallest document
    sets = signed.where("n > 0").groupBy(*equal).agg(F.min(F.struct("id", "sha")).alias("least"), F.first("subs").alias("subs"), F.first("map").alias("map"))
    nodes = store.save(sets.select(F.monotonically_increasing_id().alias("id"), *equal, F.col("least.id").alias("own"), "least.sha", "subs", "map"), "nodes")
    keys = keyed(nodes)
    groups = store.save(keys.groupBy("key").agg(F.min("id").alias("y"), F.count("*").alias("members")).where("members > 1").select("key", "y"), "keys")
    members = store.save(keys.join(groups, "key").select("key", F.col("id").alias("x"), "y"), "members")
    pairs = store.save(members.where("x <> y").groupBy("x", "y").agg(F.count("*").alias("tables")).select("x", "y"), "candidates")
    ids = pairs.select("x").union(pairs.select("y")).distinct()
    wanted = nodes.join(ids, F.col("id") == F.col("x")).select(F.col("id").alias("node"), F.col("own").alias("id"), "sha")
    # their number grows with the input: a shuffled join, never a broadcast; rows of one document have one text
    texts = store.save(docs.hint("merge").join(wanted, ["id", "sha"]).select(F.col("node").alias("id"), "text").dropDuplicates(["id"]), "texts")
    edges = store.save(confirm(pairs, texts, k, percent), "links")
    tested, labels, grew = pairs, components(edges), True
    for heads_only in (True, True, False):
        if heads_only and not grew:
            continue  # the same heads as before
        placed = members.join(labels, F.col("x") == F.col("node"), "left").select("key", "x", F.coalesce("component", "x").alias("component"))
        mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key", "low")
        open_ = store.save(placed.join(mixed, "key"), "open")
        if open_.isEmpty():
            break
        if heads_only:
            heads = open_.groupBy("key", "component", "low").agg(F.min("x").alias("x"))
            more = heads.where("component > low").join(heads.where("component = low").select("key", F.col("x").alias("y")), "key")
        else:
            more = _could_link(open_, nodes, texts, k, percent)
        more = more.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
        more = store.save(more.join(tested, ["x", "y"], "left_anti"), "candidates")
        grew = False
        if not more.isEmpty():
            tested = tested.unionByName(more)
            found = store.save(confirm(more, texts, k, percent), "links")
            if not found.isEmpty():
                grew = True
                edges = edges.unionByName(found)
                labels = components(edges)
    placed = nodes.select("id", *equal, "own", "sha").join(labels, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id"))
    placed = store.save(placed.select(*equal, "component", "own", "sha"), "placed")
    heads = store.save(placed.groupBy("component").agg(F.min(F.struct("own", "sha")).alias("head")).select("component", "head.*"), "heads")
    copies = placed.select(*equal, "component").join(heads.select("component", F.col("own").alias("head"), F.col("sha").alias("head_sha")), "component").drop("component")
    out = signed.join(copies, equal, "left").select("id", "n", "sha", F.coalesce("head", "id").alias("component"), F.coalesce("head_sha", "sha").alias("component_sha"))
    real = lambda c: F.when(F.col(c) != _NULL, F.col(c))
    kept = F.col("id") == F.col("component")
    if distinct_texts:
        kept = kept & (F.col("sha") == F.col("component_sha"))
    return out.select(real("id").alias(id_col), F.col("n").alias("n_shingles"), real("component").alias("component_id"), kept.alias("kept"), F.col("sha").alias("text_sha256"))
