"""Hard negatives by an inverted multi-index.

The vectors' two halves have a codebook each; a row's cell is the pair of its
halves' nearest codewords. For an anchor, the score of any row in a cell is at
most the sum of two half bounds: the half's product with the codeword, plus the
half's length times the radius around it. A heap over the two sorted lists of
half bounds visits cells by falling sums, and a search ends when what it has
found is certified: no cell that is left can hold a row that belongs to it.

Positives: the first rows of the anchor's label. Each positive's score sets a
window of scores; its negatives are the first rows of other labels in it. Cells
that lie wholly above all of an anchor's windows are passed over.

How the work is spread: cells, in order, are dealt into shards of about ``block``
rows; a cell with more rows than that (many copies of one vector) is split. Tasks
sort a shard's rows before the anchors that ask it, hold the rows, and answer
anchors as they stream by, so memory depends on neither the number of anchors nor
a hot cell. An anchor first asks the shard of its best cell; the score of its
last positive there prunes the other shards and their cells. Each shard returns
at most as many rows as are asked for, and these are merged by anchor. Results
are exact, whatever the codebooks are.

Codebooks are learned by k-means on at most ``FIT`` rows, those with the smallest
hashes; every row is indexed. Codewords of a half: the fourth root of the number
of rows, from 2 to ``WORDS``.

Rows take no part if their label or vector is null, an entry is null or not
finite, or is 2**28 or more in size after scaling, or the vector's length isn't
the most frequent one. Ids may repeat: each row is an anchor, positive or negative
of its own. A null id comes before all others among equal scores. No anchors, or
no rows: an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm import store, vectors

FIT, WORDS, ROUNDS = 16_384, 256, 8
#: Most tasks that answer; beyond it a task has several shards, one after the other.
TASKS = 20_000
LIMIT = 2.0 ** 28


@dataclass(frozen=True)
class Rule:
    """How many positives an anchor has, how many negatives a positive has, and a
    negative's score in hundredths of the positive's."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95

    def window(self, score: int) -> tuple[int, int]:
        """The smallest and largest whole score allowed."""
        return -(-self.low * score // 100), self.high * score // 100


@dataclass
class Index:
    """Rows with their cells (row, id, label, v, i, j, shard), the codebooks of the
    halves, and for each cell of each shard: shard, i, j, radii."""

    rows: DataFrame
    books: tuple[np.ndarray, np.ndarray]
    cells: np.ndarray
    radii: tuple[np.ndarray, np.ndarray]
    shards: int


def _numbers(column: pa.Array, d: int) -> np.ndarray:
    """Vectors kept as bytes of 64-bit numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64).reshape(-1, d)


def usable_rows(df: DataFrame, id_col: str, label_col: str, vector_col: str, times: int) -> tuple[DataFrame, int]:
    """(row, id, label, v) of the rows that take part, written; and the dimension.
    ``row`` numbers them."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).cast("array<double>").alias("x")).where("label is not null and x is not null")
    size = rows.where("size(x) > 0").groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = size["d"] if size else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, x = vectors.whole(batch.column(2), d, times, limit=LIMIT)
            v = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(places)) for c in batch.columns[:2]), v], ["id", "label", "v"])

    out = rows.mapInArrow(run, "id bigint, label bigint, v binary")
    return store.save(out.withColumn("row", F.monotonically_increasing_id()), "vectors"), d


def codebook(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 11) -> np.ndarray:
    """k-means centres of rows; fewer where there are fewer distinct rows."""
    distinct = np.unique(x, axis=0)
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:k]].astype(float)
    for _ in range(rounds):
        near = nearest(x, centres)[0]
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and the distance from it."""
    at = ((centres * centres).sum(axis=1) - 2.0 * (x @ centres.T)).argmin(axis=1)
    away = x - centres[at]
    return at, np.sqrt((away * away).sum(axis=1))


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = (x.shape[1] + 1) // 2
    return x[:, :half], x[:, half:]


def build(rows: DataFrame, d: int, block: int | None = None) -> Index | None:
    """Codebooks and cells of all rows; None if there are none."""
    n = rows.count()
    if not n:
        return None
    sample = rows.select("row", "v").orderBy(F.xxhash64("row"), "row").limit(FIT).toArrow()
    x = _numbers(sample.column("v").combine_chunks(), d).astype(float)
    k = max(2, min(WORDS, round(n ** 0.25)))
    books = tuple(codebook(part, k) for part in _halves(x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [nearest(part, book) for part, book in zip(_halves(_numbers(batch.column(3), d).astype(float)), books, strict=True)]
                extra = [pa.array(found[0][0], pa.int32()), pa.array(found[1][0], pa.int32()), pa.array(found[0][1]), pa.array(found[1][1])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], ["row", "id", "label", "v", "i", "j", "r1", "r2"])

    placed = rows.select("row", "id", "label", "v").mapInArrow(run, "row bigint, id bigint, label bigint, v binary, i int, j int, r1 double, r2 double")
    placed = store.save(placed, "cells")
    block = block or max(1024, min(65_536, n // 24))
    # at most WORDS * WORDS rows
    cells = placed.groupBy("i", "j").agg(F.count("*").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).orderBy("i", "j").toArrow()
    i, j, count = (cells.column(c).to_numpy() for c in ("i", "j", "n"))
    parts = -(-count // block)
    start = np.cumsum(count) - count
    of = np.repeat(np.arange(len(count)), parts)
    part = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    shard = (start[of] + (count[of] * (2 * part + 1)) // (2 * parts[of])) // block
    lists = [x.tolist() for x in np.split(shard, np.cumsum(parts)[:-1])]
    table = placed.sparkSession.createDataFrame(list(zip(i.tolist(), j.tolist(), parts.tolist(), lists, strict=True)), "i int, j int, parts bigint, shards array<bigint>")
    split = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    dealt = placed.join(F.broadcast(table), ["i", "j"]).select("row", "id", "label", "v", "i", "j", F.col("shards")[split].alias("shard"))
    radii = tuple(np.asarray(cells.column(c).to_numpy())[of] for c in ("r1", "r2"))
    return Index(dealt, books, np.stack([shard, i[of], j[of]], axis=1), radii, int(shard.max()) + 1)


def _half_bounds(q: np.ndarray, book: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest and smallest product of each half (rows of q) with vectors within
    ``radius`` of the codewords, with room for rounding."""
    middle, length = q @ book.T, np.sqrt((q * q).sum(axis=1))[:, None]
    reach = length * radius * (1 + 1e-9) + 1e-9 * (length * np.sqrt((book * book).sum(axis=1)) + 1)
    return middle + reach, middle - reach


class Shard:
    """One shard's rows by cell, as held in a task."""

    def __init__(self, row: np.ndarray, ids: np.ndarray, label: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        order = np.lexsort((j, i))
        self.row, self.ids, self.label, self.x = row[order], ids[order], label[order], x[order]
        i, j = i[order], j[order]
        self.real = self.x.astype(float)
        self.largest = float(np.abs(self.x).max(initial=0))
        edge = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
        self.span = {}
        self.books, self.radii = [], []
        used = []
        for k, (of, part, book) in enumerate(zip((i, j), _halves(self.real), books, strict=True)):
            words = np.unique(of)
            away = part - book[of]
            radius = np.zeros(len(words))
            np.maximum.at(radius, np.searchsorted(words, of), np.sqrt((away * away).sum(axis=1)))
            self.books.append(book[words])
            self.radii.append(radius)
            used.append(np.searchsorted(words, of[edge]))
        for a, b, start, stop in zip(used[0].tolist(), used[1].tolist(), edge.tolist(), [*edge[1:].tolist(), len(i)], strict=True):
            self.span[a, b] = (start, stop)

    def bounds(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        return [_half_bounds(part.astype(float), book, radius) for part, book, radius in zip(_halves(q), self.books, self.radii, strict=True)]

    def scores(self, q: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Exact products of some rows with an anchor."""
        if self.largest * float(np.abs(q).max(initial=0)) * len(q) < 2.0 ** 53:
            return (self.real[start:stop] @ q.astype(float)).astype(np.int64)
        return self.x[start:stop] @ q


def visit(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Pairs of places by falling sum of their values: a heap over the two lists,
    sorted; a pair is pushed when both neighbours before it are out."""
    a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    x, y = first.tolist(), second.tolist()
    heap, done = [(-(x[a[0]] + y[b[0]]), 0, 0)], [0] * len(a)  # done: places of each row of the grid that are out
    while heap:
        minus, p, r = heapq.heappop(heap)
        yield -minus, a[p], b[r]
        done[p] = r + 1
        if r + 1 < len(b) and (p == 0 or done[p - 1] > r + 1):
            heapq.heappush(heap, (-(x[a[p]] + y[b[r + 1]]), p, r + 1))
        if p + 1 < len(a) and done[p + 1] == r:
            heapq.heappush(heap, (-(x[a[p + 1]] + y[b[r]]), p + 1, r))


class First:
    """The first ``size`` rows by falling score, then id, among those from ``low``
    to ``high``."""

    def __init__(self, size: int, low: float, high: float = float("inf")):
        self.size, self.low, self.high = size, low, high
        self.found: list[tuple[int, int]] = []  # (-score, id)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        use = (scores >= self.low) & (scores <= self.high)
        if use.any():
            scores, ids = scores[use], ids[use]
            if len(scores) > self.size:
                order = np.lexsort((ids, -scores))[:self.size]
                scores, ids = scores[order], ids[order]
            self.found = sorted(self.found + list(zip((-scores).tolist(), ids.tolist(), strict=True)))[:self.size]
            if len(self.found) == self.size:
                self.low = max(self.low, -self.found[-1][0])


def search(shard: Shard, q: np.ndarray, bounds: list[tuple[np.ndarray, np.ndarray]], rows: np.ndarray, wanted: list[First]) -> None:
    """Fill ``wanted`` with rows of the shard that ``rows`` marks, visiting cells
    until none that is left can add to any of them."""
    (up_1, down_1), (up_2, down_2) = bounds
    top = max(w.high for w in wanted)
    for most, a, b in visit(up_1, up_2):
        if most < min(w.low for w in wanted):
            return
        span = shard.span.get((a, b))
        if span is None or down_1[a] + down_2[b] > top:
            continue
        use = rows[span[0]:span[1]]
        if use.any():
            scores, ids = shard.scores(q, *span)[use], shard.ids[span[0]:span[1]][use]
            for w in wanted:
                w.add(scores, ids)


#: Stands for a null id; smaller than all others.
NO_ID = -(1 << 63)


def _ask(index: Index, requests: DataFrame, d: int, rule: Rule, positives: bool) -> DataFrame:
    """Answers of shards to requests (shard, row, label, v, low, windows): (row,
    window, id, score), the first rows of that shard alone."""
    columns = ["shard", "kind", "row", "id", "label", "v", "i", "j", "low", "windows"]
    rows = index.rows.withColumns({"kind": F.lit(0), "low": F.lit(None).cast("bigint"), "windows": F.lit(None).cast("array<bigint>")})
    asked = requests.withColumns({"kind": F.lit(1), "id": F.lit(None).cast("bigint"), "i": F.lit(0), "j": F.lit(0)})
    both = rows.select(columns).unionByName(asked.select(columns)).repartition(min(index.shards, TASKS), "shard").sortWithinPartitions("shard", "kind")
    books, size = index.books, (rule.positives if positives else rule.negatives)
    shape = pa.schema([("row", pa.int64()), ("window", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def held(parts: list[pa.RecordBatch]) -> Shard:
        table = pa.Table.from_batches(parts).combine_chunks()
        get = lambda c: table.column(c).to_numpy()
        ids = pa.compute.fill_null(table.column("id"), NO_ID).to_numpy()
        return Shard(get("row"), ids, get("label"), _numbers(table.column("v"), d), get("i"), get("j"), books)

    def answers(shard: Shard, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        q = _numbers(batch.column(5), d)
        bounds = shard.bounds(q)
        out: tuple[list, ...] = ([], [], [], [])
        labels: dict[int, np.ndarray] = {}
        for k, (row, label, low, windows) in enumerate(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), batch.column(8).to_pylist(), batch.column(9).to_pylist(), strict=True)):
            if label not in labels:
                labels[label] = shard.label == label
            same = labels[label]
            mine = [tuple(x[k] for x in half) for half in bounds]
            if positives:
                wanted, keys = [First(size, -float("inf") if low is None else low)], [0]
                use = same & (shard.row != row)
            else:
                ends = [rule.window(s) for s in windows]
                wanted, keys, use = [First(size, *e) for e in ends], windows, ~same
            search(shard, q[k], mine, use, wanted)
            for key, w in zip(keys, wanted, strict=True):
                for minus, i in w.found:
                    for column, value in zip(out, (row, key, None if i == NO_ID else i, -minus), strict=True):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, shard = None, [], None
        for batch in batches:
            key = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(key)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True):
                piece = batch.slice(start, stop - start)
                if not piece.num_rows:
                    continue
                if key[start] // 2 != at:
                    at, parts, shard = key[start] // 2, [], None
                if key[start] % 2 == 0:
                    parts.append(piece)
                elif parts or shard:
                    if shard is None:
                        shard, parts = held(parts), []
                    yield from answers(shard, piece)

    return both.mapInArrow(run, "row bigint, window bigint, id bigint, score bigint")


def _route(index: Index, anchors: DataFrame, d: int, rule: Rule, which: str) -> DataFrame:
    """Requests (shard, row, label, v, low, windows) of anchors. ``which``: 'home'
    for the shard of the best cell, 'rest' for the other shards that can hold a
    score of ``low`` or more, 'windows' for those that can hold one in a window."""
    cells, radii, books = index.cells, index.radii, index.books
    firsts = np.flatnonzero(np.concatenate(([True], cells[1:, 0] != cells[:-1, 0])))
    names = cells[firsts, 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                q = _halves(_numbers(part.column(2), d).astype(float))
                up, down = np.zeros((part.num_rows, len(cells))), np.zeros((part.num_rows, len(cells)))
                for k in (0, 1):
                    middle, length = q[k] @ books[k].T, np.sqrt((q[k] * q[k]).sum(axis=1))[:, None]
                    room = 1e-9 * (length * np.sqrt((books[k] * books[k]).sum(axis=1)).max(initial=0) + 1)
                    reach = length * radii[k] * (1 + 1e-9) + room
                    up += middle[:, cells[:, 1 + k]] + reach
                    down += middle[:, cells[:, 1 + k]] - reach
                best, least = np.maximum.reduceat(up, firsts, axis=1), np.minimum.reduceat(down, firsts, axis=1)
                home = best.argmax(axis=1)
                if which == "home":
                    ask = np.zeros_like(best, dtype=bool)
                    ask[np.arange(len(home)), home] = True
                elif which == "rest":
                    low = pa.compute.fill_null(part.column(3).cast(pa.float64()), -np.inf).to_numpy()
                    ask = best >= low[:, None]
                    ask[np.arange(len(home)), home] = False
                else:
                    ends = [[rule.window(s) for s in windows] for windows in part.column(4).to_pylist()]
                    low, high = (np.asarray([f(e[side] for e in w) for w in ends], dtype=float) for side, f in ((0, min), (1, max)))
                    ask = (best >= low[:, None]) & (least <= high[:, None])
                who, shard = np.nonzero(ask)
                yield pa.RecordBatch.from_arrays([pa.array(names[shard], pa.int64()), *(c.take(pa.array(who)) for c in part.columns)], ["shard", "row", "label", "v", "low", "windows"])

    return anchors.select("row", "label", "v", "low", "windows").mapInArrow(run, "shard bigint, row bigint, label bigint, v binary, low bigint, windows array<bigint>")


def _first(found: DataFrame, size: int) -> DataFrame:
    """The first rows of all shards, for each anchor and window, with their rank."""
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", times: int = 256, rule: Rule | None = None, block: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    Scores are products of the vectors' floors of ``times`` an entry. ``is_anchor``
    is an expression over the column ``id``."""
    rule = rule or Rule()
    rows, d = usable_rows(df, id_col, label_col, vector_col, times)
    index = build(rows, d, block)
    shape = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if index is None:
        return df.sparkSession.createDataFrame([], shape)
    anchors = rows.where(is_anchor).select("row", "id", "label", "v", F.lit(None).cast("bigint").alias("low"), F.lit(None).cast("array<bigint>").alias("windows"))
    home = store.save(_ask(index, _route(index, anchors, d, rule, "home"), d, rule, True), "home")
    last = home.groupBy("row").agg(F.when(F.count("*") == rule.positives, F.min("score")).alias("low"))
    pruned = anchors.drop("low").join(last, "row", "left")
    rest = _ask(index, _route(index, pruned, d, rule, "rest"), d, rule, True)
    positives = store.save(_first(home.unionByName(rest), rule.positives).select("row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # a negative score's window is empty
    windows = positives.where("positive_score >= 0").groupBy("row").agg(F.sort_array(F.collect_set("positive_score")).alias("windows"))
    asking = anchors.drop("windows").join(windows, "row")
    found = _first(_ask(index, _route(index, asking, d, rule, "windows"), d, rule, False), rule.negatives)
    negatives = found.select("row", F.col("window").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = positives.join(negatives, ["row", "positive_score"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
