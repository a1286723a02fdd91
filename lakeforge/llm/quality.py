"""A quality classifier: Bradley-Terry ranking of documents.

Each document has a score s(x) = w . x over features of its whole text. Of a
pair, the first is preferred with probability sigmoid(s(a) - s(b)); w is learned
from preference pairs (a document labelled 1 over one labelled 0) by logistic
loss on their feature differences, with an L2 penalty, by Newton steps. A
document is predicted good if its score lies above the quantile of the labelled
documents' scores at the share of documents labelled 0. The reported score is a
sigmoid of s, moved so that this threshold is at ``cut``.

Only the weights are learned from a sample of the labelled rows, at most
``PER_CLASS`` of each label, the smallest by a hash of the document id, and
``PAIRS`` pairs; its bounds don't grow with the input. The quantile is that of all
labelled rows that are not held out: their scores are counted in ``BINS`` ranges,
the range that holds it is divided again, and its last ``BINS`` rows are sorted.
Every document is scored.

Nulls: a null text counts as empty; an empty text has all features 0. A null
label, or one without a document, is not learned from. Labels of a document
that contradict each other are not learned from. Rows that repeat a document
are scored each. If a label is missing among the training rows, all documents
get the score 0.5 + 0.5 * cut, that is: good.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm import store, words, worker

PER_CLASS, PAIRS, BINS = 3000, 30_000, 4096
#: Bytes of texts whose words are held at a time.
PIECE = 1 << 18
FEATURES = [
    "log_words", "word_length", "word_length_sd", "upper_share", "caps_words", "digit_share", "symbol_share", "bang_share",
    "bar_words", "punct_share", "distinct_words", "top_word", "repeated_neighbours", "distinct_pairs", "words_per_line",
    "repeated_lines", "line_end_stops", "high_bytes", "capital_starts", "stretch_caps", "stretch_symbols", "stretch_repeats", "stretch_bars",
]
#: Words of a stretch; the ``stretch_`` features are the worst stretch's.
STRETCH = 24
#: Byte classes whose counts are features, as bits of one table.
CLASSES = {
    "upper": bytes(range(0x41, 0x5B)), "lower": bytes(range(0x61, 0x7B)), "digit": bytes(range(0x30, 0x3A)),
    "symbol": b"#*$%&<>@^~+=_{}[]\\/", "bang": b"!?", "bar": b"|", "punct": b".,;:'\"()-", "high": bytes(range(0x80, 0x100)),
}
_TABLES = {}
for _name, _chars in CLASSES.items():
    _TABLES[_name] = np.zeros(256, dtype=np.uint8)
    _TABLES[_name][list(_chars)] = 1
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True


def feature_rows(texts: list[str | None]) -> np.ndarray:
    """A row of features for each whole text, each value about 0 to 1
    (log_words and word lengths: to 2); zeros where there is no word."""
    n = len(texts)
    total = {name: np.zeros(n) for name in CLASSES}
    size, lines, stops, distinct_lines = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    owner_, hash_, length_, flags_, line_ = [], [], [], [], []
    for raw, bounds, owners in words.blocks(texts):
        b, starts, ends = words.spans(raw)
        of = owners[np.searchsorted(bounds, starts, side="right")]
        edges = np.concatenate(([0], bounds - 1))
        np.add.at(size, owners, np.diff(np.concatenate(([0], bounds))) - 1)
        per_word = {}
        for name, table in _TABLES.items():
            running = np.zeros(len(b) + 1, dtype=np.int32)
            np.cumsum(table[b], out=running[1:])
            np.add.at(total[name], owners, np.diff(running[np.minimum(edges, len(b))]))
            if name in ("upper", "lower", "symbol", "bar"):
                per_word[name] = running[ends] - running[starts]
        caps = (per_word["upper"] >= 2) & (per_word["lower"] == 0)
        capital = _TABLES["upper"][b[starts]].astype(bool)
        flags_.append(caps | (per_word["symbol"] >= 1) * 2 | (per_word["bar"] >= 1) * 4 | capital * 8)
        breaks = np.flatnonzero(b == 10)
        first = np.searchsorted(starts, np.concatenate(([0], breaks + 1)))  # each line's first word
        last = np.concatenate((first[1:], [len(starts)]))
        full = last > first
        first, last = first[full], last[full] - 1
        line_owner = of[first]
        line_.append(np.stack((line_owner.astype(np.uint64), words.hash_spans(b, starts[first], ends[last])[0])))
        np.add.at(lines, line_owner, 1)
        np.add.at(stops, line_owner, _STOP[b[ends[last] - 1]])
        owner_.append(of)
        hash_.append(words.hash_spans(b, starts, ends)[0])
        length_.append(ends - starts)
    out = np.zeros((n, len(FEATURES)))
    if not owner_:
        return out
    owner, h, length, flags = map(np.concatenate, (owner_, hash_, length_, flags_))
    count = np.bincount(owner, minlength=n)
    some = np.maximum(count, 1)
    per = lambda values: np.bincount(owner, weights=values, minlength=n) / some
    # not of small numbers, which the hashes of one-letter words are
    salt = words.mix(np.arange(1, n + 1).astype(np.uint64) * np.uint64(words.SEEDS[1][0]))
    distinct = lambda keys, of: np.bincount(of[np.unique(keys, return_index=True)[1]], minlength=n)
    order = np.argsort(h ^ salt[owner])
    key = (h ^ salt[owner])[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    runs = np.diff(np.concatenate((np.flatnonzero(new), [len(key)])))
    run_owner = owner[order][new]
    top = np.zeros(n)
    np.maximum.at(top, run_owner, runs)
    same = owner[1:] == owner[:-1]
    again = np.concatenate(([False], (h[1:] == h[:-1]) & same))
    two = words.gram_hashes(h, 2)[same] ^ salt[owner[1:][same]]
    pairs = np.maximum(count - 1, 1)
    line = np.concatenate(line_, axis=1)
    distinct_lines = distinct(line[1] ^ salt[line[0].astype(np.int64)], line[0].astype(np.int64))
    begin = np.cumsum(count) - count
    stretch = (np.arange(len(owner)) - begin[owner]) // STRETCH
    grid = np.flatnonzero(np.concatenate(([True], (stretch[1:] != stretch[:-1]) | ~same)))
    width = np.maximum(np.diff(np.concatenate((grid, [len(owner)]))), STRETCH // 2)

    def worst(values: np.ndarray) -> np.ndarray:
        best = np.zeros(n)
        np.maximum.at(best, owner[grid], np.add.reduceat(values.astype(np.int64), grid) / width)
        return best

    letters, chars = np.maximum(total["upper"] + total["lower"] + total["high"], 1), np.maximum(size, 1)
    caps, signs, bars, capital = ((flags & bit) > 0 for bit in (1, 2, 4, 8))
    mean = per(length)
    rows = {
        "log_words": np.log1p(count) / 6, "word_length": mean / 10, "word_length_sd": np.sqrt(np.maximum(per(length * length) - mean * mean, 0)) / 6,
        "upper_share": total["upper"] / letters, "caps_words": per(caps), "digit_share": total["digit"] / chars,
        "symbol_share": np.minimum(1, 4 * total["symbol"] / chars), "bang_share": np.minimum(1, 4 * total["bang"] / chars),
        "bar_words": per(bars), "punct_share": np.minimum(1, 4 * total["punct"] / chars), "distinct_words": np.bincount(run_owner, minlength=n) / some,
        "top_word": top / some, "repeated_neighbours": per(again), "distinct_pairs": distinct(two, owner[1:][same]) / pairs,
        "words_per_line": np.minimum(1, some / np.maximum(lines, 1) / 40), "repeated_lines": 1 - distinct_lines / np.maximum(lines, 1),
        "line_end_stops": stops / np.maximum(lines, 1), "high_bytes": total["high"] / chars, "capital_starts": per(capital),
        "stretch_caps": worst(caps), "stretch_symbols": worst(signs), "stretch_repeats": worst(again), "stretch_bars": worst(bars),
    }
    for i, name in enumerate(FEATURES):
        out[:, i] = np.minimum(2, rows[name]) * (count > 0)
    return out


@dataclass
class Model:
    """Weights of the features, and the raw score that becomes ``cut``."""

    weights: np.ndarray
    threshold: float
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(raw_scores(x, self.weights) - self.threshold, -30, 30) + np.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-z))


def raw_scores(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """w . x of each row, the same whatever rows are beside it."""
    return (x * weights).sum(axis=1)


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, penalty: float = 3.0, seed: int = 7) -> np.ndarray | None:
    """Weights from feature rows and labels; None if a label is missing."""
    good, bad = x[y == 1], x[y == 0]
    if not len(good) or not len(bad):
        return None
    rng = np.random.default_rng(seed)
    d = good[rng.integers(0, len(good), pairs)] - bad[rng.integers(0, len(bad), pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (1 - p) - penalty * w
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + penalty * np.eye(len(w)), gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def threshold(scores: DataFrame, low: int, high: int, bins: int = BINS) -> float:
    """The quantile of all rows of ``scores`` (y, s) at low / (low + high), each
    label's rows weighing ``low`` (0) or ``high`` (1) together; halfway to the
    next row's score. At most ``bins`` rows come to the driver at once; weights
    are whole numbers."""
    rows = {r["y"]: r["n"] for r in scores.groupBy("y").agg(F.count("*").alias("n")).collect()}
    of_0, of_1 = low * rows[1], high * rows[0]
    want = low * rows[0] * rows[1]
    counts = [F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"), F.min("s").alias("first"), F.max("s").alias("last")]
    inside, before, prior, after = scores, 0, None, None
    while True:
        ends = inside.agg(*counts).first()
        width = (ends["last"] - ends["first"]) / bins
        # few rows, or no more values between the ends than ranges
        done = ends["n0"] + ends["n1"] <= bins or ends["first"] + width == ends["first"] or ends["last"] - width == ends["last"]
        at = F.col("s") if done else F.least(F.floor((F.col("s") - ends["first"]) / width), F.lit(bins - 1))
        parts = inside.groupBy(at.alias("at")).agg(*counts).orderBy("at").collect()
        k, part = 0, parts[0]
        while k + 1 < len(parts) and before + of_0 * part["n0"] + of_1 * part["n1"] < want:
            before += of_0 * part["n0"] + of_1 * part["n1"]
            k, part = k + 1, parts[k + 1]
        prior = parts[k - 1]["last"] if k else prior
        after = parts[k + 1]["first"] if k + 1 < len(parts) else after
        if done:
            break
        inside = inside.where(at == part["at"])
    value, left = part["first"], want - before
    in_0 = of_0 * part["n0"]
    number = -(-left // of_0) if left <= in_0 else part["n0"] + -(-(left - in_0) // of_1)  # among the rows of this score
    if number < part["n0"] + part["n1"] or (after is None and part["n0"] + part["n1"] > 1):
        return float(value)
    other = after if after is not None else prior
    return float(value if other is None else (value + other) / 2)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _array(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def _rows(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, len(FEATURES))


def feature_parts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """First rows and features of stretches of texts, in tasks: a reused worker
    drops what other steps kept in it, and keeps nothing of this one."""
    worker.drop_kept()
    for start, size in words.pieces(texts, most_bytes=PIECE):
        yield start, feature_rows(texts.slice(start, size).to_pylist())
    worker.trim()


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of every row, written: the only pass over texts. What follows
    reads and joins these rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, x in feature_parts(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(x)), _array(x)], ["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return store.save(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<double>"), "features")


def train(found: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, cut: float = 0.7) -> Model:
    """Weights from a bounded sample of the labelled documents not held out, the
    threshold from all of them. ``found``: :func:`features` of the documents. Of
    rows that repeat an id of the sample, the least features are learned from."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").where(~held_out(F.col("doc_id")))
    known = store.save(known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").drop("z"), "known")
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.md5(F.col("doc_id").cast("string"))
    sample = [r for y in (0, 1) for r in known.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class).collect()]
    # what the score is where nothing can be learned
    neutral = Model(np.zeros(len(FEATURES)), np.log(cut / (1 - cut)) - np.log((1 + cut) / (1 - cut)), cut)
    if not sample:
        return neutral
    chosen = F.broadcast(found.sparkSession.createDataFrame(sample, "doc_id bigint, y int"))  # at most 2 * per_class rows
    rows = sorted(found.join(chosen, "doc_id").groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x")).collect(), key=lambda r: r["doc_id"])
    weights = fit(np.asarray([r["x"] for r in rows]).reshape(-1, len(FEATURES)), np.asarray([r["y"] for r in rows]))
    if weights is None:
        return neutral

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw_scores(_rows(batch.column(1)), weights))], ["y", "s"])

    scores = store.save(found.join(known, "doc_id").select("y", "x").mapInArrow(run, "y int, s double"), "scores")
    return Model(weights, threshold(scores, counts[0], counts[1]), cut)


def score(found: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of :func:`features`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_rows(batch.column(1))))], ["doc_id", "score"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {kind}, score double")


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """The documents, all columns, with their score: each row's from its own text,
    which alone goes to Python."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        parts = [model.score(x) for _, x in feature_parts(texts)]
        return pa.array(np.concatenate([np.zeros(0), *parts]))

    return docs.withColumn(name, scored(F.col("text").cast("string")))


def crc_held_out(doc_id: int) -> bool:
    """``held_out`` in Python."""
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
