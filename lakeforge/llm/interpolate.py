"""Language-model scores of whole texts by deleted interpolation.

The probability of a token is a mixture of the maximum-likelihood estimates of
the n-grams that end at it, down to the single token and the uniform
distribution over the vocabulary and one unknown token. The mixture's weights
belong to a bucket: the longest context that was seen, and the power of two of
its frequency. They are learned by expectation-maximisation on deleted
documents, whose n-grams are estimated from the other training documents;
scores use the counts of both, with those weights.

How the work is spread: tasks turn documents into chunks of about ``CHUNK``
tokens, each a row with its distinct words' hashes and its tokens as numbers of
those. A chunk sends its distinct n-grams, sorted by hash, to ``buckets`` of
hashes; a bucket adds up the counts of all chunks and sends each chunk the
counts of what it sent, in the same order. So each n-gram crosses the network
once a chunk however frequent it is, and no key is hot. A document is wholly in
one chunk, so a task's memory grows with the longest text, not with the corpus.

Tokens: words (runs of bytes other than space and 0x09-0x0D, A-Z as a-z) and an
end. Words are told apart by 64-bit hashes, n-grams by 64-bit hashes of those. A
null text is an empty one: its only token is the end. A null id is a training
document. Rows that repeat are documents each, counted and returned each. No
rows: an empty result. No training documents: every probability is that of the
uniform distribution over the unknown token alone, 1. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm import store, words

CHUNK = 1 << 20
#: N-grams that a bucket of hashes holds, about.
BUCKET = 1_000_000
#: Steps of an estimate's logarithm (base 2) in the held-out counts.
STEP = 8
HELD, KEPT, DELETED = 2, 0, 1
#: Hashes of the beginning and the end of a text.
BEGIN, END = np.uint64(0x1B873593CC9E2D51), np.uint64(0x2545F4914F6CDD1D)


def pack(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on as planes of bytes, compressed."""
    x = np.ascontiguousarray(numbers, dtype=np.uint64)
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T)
    head = np.asarray([len(x), width], dtype=np.int64).tobytes()
    return head + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(raw: bytes) -> np.ndarray:
    size, width = np.frombuffer(raw[:16], dtype=np.int64).tolist()
    planes = np.frombuffer(pa.decompress(raw[16:], size * width, codec="zstd", asbytes=True), dtype=np.uint8)
    out = np.zeros((size, 8), dtype=np.uint8)
    out[:, :width] = planes.reshape(width, size).T
    return out.view(np.uint64).ravel()


@dataclass
class Chunk:
    """Documents' ids, roles and token counts (without ends); the hashes of all
    their words in order."""

    hashes: list[np.ndarray]
    counts: list[int]
    rows: list[int]
    size: int = 0


def _save(df: DataFrame, tag: str) -> DataFrame:
    """Like ``store.save``, for rows of megabytes: a reader holds a row group, so
    these are kept to a few rows."""
    path = store.new_dir(df.sparkSession, tag) + "/t"
    df.write.option("parquet.block.size", 1 << 23).option("parquet.page.size.row.check.min", 1).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _role(doc_id: Column, held_out: Column, modulus: int, deleted: int) -> Column:
    part = F.crc32(doc_id.cast("string").cast("binary")) % modulus
    return F.when(held_out, HELD).when(F.coalesce(part == deleted, F.lit(False)), DELETED).otherwise(KEPT).cast("int")


def chunks(docs: DataFrame, role: Column, chunk: int = CHUNK) -> DataFrame:
    """The documents as chunks, each of one role: (chunk, role, n_tokens, ids,
    counts, vocabulary, tokens). Ids are those of ``doc_id``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow_ids = pa.list_(docs.select("doc_id").limit(0).toArrow().schema.field("doc_id").type)
    shape = pa.schema([("role", pa.int32()), ("n_tokens", pa.int64()), ("ids", arrow_ids), ("counts", pa.binary()), ("vocabulary", pa.binary()), ("tokens", pa.binary())])

    def made(role: int, ids: list, counts: list[np.ndarray], hashes: list[np.ndarray]) -> pa.RecordBatch:
        count, h = np.concatenate(counts), np.concatenate(hashes)
        vocabulary, token, times = np.unique(h, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")  # frequent words get small numbers
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order))
        row = {"role": [role], "n_tokens": [len(h) + len(count)], "ids": pa.array([pa.concat_arrays(ids).to_pylist()], arrow_ids),
               "counts": [pack(count)], "vocabulary": [vocabulary[order].tobytes()], "tokens": [pack(number[token])]}
        return pa.RecordBatch.from_pydict(row, shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, tuple[list, list, list]] = {r: ([], [], []) for r in (KEPT, DELETED, HELD)}
        size = dict.fromkeys(open_, 0)
        for batch in batches:
            texts = batch.column(2)
            lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0)).astype(np.int64) + 64
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // (1 << 22))) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                roles = batch.column(0).slice(start, stop - start).to_numpy()
                ids = batch.column(1).slice(start, stop - start)
                count, (h,) = words.word_hashes(texts.slice(start, stop - start).to_pylist(), lower=True)
                of = np.repeat(roles, count)
                for r in np.unique(roles).tolist():
                    mine = open_[r]
                    mine[0].append(ids.filter(pa.array(roles == r)))
                    mine[1].append(count[roles == r])
                    mine[2].append(h[of == r])
                    size[r] += len(mine[2][-1]) + len(mine[1][-1])
                    if size[r] >= chunk:
                        yield made(r, *mine)
                        open_[r], size[r] = ([], [], []), 0
        for r, mine in open_.items():
            if size[r]:
                yield made(r, *mine)

    rows = docs.select(role.alias("role"), "doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"role int, n_tokens bigint, ids array<{kind}>, counts binary, vocabulary binary, tokens binary")
    return _save(rows.withColumn("chunk", F.monotonically_increasing_id()), "chunks")


@dataclass
class Sequence:
    """A chunk's tokens with ``order - 1`` beginnings before each text and an end
    after it: hash and document of each, and where texts' own tokens are."""

    hashes: np.ndarray
    own: np.ndarray
    document: np.ndarray
    documents: int


def _sequence(counts: bytes, vocabulary: bytes, tokens: bytes, order: int) -> Sequence:
    count = unpack(counts).astype(np.int64)
    h = np.frombuffer(vocabulary, dtype=np.uint64)[unpack(tokens).astype(np.int64)]
    lead = max(order - 1, 1)
    long = count + lead + 1
    ends = np.cumsum(long)
    out = np.full(int(ends[-1]) if len(ends) else 0, BEGIN)
    own = np.ones(len(out), dtype=bool)
    for k in range(lead):
        own[ends - long + k] = False
    out[ends - 1] = END
    word = own.copy()
    word[ends - 1] = False
    out[word] = h
    return Sequence(out, own, np.repeat(np.arange(len(count)), long), len(count))


def _grams(s: Sequence, m: int) -> np.ndarray:
    """Hash of the m-gram that ends at each own token."""
    at = np.flatnonzero(s.own)
    out = s.hashes[at - (m - 1)] if m > 1 else s.hashes[at]
    for k in range(m - 2, -1, -1):
        out = out * np.uint64(words.SEEDS[0][1]) + s.hashes[at - k]
    return words.mix(out + np.uint64(m))


def _buckets_of(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ends of the buckets in sorted hashes."""
    width = (1 << 64) // buckets + 1
    edges = np.asarray([min(width * (k + 1) - 1, (1 << 64) - 1) for k in range(buckets)], dtype=np.uint64)
    return np.searchsorted(sorted_hashes, edges, side="right")


def _requests(chunked: DataFrame, order: int, buckets: int) -> DataFrame:
    """(bucket, m, chunk, hashes, kept, deleted): the chunk's distinct m-grams of the
    bucket as differences of sorted hashes, and their training counts there."""
    shape = pa.schema([("bucket", pa.int32()), ("m", pa.int32()), ("chunk", pa.int64()), ("role", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, role, *parts = (c[row].as_py() for c in batch.columns)
                s = _sequence(*parts, order)
                for m in range(1, order + 1):
                    h, n = np.unique(_grams(s, m), return_counts=True)
                    ends = _buckets_of(h, buckets)
                    for b, (start, stop) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
                        if stop > start:
                            part = h[start:stop]
                            steps = np.concatenate((part[:1], part[1:] - part[:-1]))
                            values = (b, m, chunk, role, pack(steps), pack(n[start:stop]) if role != HELD else None)
                            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, shape, strict=True)], schema=shape)

    return chunked.select("chunk", "role", "counts", "vocabulary", "tokens").mapInArrow(run, "bucket int, m int, chunk bigint, role int, hashes binary, counts binary")


def _answer(table: pa.Table) -> pa.Table:
    """For one bucket and order: each chunk's counts, from all training documents
    and from those not deleted, and one row (chunk -1) with the distinct n-grams
    and tokens of both."""
    chunk, roles = table.column("chunk").to_pylist(), table.column("role").to_pylist()
    hashes = [np.cumsum(unpack(x)) for x in table.column("hashes").to_pylist()]
    every = np.concatenate(hashes)
    types, at = np.unique(every, return_inverse=True)
    total, kept = np.zeros(len(types), dtype=np.int64), np.zeros(len(types), dtype=np.int64)
    start, places = 0, []
    for h, role, counts in zip(hashes, roles, table.column("counts").to_pylist(), strict=True):
        place = at[start:start + len(h)]
        start += len(h)
        places.append(place)
        if role != HELD:
            n = unpack(counts).astype(np.int64)
            total[place] += n  # hashes of a chunk are distinct
            if role == KEPT:
                kept[place] += n
    out = {"bucket": table.column("bucket").to_pylist() + [table.column("bucket")[0].as_py()], "m": table.column("m").to_pylist() + [table.column("m")[0].as_py()],
           "chunk": [*chunk, -1], "total": [pack(total[p]) for p in places] + [None], "kept": [pack(kept[p]) if role == DELETED else None for p, role in zip(places, roles, strict=True)] + [None],
           "sizes": [None] * len(chunk) + [[int((total > 0).sum()), int(total.sum()), int((kept > 0).sum()), int(kept.sum())]]}
    return pa.table(out, pa.schema([("bucket", pa.int32()), ("m", pa.int32()), ("chunk", pa.int64()), ("total", pa.binary()), ("kept", pa.binary()), ("sizes", pa.list_(pa.int64()))]))


def _counts(s: Sequence, order: int, answers: pa.Table, which: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For m from 1: the counts of the m-gram that ends at each own token, and of
    that of the token before (0 where a text begins)."""
    of_m = answers.column("m").to_numpy()
    bucket = answers.column("bucket").to_numpy()
    blobs = answers.column(which).to_pylist()
    own = np.flatnonzero(s.own)
    before = np.concatenate(([-1], np.arange(len(own) - 1)))
    before[~s.own[own - 1]] = -1
    ends, prior = [], []
    for m in range(1, order + 1):
        rows = np.flatnonzero(of_m == m)
        rows = rows[np.argsort(bucket[rows])]
        counts = np.concatenate([unpack(blobs[r]) for r in rows]).astype(np.int64)
        _, at = np.unique(_grams(s, m), return_inverse=True)
        n = counts[at]
        ends.append(n)
        prior.append(np.where(before >= 0, n[before], 0))
    return ends, prior


def _estimates(s: Sequence, order: int, ends: list[np.ndarray], prior: list[np.ndarray], tokens: int, texts: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The bucket of each own token's context, and the estimates from order 1 up
    (0 where the context wasn't seen)."""
    estimates = [ends[0] / max(tokens, 1)]
    bucket = np.zeros(len(ends[0]), dtype=np.int64)
    own = np.flatnonzero(s.own)
    # tokens since the text's beginning; a context of beginnings alone was seen once a text
    first = np.concatenate(([True], s.document[own][1:] != s.document[own][:-1]))
    for m in range(2, order + 1):
        context = np.where(first, texts, prior[m - 2])
        estimates.append(np.where(context > 0, ends[m - 1] / np.maximum(context, 1), 0.0))
        bucket = np.where(context > 0, 64 * (m - 1) + np.log2(np.maximum(context, 1)).astype(np.int64), bucket)
    return bucket, estimates


def _held_out_counts(joined: DataFrame, order: int, tokens: int, texts: int) -> DataFrame:
    """(bucket, estimates, n): tokens of deleted documents, counted by bucket and
    by their estimates' logarithms in steps of 1/``STEP`` (-1: estimate 0)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for row in range(left.num_rows):
            s = _sequence(*(left.column(c)[row].as_py() for c in ("counts", "vocabulary", "tokens")), order)
            bucket, estimates = _estimates(s, order, *_counts(s, order, right, "kept"), tokens, texts)
            logs = [np.where(e > 0, np.round(-STEP * np.log2(np.where(e > 0, e, 1))), -1).astype(np.int64) for e in estimates]
            parts.append(np.stack([bucket, *logs], axis=1))
        keys, n = np.unique(np.concatenate(parts), axis=0, return_counts=True) if parts else (np.zeros((0, order + 1), dtype=np.int64), np.zeros(0, dtype=np.int64))
        return pa.table({"bucket": pa.array(keys[:, 0]), "estimates": pa.array(keys[:, 1:].tolist(), pa.list_(pa.int64())), "n": pa.array(n, pa.int64())})

    chunked, answers = joined
    rows = chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, "bucket bigint, estimates array<bigint>, n bigint")
    return rows.groupBy("bucket", "estimates").agg(F.sum("n").alias("n"))


def expectation_maximisation(estimates: np.ndarray, n: np.ndarray, allowed: int, rounds: int = 200, tolerance: float = 1e-7) -> np.ndarray:
    """Weights of the columns of ``estimates`` (the first: uniform) that make the
    counted rows likeliest; those beyond ``allowed`` are 0. Each has one count
    beforehand, so none that is allowed becomes 0."""
    k = estimates.shape[1]
    use = np.arange(k) <= allowed
    weights = use / use.sum()
    for _ in range(rounds):
        shares = estimates * weights
        counted = (n[:, None] * shares / shares.sum(axis=1, keepdims=True)).sum(axis=0) + use
        new = counted / counted.sum()
        if np.abs(new - weights).max() < tolerance:
            return new
        weights = new
    return weights


def _weights(held: DataFrame, order: int, types: int) -> dict[int, np.ndarray]:
    """The mixture of each bucket. A bucket's held-out counts are at most one row
    for each combination of estimates' steps."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        logs = np.asarray(table.column("estimates").to_pylist(), dtype=float)
        estimates = np.where(logs >= 0, 2.0 ** (-logs / STEP), 0.0)
        estimates = np.concatenate((np.full((len(estimates), 1), 1 / (types + 1)), estimates), axis=1)
        weights = expectation_maximisation(estimates, table.column("n").to_numpy().astype(float), 1 + bucket // 64)
        return pa.table({"bucket": [bucket], "weights": pa.array([weights.tolist()], pa.list_(pa.float64()))})

    rows = held.groupBy("bucket").applyInArrow(run, "bucket bigint, weights array<double>").collect()  # at most 64 * order rows
    return {r["bucket"]: np.asarray(r["weights"]) for r in rows}


def _table(weights: dict[int, np.ndarray], order: int) -> np.ndarray:
    """Weights of every bucket; one that no deleted token met takes those of the
    nearest met bucket of its order (of equally near ones the lower), else equal ones."""
    out = np.zeros((64 * order, order + 1))
    for b in range(64 * order):
        level = b // 64
        met = [k for k in weights if k // 64 == level]
        use = np.arange(order + 1) <= level + 1
        out[b] = weights[min(met, key=lambda k: (abs(k - b), k))] if met else use / use.sum()
    return out


@dataclass
class Sizes:
    """Distinct tokens and tokens, of training documents and of those not deleted."""

    types: int
    tokens: int
    kept_types: int
    kept_tokens: int


def _chosen(chunked: DataFrame) -> DataFrame:
    return chunked.select("chunk", "ids", "role", "counts", "vocabulary", "tokens")


def score(docs: DataFrame, held_out: Column, order: int = 2, modulus: int = 7, deleted: int = 3) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every
    row; scores are sums of log10 probabilities. ``base_score`` is that of single
    tokens with one added to each count. Training documents are those not
    ``held_out``; the deleted ones among them have a crc32 of their id, as text, of
    ``deleted`` modulo ``modulus``."""
    chunked = chunks(docs, _role(F.col("doc_id"), held_out, modulus, deleted))
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    texts = chunked.groupBy("role").agg(F.sum("n_tokens").alias("tokens"), F.sum(F.size("ids")).alias("texts")).collect()
    if not texts:
        return docs.sparkSession.createDataFrame([], shape)
    kept_texts = sum(r["texts"] for r in texts if r["role"] == KEPT)
    all_texts = kept_texts + sum(r["texts"] for r in texts if r["role"] == DELETED)
    buckets = max(1, -(-sum(r["tokens"] for r in texts) // BUCKET))
    answers = _requests(chunked, order, buckets).groupBy("bucket", "m").applyInArrow(_answer, "bucket int, m int, chunk bigint, total binary, kept binary, sizes array<bigint>")
    answers = _save(answers, "answers")
    totals = [F.coalesce(F.sum(F.col("sizes")[i]), F.lit(0)) for i in range(4)]
    sizes = Sizes(*answers.where("chunk = -1 and m = 1").agg(*totals).first())
    part = chunked.where(F.col("role") == DELETED)
    held = _held_out_counts((_chosen(part), answers.where("kept is not null").select("chunk", "bucket", "m", "kept")), order, sizes.kept_tokens, kept_texts)
    weights = _table(_weights(held, order, sizes.kept_types), order)
    arrow_id = docs.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    columns = pa.schema([("doc_id", arrow_id), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in range(left.num_rows):
            s = _sequence(*(left.column(c)[row].as_py() for c in ("counts", "vocabulary", "tokens")), order)
            ends, prior = _counts(s, order, right, "total")
            bucket, estimates = _estimates(s, order, ends, prior, sizes.tokens, all_texts)
            mix = weights[bucket]
            p = mix[:, 0] / (sizes.types + 1)
            for k, e in enumerate(estimates, 1):
                p = p + mix[:, k] * e
            if not sizes.types:
                p = np.ones(len(p))
            of = s.document[s.own]
            sums = lambda x: np.bincount(of, weights=x, minlength=s.documents)
            base = np.log10((ends[0] + 1) / (sizes.tokens + sizes.types + 1))
            n = np.bincount(of, minlength=s.documents)
            known = np.bincount(of[ends[0] > 0], minlength=s.documents)
            out.append(pa.table([left.column("ids")[row].values, pa.array(np.full(s.documents, left.column("role")[row].as_py() == HELD)), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                                 pa.array(np.full(s.documents, sizes.tokens), pa.int64()), pa.array(sums(base)), pa.array(sums(np.log10(p)))], schema=columns))
        return pa.concat_tables(out) if out else columns.empty_table()

    rows = answers.where("chunk <> -1").select("chunk", "bucket", "m", "total")
    return _chosen(chunked).groupBy("chunk").cogroup(rows.groupBy("chunk")).applyInArrow(run, shape)
