"""Substring dedup: seeds, extended to the window that holds them.

A repeat is a run of at least ``length`` words of a document whose words also
stand in a document with a smaller id. Every such run is found, whatever its
length or the number of documents that share it.

Seeds: each stretch of ``length`` words holds ``length - K + 1`` sequences of K
words; the one with the smallest hash is the stretch's anchor (winnowing). Equal
stretches have equal anchors, so only stretches whose anchor stands in two
documents can be repeats, and anchors are a few per stretch, not one per word.

Extension: a shared anchor is extended both ways to all stretches that have it as
their anchor, and these are compared by a 96-bit hash of all their words.
Neighbouring stretches that repeat make up the maximal repeat.

Documents are dealt into groups of a few MB by a hash of id and text. A group sums
up what its documents hold (distinct anchors; for stretches the smallest id)
before anything is shuffled, and gets back only what concerns it. So a passage
that stands in a third of all documents is one entry per group, not per
document, and no task holds its documents.

Nulls: a null text has no words; a null id counts as smaller than others. A
document with fewer than ``length`` words has no repeats. Rows with the same id
are no repeats of each other and are returned each. Texts are read whole. Other
columns of the input don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm import store, words

#: Words of an anchor; bytes of text in a group of documents; of a bucket.
K, GROUP_BYTES, BUCKET_BYTES = 5, 8 << 20, 32 << 20
_NULL = -(1 << 63)


def _stretches(table: pa.Table, length: int, families: int) -> tuple[list[int], list[str | None], np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Ids and texts of a group's rows in id order, their word counts, and of
    each stretch its row, its first word, and its word hashes by family."""
    table = table.select(["id", "text"]).sort_by([("id", "ascending"), ("text", "ascending")])
    ids = table.column("id").to_pylist()
    texts = table.column("text").to_pylist()
    counts, hashes = words.word_hashes(texts, families=families)
    per_row = np.maximum(counts - length + 1, 0)
    row = np.repeat(np.arange(len(ids)), per_row)
    first = np.repeat(np.cumsum(counts) - counts - (np.cumsum(per_row) - per_row), per_row) + np.arange(len(row))
    return ids, texts, counts, row, first, hashes


def _anchors(h: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """The anchor of each stretch."""
    if not len(first):
        return np.zeros(0, dtype=np.uint64)
    k = min(K, length)
    low, have, want = words.gram_hashes(h, k), 1, length - k + 1
    while have < want:  # minima over ever more neighbours
        step = min(have, want - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low[first]


def _deal(keys: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Numbers of the keys of each bucket; within one, in the keys' order."""
    bucket = (keys >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    return np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets).astype(np.uint64)))


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


_UP = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("keys", pa.binary()), ("more", pa.binary()), ("low", pa.binary())])
_DOWN = pa.schema([("g", pa.int32()), ("keys", pa.binary()), ("more", pa.binary()), ("low", pa.binary())])
_UP_SQL, _DOWN_SQL = "bucket int, g int, keys binary, more binary, low binary", "g int, keys binary, more binary, low binary"


def _blobs(table: pa.Table, name: str, dtype: str) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=dtype) for x in table.column(name).to_pylist()]


def find_repeats(docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, starts array<int>, lengths array<int>, kept string) of every
    row: its maximal repeats, as word numbers from 0, and the words outside of
    them joined by single spaces."""
    spark = docs.sparkSession
    size = store.text_bytes(docs.select(F.col(text_col).alias("text")))
    groups = max(1, -(-size // GROUP_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = max(1, -(-size // BUCKET_BYTES))
    dealt = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NULL)).alias("id"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(id_col).cast("bigint"), F.col(text_col)), F.lit(groups)).cast("int").alias("g"))

    def seeds(table: pa.Table) -> pa.Table:
        """A group's distinct anchors, and whether two of its rows have one."""
        g = table.column("g")[0].as_py()
        _, _, _, row, first, (h,) = _stretches(table, length, 1)
        anchor = _anchors(h, first, length)
        fresh = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))) if len(row) else np.zeros(0, dtype=bool)
        anchor, row = anchor[fresh], row[fresh]
        order = np.lexsort((row, anchor))
        anchor, row = anchor[order], row[order]
        fresh = np.concatenate(([True], anchor[1:] != anchor[:-1])) if len(row) else np.zeros(0, dtype=bool)
        at = np.flatnonzero(fresh)
        last = np.concatenate((at[1:], [len(row)])) - 1 if len(at) else at
        shared = (row[last] > row[at]).astype(np.uint8)
        keys = anchor[at]
        return _rows(_UP, [(b, g, keys[i].tobytes(), shared[i].tobytes(), b"") for b, i in enumerate(_deal(keys, buckets)) if len(i)])

    def shared_seeds(table: pa.Table) -> pa.Table:
        """A bucket's anchors that stand in two documents, for each group that has them."""
        parts = _blobs(table, "keys", "<u8")
        keys, shared = np.concatenate(parts), np.concatenate(_blobs(table, "more", "u1"))
        distinct, back, times = np.unique(keys, return_inverse=True, return_counts=True)
        twice = times > 1
        twice[back[shared > 0]] = True
        wanted = twice[back]
        out, at = [], 0
        for g, part in zip(table.column("g").to_pylist(), parts, strict=True):
            own = part[wanted[at:at + len(part)]]
            at += len(part)
            if len(own):
                out.append((g, own.tobytes(), b"", b""))
        return _rows(_DOWN, out)

    def extended(table: pa.Table, known: pa.Table) -> pa.Table:
        """A group's stretches that have a shared anchor, with the smallest id of each."""
        if not table.num_rows or not known.num_rows:
            return _rows(_UP, [])
        g = table.column("g")[0].as_py()
        ids, _, _, row, first, hashes = _stretches(table, length, 2)
        anchor, seeds_ = _anchors(hashes[0], first, length), np.sort(np.concatenate(_blobs(known, "keys", "<u8")))
        hit = np.flatnonzero(seeds_[np.minimum(np.searchsorted(seeds_, anchor), len(seeds_) - 1)] == anchor)
        if not len(hit):
            return _rows(_UP, [])
        keys, more = words.gram_hashes(hashes[0], length)[first[hit]], (words.gram_hashes(hashes[1], length, 1)[first[hit]] >> np.uint64(32)).astype("<u4")
        order = np.lexsort((row[hit], more, keys))  # rows are in id order
        keys, more, low = keys[order], more[order], np.asarray(ids, dtype="<i8")[row[hit][order]]
        fresh = np.concatenate(([True], (keys[1:] != keys[:-1]) | (more[1:] != more[:-1])))
        keys, more, low = keys[fresh], more[fresh], low[fresh]
        return _rows(_UP, [(b, g, keys[i].tobytes(), more[i].tobytes(), low[i].tobytes()) for b, i in enumerate(_deal(keys, buckets)) if len(i)])

    def smallest(table: pa.Table) -> pa.Table:
        """For each group, its stretches that another group has in a smaller document."""
        parts, gs = _blobs(table, "keys", "<u8"), table.column("g").to_pylist()
        keys, more, low = np.concatenate(parts), np.concatenate(_blobs(table, "more", "<u4")), np.concatenate(_blobs(table, "low", "<i8"))
        order = np.lexsort((low, more, keys))
        fresh = np.concatenate(([True], (keys[order][1:] != keys[order][:-1]) | (more[order][1:] != more[order][:-1])))
        best = np.empty_like(low)
        best[order] = low[order][fresh][np.cumsum(fresh) - 1]
        out, at = [], 0
        for g, part in zip(gs, parts, strict=True):
            mine = slice(at, at + len(part))
            at += len(part)
            i = np.flatnonzero(best[mine] < low[mine])
            if len(i):
                out.append((g, part[i].tobytes(), more[mine][i].tobytes(), best[mine][i].tobytes()))
        return _rows(_DOWN, out)

    result = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int32())), ("kept", pa.string())])

    def cut(table: pa.Table, known: pa.Table) -> pa.Table:
        """The repeats of a group's rows, by other groups' answers and its own."""
        if not table.num_rows:
            return _rows(result, [])
        ids, texts, counts, row, first, hashes = _stretches(table, length, 2)
        id_of = np.asarray(ids, dtype=np.int64)
        keys = words.gram_hashes(hashes[0], length)[first] if len(first) else np.zeros(0, dtype=np.uint64)
        repeated = np.zeros(len(keys), dtype=bool)
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        many = np.zeros(len(keys), dtype=bool)
        many[order[1:][same]] = True
        many[order[:-1][same]] = True
        if known.num_rows:
            k, m, v = (np.concatenate(_blobs(known, *x)) for x in (("keys", "<u8"), ("more", "<u4"), ("low", "<i8")))
            there = np.sort(k)
            many |= there[np.minimum(np.searchsorted(there, keys), len(there) - 1)] == keys
        else:
            k, m, v = np.zeros(0, dtype="<u8"), np.zeros(0, dtype="<u4"), np.zeros(0, dtype="<i8")
        hit = np.flatnonzero(many)
        if len(hit):
            more = (words.gram_hashes(hashes[1], length, 1)[first[hit]] >> np.uint64(32)).astype("<u4")
            all_keys, all_more, all_low = np.concatenate((keys[hit], k)), np.concatenate((more, m)), np.concatenate((id_of[row[hit]], v))
            order = np.lexsort((all_low, all_more, all_keys))
            fresh = np.concatenate(([True], (all_keys[order][1:] != all_keys[order][:-1]) | (all_more[order][1:] != all_more[order][:-1])))
            best = np.empty_like(all_low)
            best[order] = all_low[order][fresh][np.cumsum(fresh) - 1]
            repeated[hit] = best[: len(hit)] < id_of[row[hit]]
        # words covered by a repeated stretch: +1 where one starts, -1 after its end
        cover = np.zeros(int(counts.sum()) + 1, dtype=np.int32)
        np.add.at(cover, first[repeated], 1)
        np.add.at(cover, first[repeated] + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        out, at = [], 0
        for i, text, n in zip(ids, texts, counts.tolist(), strict=True):
            own = gone[at:at + n]
            at += n
            parts = (text or "").encode("utf-8", "surrogatepass").split()
            if own.any():
                edge = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0]))))
                starts, ends = edge[0::2], edge[1::2]
                parts = [p for p, x in zip(parts, own.tolist(), strict=True) if not x]
                spans = (starts.tolist(), (ends - starts).tolist())
            else:
                spans = ([], [])
            out.append((None if i == _NULL else i, n, *spans, b" ".join(parts).decode("utf-8", "replace")))
        return _rows(result, out)

    by_group = dealt.groupBy("g")
    found = by_group.applyInArrow(seeds, _UP_SQL).groupBy("bucket").applyInArrow(shared_seeds, _DOWN_SQL)
    compared = by_group.cogroup(found.groupBy("g")).applyInArrow(extended, _UP_SQL).groupBy("bucket").applyInArrow(smallest, _DOWN_SQL)
    done = by_group.cogroup(compared.groupBy("g")).applyInArrow(cut, "id bigint, n_words bigint, starts array<int>, lengths array<int>, kept string")
    return done.withColumnRenamed("id", id_col)
