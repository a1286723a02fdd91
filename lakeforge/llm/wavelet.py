"""Token-ID output: one wavelet matrix file per shard.

Documents are range-sorted by id and tokenized; each task writes its range as
one or more shard files and reports them in a manifest. A shard holds its
documents' ids and token counts, the sorted token ids it uses (its alphabet),
and one bit-plane per bit of an alphabet index, highest first: the bits in the
order of that plane, packed, with the running count of ones every 512 bits.
Token access, rank, select, counting and occurrence lookup work on the planes
as they are, without unpacking the shard.

Nulls: a null text counts as empty; it, like an empty text, has the end id
alone. A null doc_id sorts first. Rows of one id are all written, in the order
they are read in. Texts are never truncated; a document larger than a shard makes
one larger shard. Other columns of the input don't matter.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeforge.llm import files, store, words
from lakeforge.llm.automaton import IntTable

MAGIC = b"LFWM0001"
#: Bits between two running counts of a plane.
STEP = 512
MANIFEST = "part int, seq int, path string, n_docs bigint, n_tokens bigint"


class WaveletMatrix:
    """A sequence of integers below ``2**len(planes)`` as bit-planes."""

    def __init__(self, n: int, planes: list[np.ndarray], counts: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.counts, self.zeros = n, planes, counts, zeros

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        planes, counts, zeros = [], [], []
        now = values
        for bit in range(bits - 1, -1, -1):
            ones = (now & now.dtype.type(1 << bit)).astype(bool)
            packed = np.packbits(ones)
            full = np.zeros(-(-max(len(packed), 1) // (STEP // 8)) * (STEP // 8), dtype=np.uint8)
            full[: len(packed)] = packed
            each = np.bitwise_count(full.view(np.uint64)).reshape(-1, STEP // 64).sum(axis=1, dtype=np.uint32)
            planes.append(packed)
            counts.append(np.concatenate(([0], np.cumsum(each))).astype(np.uint32))
            now = np.concatenate((now[~ones], now[ones]))
            zeros.append(len(values) - int(counts[-1][-1]))
        return cls(len(values), planes, counts, zeros)

    def _ones(self, level: int, i: int) -> int:
        """Ones before position ``i`` of a plane."""
        block = i // STEP
        at = block * STEP // 8
        whole = self.planes[level][at:i // 8]
        out = int(self.counts[level][block]) + int(np.bitwise_count(whole).sum())
        if i % 8:
            out += (int(self.planes[level][i // 8]) >> (8 - i % 8)).bit_count()
        return out

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (7 - (i & 7)) & 1

    def access(self, i: int) -> int:
        """The value at a position."""
        out = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._ones(level, i)
            out = out << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return out

    def _range(self, value: int, i: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` before ``i`` lie below the last plane."""
        low, high = 0, i
        for level in range(len(self.planes)):
            a, b = self._ones(level, low), self._ones(level, high)
            if value >> (len(self.planes) - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, value: int, i: int) -> int:
        """Occurrences of ``value`` before position ``i``."""
        low, high = self._range(value, i)
        return high - low

    def select(self, value: int, k: int) -> int:
        """Position of occurrence ``k`` (from 0) of ``value``; -1 if there are fewer."""
        low, high = self._range(value, self.n)
        if not 0 <= k < high - low:
            return -1
        i = low + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = value >> (len(self.planes) - 1 - level) & 1
            want = i - self.zeros[level] + 1 if bit else i + 1
            low, high = 0, self.n  # the first position with so many such bits up to it
            while low < high:
                mid = (low + high) // 2
                ones = self._ones(level, mid + 1)
                if (ones if bit else mid + 1 - ones) >= want:
                    high = mid
                else:
                    low = mid + 1
            i = low
        return i

    def values(self, dtype: np.dtype) -> np.ndarray:
        """The whole sequence, rebuilt from the last plane up."""
        now = np.zeros(self.n, dtype=dtype)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n).view(bool)
            before = np.empty_like(now)
            before[~ones] = now[: self.zeros[level]]
            before[ones] = now[self.zeros[level]:] | dtype.type(1 << (len(self.planes) - 1 - level))
            now = before
        return now


class Shard:
    """One shard file: documents, alphabet and wavelet matrix."""

    def __init__(self, doc_ids: list[int | None], lengths: np.ndarray, alphabet: np.ndarray, matrix: WaveletMatrix):
        self.doc_ids, self.lengths, self.alphabet, self.matrix = doc_ids, lengths, alphabet, matrix

    @classmethod
    def of(cls, doc_ids: list[int | None], lengths: np.ndarray, tokens: np.ndarray) -> Shard:
        top = int(tokens.max(initial=0)) + 1
        used = np.zeros(top, dtype=bool)
        used[tokens] = True
        alphabet = np.flatnonzero(used).astype(np.uint32)
        code = np.zeros(top, dtype=np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
        code[alphabet] = np.arange(len(alphabet))
        return cls(doc_ids, lengths, alphabet, WaveletMatrix.build(code[tokens], max(1, int(len(alphabet) - 1).bit_length())))

    def write(self, stream) -> None:
        m = self.matrix
        head = json.dumps({"docs": len(self.doc_ids), "tokens": m.n, "alphabet": len(self.alphabet), "planes": len(m.planes), "zeros": m.zeros, "null_ids": [i for i, d in enumerate(self.doc_ids) if d is None]}).encode()
        stream.write(MAGIC + struct.pack("<I", len(head)) + head)
        stream.write(np.asarray([d or 0 for d in self.doc_ids], dtype="<i8").tobytes())
        stream.write(self.lengths.astype("<u4").tobytes())
        stream.write(self.alphabet.astype("<u4").tobytes())
        for plane, counts in zip(m.planes, m.counts, strict=True):
            stream.write(counts.astype("<u4").tobytes())
            stream.write(plane.tobytes())

    @classmethod
    def read(cls, raw: bytes) -> Shard:
        if raw[:8] != MAGIC:
            raise ValueError("not a shard file")
        (size,) = struct.unpack_from("<I", raw, 8)
        head = json.loads(raw[12:12 + size])
        at = 12 + size

        def take(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, dtype=dtype, count=count, offset=at)
            at += out.nbytes
            return out

        doc_ids = take("<i8", head["docs"]).tolist()
        for i in head["null_ids"]:
            doc_ids[i] = None
        lengths, alphabet = take("<u4", head["docs"]), take("<u4", head["alphabet"])
        packed = -(-head["tokens"] // 8)
        planes, counts = [], []
        for _ in range(head["planes"]):
            counts.append(take("<u4", -(-max(packed, 1) // (STEP // 8)) + 1))
            planes.append(take("u1", packed))
        return cls(doc_ids, lengths, alphabet, WaveletMatrix(head["tokens"], planes, counts, head["zeros"]))

    def tokens(self) -> np.ndarray:
        dtype = np.dtype(np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32)
        return self.alphabet[self.matrix.values(dtype)]

    def token(self, i: int) -> int:
        return int(self.alphabet[self.matrix.access(i)])

    def _code(self, token: int) -> int | None:
        i = int(np.searchsorted(self.alphabet, token))
        return i if i < len(self.alphabet) and self.alphabet[i] == token else None

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of a token, before position ``end``."""
        code = self._code(token)
        return 0 if code is None else self.matrix.rank(code, self.matrix.n if end is None else end)

    def occurrence(self, token: int, k: int) -> int:
        """Position of occurrence ``k`` of a token, or -1."""
        code = self._code(token)
        return -1 if code is None else self.matrix.select(code, k)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


class WordTokenizer:
    """Encodes whole texts with a tokenizer file whose words never span white
    space, nor an ASCII letter and ASCII punctuation.

    The library encodes each distinct word once, as it is written: the file
    composes characters before it lower-cases them, and some capitals with a
    combining mark have no composed form. A word is looked up by two
    64-bit hashes of its bytes, in a table of at most ``limit`` words. Texts
    with ``<|``, where special tokens may stand, go to the library whole.
    """

    LETTERS = _table(bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)))
    MARKS = _table(b'!"#$%&()*+,-./:;=?@[\\]^_`{|}~')

    def __init__(self, path: str, limit: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.limit = Tokenizer.from_file(path), limit
        self._clear()

    def _clear(self) -> None:
        self.table, self.n = IntTable(18), 0
        self.check = np.zeros(1 << 17, dtype=np.uint64)
        self.flat, self.offsets = np.zeros(1 << 19, dtype=np.uint32), np.zeros((1 << 17) + 1, dtype=np.int64)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, keys: np.ndarray, checks: np.ndarray, texts: list[str]) -> np.ndarray:
        ids = self._library(texts)
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        used, n = int(self.offsets[self.n]), self.n + len(texts)
        if n >= len(self.check):
            self.check = np.resize(self.check, 2 * n)
            self.offsets = np.resize(self.offsets, 2 * n + 1)
        if used + lengths.sum() > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (used + int(lengths.sum())))
        codes = np.arange(self.n, n)
        self.check[codes] = checks
        self.offsets[codes + 1] = used + np.cumsum(lengths)
        self.flat[used:used + int(lengths.sum())] = np.concatenate([np.asarray(x, dtype=np.uint32) for x in ids])
        self.table.put(keys, codes)
        self.n = n
        return codes

    def _block(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the words of a block, their numbers of ids, and the ids."""
        b, starts, ends = words.spans(raw, False, (self.LETTERS, self.MARKS))
        h, check = words.hash_spans(b, starts, ends, 2)
        keys = (h >> np.uint64(1)).astype(np.int64)
        if self.n > self.limit:
            self._clear()
        codes = self.table.get(keys)
        new = np.flatnonzero(codes < 0)
        if len(new):
            own, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            first = new[first]
            text = b.tobytes()
            spelled = [text[i:j].decode("utf-8", "replace") for i, j in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            codes[new] = self._add(own, check[first], spelled)[back]
        first = self.offsets[codes]
        lengths = self.offsets[codes + 1] - first
        twice = np.flatnonzero(self.check[codes] != check)
        if len(twice):  # another word with the same first hash: such a block is encoded word by word
            text = b.tobytes()
            ids = self._library([text[i:j].decode("utf-8", "replace") for i, j in zip(starts.tolist(), ends.tolist(), strict=True)])
            return starts, np.asarray([len(x) for x in ids]), np.asarray([y for x in ids for y in x], dtype=np.uint32)
        last = np.cumsum(lengths)
        at = np.repeat(first - (last - lengths), lengths)
        at += np.arange(len(at))
        return starts, lengths, self.flat[at]

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each."""
        plain = [None if t and "<|" in t else t for t in texts]
        counts = np.zeros(len(texts), dtype=np.int64)
        parts = [np.zeros(0, dtype=np.uint32)]
        for raw, bounds, owners in words.blocks(plain):
            starts, lengths, ids = self._block(raw)
            counts += np.bincount(owners[np.searchsorted(bounds, starts, side="right")], weights=lengths, minlength=len(texts)).astype(np.int64)
            parts.append(ids)
        ids = np.concatenate(parts)
        special = [i for i, t in enumerate(texts) if t and "<|" in t]
        if special:
            split = np.split(ids, np.cumsum(counts)[:-1])
            for i in special:
                split[i] = np.asarray([y for x in self._library(re.split(r"[ \t\n\r\f\v]+", texts[i])) for y in x], dtype=np.uint32)
                counts[i] = len(split[i])
            ids = np.concatenate(split)
        return ids, counts


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, shard_tokens: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents' ids to shard files below ``folder``, ascending by
    document id, and return the manifest (``MANIFEST``). A shard is closed when
    it has ``shard_tokens`` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seq = tokenizer(tokenizer_path), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        tokens: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal seq, size
            path = f"{folder}/part-{part:06d}-{seq:06d}.wm"
            with files.committed(path) as f:
                Shard.of(doc_ids, np.concatenate(lengths), np.concatenate(tokens)).write(f)
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [path], "n_docs": [len(doc_ids)], "n_tokens": [size]})
            seq, size = seq + 1, 0
            doc_ids.clear(), lengths.clear(), tokens.clear()
            return row

        for batch in batches:
            for start, rows in words.pieces(batch.column(1), most_rows=512):
                piece = batch.slice(start, rows)
                ids, counts = own.encode_all(piece.column(1).to_pylist())
                ids = np.insert(ids, np.cumsum(counts), end_id)
                found, ends, done, used = piece.column(0).to_pylist(), np.cumsum(counts + 1), 0, 0
                while done < rows:
                    # up to the document that fills the shard, or all
                    upto = min(int(np.searchsorted(ends, used + shard_tokens - size)) + 1, rows)
                    doc_ids.extend(found[done:upto])
                    lengths.append(counts[done:upto] + 1)
                    tokens.append(ids[used:ends[upto - 1]])
                    size += int(ends[upto - 1]) - used
                    done, used = upto, int(ends[upto - 1])
                    if size >= shard_tokens:
                        yield close()
        if doc_ids:
            yield close()

    # rows of one id, or without one, are dealt over ranges in the order they are read in;
    # a key made of texts would have to be read for the ranges' sample too
    ordered = docs.select(F.col(id_col).cast("bigint").alias(id_col), text_col, F.monotonically_increasing_id().alias("__k"))
    ordered = ordered.repartitionByRange(id_col, "__k").sortWithinPartitions(id_col, "__k").drop("__k")
    return store.save(ordered.mapInArrow(run, MANIFEST), "manifest")


def read_shards(spark: SparkSession, manifest: DataFrame, digest: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """Documents of the files in a manifest: doc_id, start (ids before it in
    all files), n_tokens, and ids, or ``digest`` of them where given."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    # one row per task of the write, so this order by part is small
    before = parts.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq")
    placed = manifest.withColumn("inside", F.sum("n_tokens").over(inside) - F.col("n_tokens")).join(before, "part").select("path", (F.col("before") + F.col("inside")).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard.read(files.read_bytes(path))
                tokens, last = shard.tokens(), np.cumsum(shard.lengths.astype(np.int64))
                first = last - shard.lengths
                if digest:
                    made = pa.array([digest(tokens[i:j]) for i, j in zip(first.tolist(), last.tolist(), strict=True)], pa.int64())
                else:
                    made = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], last))), pa.array(tokens.astype(np.int32))).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64()), pa.array(first + start), pa.array(shard.lengths.astype(np.int64)), made], ["doc_id", "start", "n_tokens", "made"])

    tasks = max(1, min(manifest.count(), 20_000))
    kind = "bigint" if digest else "array<int>"
    return placed.repartition(tasks, "path").mapInArrow(run, f"doc_id bigint, start bigint, n_tokens bigint, made {kind}").withColumnRenamed("made", "digest" if digest else "ids")


def crc32_le(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
