"""Word and word-sequence hashing of whole texts with numpy, inside tasks.

Words are the maximal runs of bytes other than space and 0x09-0x0D. A word's
64-bit hash is a polynomial over its bytes modulo 2**64, finalised by a
multiply-xorshift mixer; a sequence's hash is a polynomial over its words'.
Two families (``SEEDS``) give 128 bits where equality is decided by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

SEEDS = ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F))
CHUNK = 1 << 19
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[0x41:0x5B] += 0x20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK + 4096)
        inverse = pow(base, -1, 1 << 64)
        tables = []
        for b in (base, inverse):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        have = _powers[base] = (tables[0], tables[1])
    return have


def blocks(texts: list[str | None]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """The texts' bytes in blocks of about ``CHUNK``: the block, the ends of its
    pieces in it, and which text each piece is of. Long texts are cut at white
    space, so memory doesn't depend on their length (a single word longer than
    a block makes one larger block)."""
    pending: list[bytes] = []
    owners: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        raw = text.encode("utf-8", "surrogatepass")
        at = 0
        while at < len(raw):
            end = min(len(raw), at + CHUNK)
            while end < len(raw) and not _SPACE[raw[end]]:
                end += 1
            pending.append(raw[at:end])
            owners.append(i)
            size += end - at
            at = end
            if size >= CHUNK:
                yield b"\n".join(pending), np.cumsum([len(p) + 1 for p in pending]), np.asarray(owners)
                pending, owners, size = [], [], 0
    if pending:
        yield b"\n".join(pending), np.cumsum([len(p) + 1 for p in pending]), np.asarray(owners)


def spans(raw: bytes, lower: bool = False, cut: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, and starts and ends of the words in them. ``cut``: two tables
    of bytes between which, in either order, words are cut as well."""
    b = np.frombuffer(raw, dtype=np.uint8)
    if lower:
        b = _UPPER[b]
    inside = np.zeros(len(b) + 2, dtype=bool)
    inside[1:-1] = ~_SPACE[b]
    edge = inside[1:] != inside[:-1]
    starts, ends = edge & inside[1:], edge & inside[:-1]
    if cut:
        one, other = cut[0][b], cut[1][b]
        between = one[:-1] & other[1:] | other[:-1] & one[1:]
        starts[1:-1] |= between
        ends[1:-1] |= between
    return b, np.flatnonzero(starts), np.flatnonzero(ends)


def hash_spans(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, families: int = 1) -> list[np.ndarray]:
    """64-bit hashes of byte ranges, per family."""
    values = b.astype(np.uint64) + np.uint64(1)
    out = []
    for base, _ in SEEDS[:families]:
        up, down = _power_tables(base, len(b) + 1)
        total = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(b)], out=total[1:])
        out.append(mix((total[ends] - total[starts]) * down[starts]))
    return out


def pieces(texts: pa.Array, most_bytes: int = 1 << 21, most_rows: int = 256) -> Iterator[tuple[int, int]]:
    """Starts and lengths of stretches of texts that end where they pass a number of
    bytes or rows, so that memory follows neither the rows of a batch nor their
    texts' lengths, but for one text."""
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0)).astype(np.int64)
    start = held = 0
    for i, n in enumerate(size.tolist()):
        held += n
        if held >= most_bytes or i + 1 - start >= most_rows:
            yield start, i + 1 - start
            start, held = i + 1, 0
    if start < len(size):
        yield start, len(size) - start


def word_hashes(texts: list[str | None], lower: bool = False, families: int = 1) -> tuple[np.ndarray, list[np.ndarray]]:
    """Word counts per text, and per family the hashes of all their words, in
    order. ``lower``: A-Z count as a-z."""
    counts = np.zeros(len(texts), dtype=np.int64)
    parts: list[list[np.ndarray]] = [[np.zeros(0, dtype=np.uint64)] for _ in range(families)]
    for raw, bounds, owners in blocks(texts):
        b, starts, ends = spans(raw, lower)
        for part, h in zip(parts, hash_spans(b, starts, ends, families), strict=True):
            part.append(h)
        np.add.at(counts, owners[np.searchsorted(bounds, starts, side="right")], 1)
    return counts, [np.concatenate(p) for p in parts]


def gram_hashes(words: np.ndarray, k: int, family: int = 0) -> np.ndarray:
    """Hash of every ``k`` consecutive words; empty when there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    base = np.uint64(SEEDS[family][1])
    out = words[:n].copy()
    for j in range(1, k):
        out *= base
        out += words[j:j + n]
    return mix(out)
