"""A cache of encoded text segments, for tokenizers whose segments are
independent: ids of many texts are gathered with numpy from one flat table."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, repeat

import numpy as np


class SegmentTable:
    """Maps segments to their ids. ``encode`` gets the segments not seen before,
    a list at a time, and returns their ids one after the other, and the number
    of each. Past ``limit`` segments or ``ids`` ids the table starts anew, so a
    task's memory is bounded whatever the vocabulary of the corpus."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 500_000, ids: int = 4_000_000):
        self.encode, self.limit, self.most_ids = encode, limit, ids
        self._clear()

    def _clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.offsets = np.zeros(1 << 14, dtype=np.int64)

    def _add(self, segments: list[str]) -> None:
        n, used = len(self.codes), int(self.offsets[len(self.codes)])
        ids, counts = self.encode(segments)
        total = used + len(ids)
        if total > len(self.flat):
            self.flat = np.resize(self.flat, max(total, 2 * len(self.flat)))
        if n + len(segments) >= len(self.offsets):
            self.offsets = np.resize(self.offsets, max(n + len(segments) + 1, 2 * len(self.offsets)))
        self.flat[used:total] = ids
        self.offsets[n + 1:n + len(segments) + 1] = used + np.cumsum(counts)
        self.codes.update(zip(segments, range(n, n + len(segments)), strict=True))

    def ids_of(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all lists of segments, one after the other, and how many
        each list has."""
        if len(self.codes) >= self.limit or self.offsets[len(self.codes)] >= self.most_ids:
            self._clear()
        segments = list(chain.from_iterable(texts))
        codes = np.fromiter(map(self.codes.get, segments, repeat(-1)), dtype=np.int64, count=len(segments))
        missing = np.flatnonzero(codes < 0).tolist()
        if missing:
            own = [segments[i] for i in missing]
            self._add(sorted(set(own)))
            codes[missing] = [self.codes[s] for s in own]
        first = self.offsets[codes]
        lengths = self.offsets[codes + 1] - first
        ends = np.cumsum(lengths)
        at = np.repeat(first - (ends - lengths), lengths)
        at += np.arange(len(at))
        last = np.cumsum([len(t) for t in texts])
        total = np.concatenate(([0], ends))[np.concatenate(([0], last))]
        return self.flat[at], np.diff(total)
