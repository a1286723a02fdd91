"""An Aho-Corasick automaton held in numpy arrays, which reads many short
strings at once: each step moves every string by one character."""

from __future__ import annotations

from collections import deque

import numpy as np

_CHAR = 21


class IntTable:
    """A hash table of non-negative integers in numpy arrays, with open
    addressing; many keys are put or got at once."""

    def __init__(self, bits: int):
        self.bits, self.size = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are distinct and not there yet."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            old, had = self.keys[self.keys >= 0], self.values[self.keys >= 0]
            self.__init__((2 * (self.size + len(keys))).bit_length() + 1)
            self.put(old, had)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):  # linear probing, all keys at once; of those that meet, one stays
            free = todo[self.keys[at[todo]] < 0]
            self.keys[at[free]] = keys[free]
            here = self.keys[at[todo]] == keys[todo]
            self.values[at[todo[here]]] = values[todo[here]]
            todo = todo[~here]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
        self.size += len(keys)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, -1 for those that aren't there."""
        at = self._slot(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            there = self.keys[at[left]]
            same = there == keys[left]
            out[left[same]] = self.values[at[left[same]]]
            left = left[~same & (there >= 0)]
        return out


class Automaton:
    """Finds all occurrences of ``patterns`` (text to a value of 0 or more)."""

    def __init__(self, patterns: dict[str, int]):
        goto: list[dict[int, int]] = [{}]
        value: list[int] = [-1]
        for pattern, v in patterns.items():
            s = 0
            for c in map(ord, pattern):
                t = goto[s].get(c)
                if t is None:
                    t = goto[s][c] = len(goto)
                    goto.append({})
                    value.append(-1)
                s = t
            value[s] = v
        fail = [0] * len(goto)
        hits: list[tuple[int, ...]] = [()] * len(goto)
        queue = deque(goto[0].values())
        for s in queue:
            hits[s] = (value[s],) if value[s] >= 0 else ()
        while queue:
            s = queue.popleft()
            for c, t in goto[s].items():
                f = fail[s]
                while f and c not in goto[f]:
                    f = fail[f]
                fail[t] = goto[f].get(c, 0)
                hits[t] = ((value[t],) if value[t] >= 0 else ()) + hits[fail[t]]
                queue.append(t)
        self.goto, self.fail_of, self.hits_of = goto, fail, hits
        self.fail = np.asarray(fail, dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum([len(h) for h in hits])))
        self.values = np.asarray([v for h in hits for v in h], dtype=np.int64)
        edges = np.asarray([(s << _CHAR | c, t) for s, g in enumerate(goto) for c, t in g.items()], dtype=np.int64)
        self.edges = IntTable(max(10, (2 * len(edges)).bit_length() + 1))
        self.edges.put(edges[:, 0], edges[:, 1])

    def find(self, points: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last positions and values of all occurrences in the strings that lie
        at ``begin`` in ``points`` (code points)."""
        order = np.argsort(-sizes, kind="stable")
        begin, sizes = begin[order], sizes[order]
        state_at = np.zeros(len(points), dtype=np.int64)
        state = np.zeros(len(begin), dtype=np.int64)
        for j in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -j, side="left"))  # strings longer than j
            state, char = state[:n], points[begin[:n] + j]
            now = self.edges.get(state << _CHAR | char)
            lost = np.flatnonzero((now < 0) & (state > 0))
            s = state.copy()
            while len(lost):
                s[lost] = self.fail[s[lost]]
                now[lost] = self.edges.get(s[lost] << _CHAR | char[lost])
                lost = lost[(now[lost] < 0) & (s[lost] > 0)]
            state = np.maximum(now, 0)
            state_at[begin[:n] + j] = state
        first = self.first[state_at]
        counts = self.first[state_at + 1] - first
        ends = np.cumsum(counts)
        at = np.repeat(first - (ends - counts), counts)
        at += np.arange(len(at))
        return np.repeat(np.arange(len(points)), counts), self.values[at]

    def iter(self, text: str, first: int, last: int):
        """(last position, value) of the occurrences in one string's range."""
        s = 0
        for i in range(first, last):
            c = ord(text[i])
            while s and c not in self.goto[s]:
                s = self.fail_of[s]
            s = self.goto[s].get(c, 0)
            for value in self.hits_of[s]:
                yield i, value
