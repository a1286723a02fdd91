"""SentencePiece merge-type (BPE) encoding and decoding, by backtracking.

Encoding is exact. A sequence of pieces is what merging gives if and only if
each two neighbours, merged anew from their characters, come out as those two.
So the encoder walks the text: it takes the longest piece an Aho-Corasick
automaton finds at a position, goes on if that piece is compatible with the
one before it, else tries the next shorter one. When none is left it steps
back and marks the position as failed in a bitfield, so no position is tried
twice.

Texts are cut first where no piece of the vocabulary spans the cut (before a
run of spaces, around line breaks); such segments are independent, and recur.

Nulls: a null text counts as empty. An empty text has no ids and decodes to
an empty text. Texts are never truncated. Repeated rows are encoded each.
Other columns of the input don't matter and are not returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeforge.llm import worker
from lakeforge.llm.automaton import Automaton, IntTable
from lakeforge.llm.segments import SegmentTable

SPACE = "▁"
#: Positions looked up at a time; remembered pairs of pieces, at most.
WINDOW, PAIRS = 4096, 500_000
#: Longest segment encoded in a batch, and characters of a batch; first id of
#: characters that are no piece.
SHORT, BATCH, UNKNOWN = 256, 200_000, 1 << 24


class PieceCodec:
    """Encoder and decoder for a SentencePiece BPE model file whose normalizer
    is the identity and which has byte pieces for characters it doesn't know."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        probe = "A  ﬁ\tẛ̣ "
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only models with an identity normalizer and a dummy prefix are supported")
        n = model.get_piece_size()
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_id = [-1] * 256
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif model.is_unknown(i):
                self.bytes_of[i] = " ⁇ ".encode()
            elif not model.is_control(i):
                self.ids[piece] = i
                self.score[piece] = model.get_score(i)
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
        if min(self.byte_id) < 0:
            raise ValueError("the model has no byte pieces")
        if any(SPACE in p.lstrip(SPACE) or "\n" in p and len(p) > 1 for p in self.ids):
            self.cuts = re.compile(r"(?s).+")
        else:
            self.cuts = re.compile(r" *[^ \n]+| +|\n")
        self.automaton = Automaton({p: len(p) << 25 | i for p, i in self.ids.items() if len(p) == 1 or self.merge(p) == [p]})
        self.longest = max(map(len, self.ids))
        if self.longest > 30:
            raise ValueError("pieces over 30 characters are not supported")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.spelling = {i: p for p, i in self.ids.items()}
        self.fits = IntTable(16)
        self.table = SegmentTable(self.encode_segments)

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text by merging: of neighbours whose union is a
        piece, the best-scored, leftmost pair first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, pair: tuple[str, str]) -> bool:
        """Whether merging the two pieces' characters anew gives just the two."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        known = self.pairs[pair] = tuple(self.merge(pair[0] + pair[1])) == pair
        return known

    def _found(self, segment: str, first: int, last: int) -> list[list[int]]:
        """Ascending lengths of the pieces that start at each position from
        ``first`` to before ``last``; 1 always counts, as any character can
        stand alone."""
        found: list[list[int]] = [[] for _ in range(last - first)]
        for end, value in self.automaton.iter(segment, first, min(len(segment), last + self.longest)):
            length = value >> 25
            start = end + 1 - length - first
            if start < last - first:
                found[start].append(length)
        for lengths in found:
            if not lengths or lengths[0] != 1:
                lengths.insert(0, 1)
        return found

    def pieces(self, segment: str) -> list[str]:
        """The pieces of one segment, by backtracking. Matches are looked up
        ``WINDOW`` positions at a time, so that memory stays small on a text
        without spaces."""
        n, pairs = len(segment), self.pairs
        failed = bytearray(n // 8 + 1)
        taken: list[str] = []
        choice: list[int] = []
        last, at, rank, low = "", 0, -1, 0
        found = self._found(segment, 0, min(n, WINDOW))
        fresh = True
        while at < n:
            if not low <= at < low + WINDOW:
                low = at - at % WINDOW
                found = self._found(segment, low, min(n, low + WINDOW))
            lengths = found[at - low]
            if fresh:
                rank = len(lengths) - 1
            while rank >= 0:
                end = at + lengths[rank]
                if not failed[end >> 3] >> (end & 7) & 1:
                    piece = segment[at:end]
                    if not at:
                        break
                    fits = pairs.get((last, piece))
                    if fits or fits is None and self._compatible((last, piece)):
                        break
                rank -= 1
            fresh = rank >= 0
            if fresh:
                taken.append(piece)
                choice.append(rank)
                last, at = piece, end
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(taken.pop())
                rank = choice.pop() - 1
                last = taken[-1] if taken else ""
        return taken

    def encode_segment(self, segment: str) -> list[int]:
        out: list[int] = []
        for piece in self.pieces(segment.replace(" ", SPACE)):
            known = self.ids.get(piece)
            if known is None:
                out.extend(self.byte_id[b] for b in piece.encode("utf-8", "surrogatepass"))
            else:
                out.append(known)
        return out

    def _fit(self, keys: np.ndarray) -> np.ndarray:
        """Compatibility of pairs of ids, (left << 32 | right); ids from
        ``UNKNOWN`` on are characters that are no piece."""
        fits = self.fits.get(keys)
        new = np.flatnonzero(fits < 0)
        if len(new):
            if self.fits.size > PAIRS:
                self.fits = IntTable(16)
            pairs = np.unique(keys[new])
            spell = lambda i: chr(i - UNKNOWN) if i >= UNKNOWN else self.spelling[i]
            known = np.asarray([self._compatible((spell(k >> 32), spell(k & 0xFFFFFFFF))) for k in pairs.tolist()], dtype=np.int64)
            fits[new] = known[np.searchsorted(pairs, keys[new])]
            have = self.fits.get(pairs) < 0
            self.fits.put(pairs[have], known[have])
        return fits > 0

    def _batch(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``pieces`` for many short segments at once: each step moves every
        unfinished segment by one piece forward, one choice on or one piece
        back. Returns the piece ids of all, and how many each has."""
        text = ("\n".join(segments) + "\n").replace(" ", SPACE)  # no piece but a byte holds a line break
        n = len(text)
        sizes = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        stop = np.cumsum(sizes + 1) - 1
        begin = stop - sizes
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        end, value = self.automaton.find(points, begin, sizes)
        length = value >> 25
        start = end + 1 - length
        alone = np.ones(n, dtype=bool)
        alone[start[length == 1]] = False
        extra = np.flatnonzero(alone)
        # one sortable integer each: start, length (longest first), id
        packed = np.concatenate((start << 30 | (31 - length) << 25 | value & (UNKNOWN * 2 - 1), extra << 30 | 30 << 25 | points[extra] + UNKNOWN))
        packed.sort()
        start, length, piece = packed >> 30, 31 - (packed >> 25 & 31), packed & (UNKNOWN * 2 - 1)
        first = np.concatenate(([0], np.cumsum(np.bincount(start, minlength=n))))
        failed = np.zeros(n + 1, dtype=bool)
        came, choice = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        live = np.flatnonzero(sizes > 0)
        at, last_of = begin[live], stop[live]
        base, k = at.copy(), first[at]
        while len(live):
            spent = k >= first[at + 1]
            try_k = np.where(spent, 0, k)
            to = np.minimum(at + length[try_k], n)
            good = ~spent & ~failed[to]
            test = np.flatnonzero(good & (at != base))
            if len(test):
                left = piece[choice[came[at[test]]]]
                good[test] = self._fit(left << 32 | piece[try_k[test]])
            went = np.flatnonzero(good)
            choice[at[went]] = k[went]
            came[to[went]] = at[went]
            back = np.flatnonzero(spent)
            failed[at[back]] = True
            before = came[at[back]]
            k += 1
            at[went] = to[went]
            k[went] = first[to[went]]
            at[back] = before
            k[back] = choice[before] + 1
            rest = at < last_of
            if not rest.all():
                live, at, last_of, base, k = live[rest], at[rest], last_of[rest], base[rest], k[rest]
        taken = np.zeros(n + 1, dtype=bool)
        at, base = stop[sizes > 0], begin[sizes > 0]
        while len(at):
            at = came[at]
            taken[at] = True
            rest = at > base
            at, base = at[rest], base[rest]
        starts = np.flatnonzero(taken)
        return piece[choice[starts]], np.bincount(np.searchsorted(stop, starts), minlength=len(segments))

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments, one after the other, and the number of each."""
        flat: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        lengths = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        longs, sums = np.flatnonzero(lengths > SHORT), np.concatenate(([0], np.cumsum(lengths)))
        at = 0
        while at < len(segments):
            to = at + 1
            if lengths[at] <= SHORT:
                long = int(np.searchsorted(longs, at))
                last = int(longs[long]) if long < len(longs) else len(segments)
                to = max(to, min(last, int(np.searchsorted(sums, sums[at] + BATCH))))
            else:
                ids = self.encode_segment(segments[at])
                flat.append(np.asarray(ids, dtype=np.int64))
                counts.append(np.asarray([len(ids)]))
                at = to
                continue
            ids, count = self._batch(segments[at:to])
            strange = np.flatnonzero(ids >= UNKNOWN)
            if len(strange):
                raw = [[self.byte_id[b] for b in chr(i - UNKNOWN).encode("utf-8", "surrogatepass")] for i in ids[strange].tolist()]
                width = np.ones(len(ids), dtype=np.int64)
                width[strange] = [len(r) for r in raw]
                owner = np.repeat(np.arange(len(count)), count)
                count = np.bincount(owner, weights=width, minlength=len(count)).astype(np.int64)
                starts = np.cumsum(width) - width
                wide = np.repeat(ids, width)
                for i, r in zip(starts[strange].tolist(), raw, strict=True):
                    wide[i:i + len(r)] = r
                ids = wide
            flat.append(ids)
            counts.append(count)
            at = to
        return np.concatenate(flat), np.concatenate(counts)

    def split(self, text: str | None) -> list[str]:
        """The independent segments of a text, with the dummy prefix."""
        return self.cuts.findall(" " + text.replace(SPACE, " ")) if text else []

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each."""
        return self.table.ids_of([self.split(t) for t in texts])

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids. Control pieces are silent; byte pieces that are no
        valid UTF-8 give U+FFFD; the one leading space of the dummy prefix goes."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(model_path: str) -> PieceCodec:
    """One codec for each model and worker process."""
    return PieceCodec(model_path)


worker.droppable(codec.cache_clear)


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        own = codec(model_path)
        for batch in batches:
            for part in _slices(batch):
                ids, counts = own.encode_all(part.column(1).to_pylist())
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], [id_col, "ids"])
            worker.trim()

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded string) of every row; null ids decode to ''."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        own = codec(model_path)
        for batch in batches:
            for part in _slices(batch):
                texts = [own.decode(ids or ()) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], [id_col, "ids", "decoded"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")
