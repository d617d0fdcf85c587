"""Token counts of texts by byte-pair merging, for a vocabulary of scored pieces.

A text starts as a list of its characters.  A heap holds every adjacent pair whose union is a piece; the pair of the
lowest rank, of equal ones the leftmost, is merged again and again, and the neighbours of the new symbol are offered.
Symbols are a linked list, so a merge costs the logarithm of the heap.  No identifier is looked up: the count is the
number of initial symbols less one for every merge.  A character that is no piece counts its bytes, as with byte fallback.

Merges never cross a place where no piece has those neighbours.  Where no piece holds a space mark after another sign,
and around signs that no longer piece holds, a text falls apart into segments, whose counts add up; each task
remembers a bounded number of them.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
import sentencepiece
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "▁"
REMEMBERED = 1 << 20  # segments, some 200 bytes each
LONGEST_REMEMBERED = 64


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: the rank of every piece (of the highest score the lowest), and the model that normalises texts."""

    ranks: dict[str, int]
    model: bytes

    @classmethod
    def load(cls, path: str) -> Pieces:
        """Of a sentencepiece BPE model with byte fallback and neither unused nor user-defined pieces.

        Read here, on the driver, and shipped with the job: the file need not lie on the executors.
        """
        with open(path, "rb") as file:
            model = file.read()
        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        numbers = range(own.get_piece_size())
        if not any(map(own.is_byte, numbers)) or any(map(own.is_unused, numbers)):
            raise ValueError("a model with byte fallback and without unused pieces is needed")
        plain = [n for n in numbers if not (own.is_byte(n) or own.is_control(n) or own.is_unknown(n))]
        scores = [own.get_score(n) for n in plain]
        places = {score: rank for rank, score in enumerate(sorted(set(scores), reverse=True))}
        return cls({own.id_to_piece(n): places[s] for n, s in zip(plain, scores)}, model)

    def segments(self) -> re.Pattern:
        """Parts of a normalised text between which no merge can happen."""
        longer = [piece for piece in self.ranks if len(piece) > 1]
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in longer):
            return re.compile(r".+", re.DOTALL)
        met = "".join(re.escape(c) for c in sorted({c for piece in longer for c in piece} - {SPACE}))
        return re.compile(rf"{SPACE}*[{met}]+|{SPACE}+|[^{met}{SPACE}]")


def merged_count(segment: str, ranks: dict[str, int]) -> int:
    """Tokens of a segment: its symbols less its merges."""
    size, rank_of = len(segment), ranks.get
    weight = [1 if c in ranks else len(c.encode()) for c in segment]
    count = sum(weight)
    # A symbol is named by the place where it starts; it ends where the next one starts.  0: merged into another.
    end = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    heap: list[tuple[int, int, int]] = []
    for left in range(size - 1):
        rank = rank_of(segment[left : left + 2])
        if rank is not None:
            heap.append((rank, left, left + 2))
    heapq.heapify(heap)
    while heap:
        _, left, stop = heapq.heappop(heap)
        right = end[left]
        if right == 0 or right >= size or end[right] != stop:
            continue  # one of the two has been merged since
        count -= weight[left] + weight[right] - 1
        weight[left] = 1
        end[left], end[right] = stop, 0
        if stop < size:
            before[stop] = left
            rank = rank_of(segment[left : end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, left, end[stop]))
        previous = before[left]
        if previous >= 0:
            rank = rank_of(segment[previous:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, previous, stop))
    return count


class Segments(dict):
    """Counts of segments, computed when first met; memory is bounded."""

    def __init__(self, ranks: dict[str, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, segment: str) -> int:
        count = merged_count(segment, self.ranks)
        if len(segment) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[segment] = count
        return count


def counter(pieces: Pieces) -> Callable[[str | None], int]:
    """The number of tokens of a text; null counts as empty."""
    normalise = sentencepiece.SentencePieceProcessor(model_proto=pieces.model).normalize
    finditer, found = pieces.segments().finditer, Segments(pieces.ranks)

    def count(text: str | None) -> int:
        if not text:
            return 0
        return sum(map(found.__getitem__, map(re.Match.group, finditer(normalise(text)))))

    return count


def tokens(text: Column, pieces: Pieces) -> Column:
    """Tokens of a text column, without begin, end or special tokens.

    Null and empty texts have none.  Whole texts are counted, of any length: segments are met one after the other.
    Marker strings inside a text are ordinary text.  Repeated rows are counted each; an empty table gives none.
    """

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.array([count(text.as_py()) for text in texts], pa.int64())

    count = _PerWorker(pieces)
    return counted(text)


class _PerWorker:
    """A counter that is made where it is first used, and not shipped."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.own = pieces, None

    def __call__(self, text: str | None) -> int:
        self.own = self.own or counter(self.pieces)
        return self.own(text)

    def __getstate__(self):
        return {"pieces": self.pieces, "own": None}
