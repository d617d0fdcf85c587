"""Words, word hashes and shingles of whole Arrow text columns, without a Python step per word.

Inside a task a batch of texts is one byte buffer.  Words are found and hashed with array operations over that buffer,
so the cost per byte is a few nanoseconds and memory is bounded by ``BLOCK_BYTES`` (a single longer text is a block of
its own).  Both word patterns below treat every byte of a non-ASCII character as part of a word, so working on UTF-8
bytes gives exactly the words of the pattern.

A word, shingle or set is represented by a 64-bit hash.  Two different words share one with a probability of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20
CHUNK_BYTES = 1 << 20

_byte = np.arange(256)
_upper = (_byte >= 0x41) & (_byte <= 0x5A)
FOLD = np.where(_upper, _byte + 32, _byte).astype(np.uint8)
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after folding A-Z to a-z
LETTERS = ((FOLD >= 0x30) & (FOLD <= 0x39)) | ((FOLD >= 0x61) & (FOLD <= 0x7A)) | (_byte >= 0x80)
# [^\x20\x09-\x0D]+
SOLID = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))

_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUE = mix(FOLD.astype(np.uint64) + np.uint64(1))
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, size: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < size:
        table = np.full(1 << max(12, (size - 1).bit_length()), base, np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        _powers[base] = table
    return table


@dataclass
class Block:
    """Some consecutive texts of a batch: rows ``first`` to ``last`` (exclusive) and their words."""

    first: int
    last: int
    data: np.ndarray  # bytes of the texts
    offsets: np.ndarray  # where each text starts in data, and the end
    hashes: np.ndarray  # of the words
    starts: np.ndarray  # of the words, in data
    ends: np.ndarray
    bounds: np.ndarray  # words of text i: bounds[i] to bounds[i + 1]

    def rows(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.last - self.first), np.diff(self.bounds))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), places


def _hash_chunk(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, low: int, high: int) -> np.ndarray:
    """Of the words in data[low:high], none of which crosses its ends."""
    terms = _VALUE[data[low:high]]
    terms *= _power_table(_BASE, high - low)[: high - low]
    sums = np.empty(high - low + 1, np.uint64)
    sums[0] = 0
    np.cumsum(terms, out=sums[1:])
    own = sums[ends - low] - sums[starts - low]
    own *= _power_table(_INVERSE, high - low)[starts - low]
    return mix(own)


def _words(data: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray):
    inside = alphabet[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[offsets] = True
    opens = np.flatnonzero(edge[:-1] & inside)
    closes = np.flatnonzero(edge[1:] & inside) + 1
    hashes = np.empty(len(opens), np.uint64)
    done = 0
    while done < len(opens):
        low = int(opens[done])
        upto = max(int(np.searchsorted(closes, low + CHUNK_BYTES, "right")), done + 1)
        hashes[done:upto] = _hash_chunk(data, opens[done:upto], closes[done:upto], low, int(closes[upto - 1]))
        done = upto
    return hashes, opens, closes, np.searchsorted(opens, offsets)


def buffers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of a text column, some megabytes of whole texts at a time."""
    data, places = text_buffer(column)
    first, n = 0, len(places) - 1
    while first < n:
        last = max(int(np.searchsorted(places, places[first] + BLOCK_BYTES, "right")) - 1, first + 1)
        last = min(last, n)
        yield data[places[first] : places[last]], places[first : last + 1] - places[first]
        first = last


def blocks(column: pa.Array, alphabet: np.ndarray) -> Iterator[Block]:
    """The words of a text column, some megabytes of whole texts at a time."""
    first = 0
    for part, offsets in buffers(column):
        last = first + len(offsets) - 1
        yield Block(first, last, part, offsets, *_words(part, offsets, alphabet))
        first = last


def hash_text(text: str, alphabet: np.ndarray) -> np.ndarray:
    """The word hashes of one text."""
    found = [b.hashes for b in blocks(pa.array([text], pa.large_string()), alphabet)]
    return found[0] if found else np.zeros(0, np.uint64)


_PLACE = [np.uint64(c) for c in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def _combined(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each place at which all parts are read in step; their order and number count."""
    total = np.full(len(parts[0]), np.uint64(len(parts)), np.uint64)
    for part, factor in zip(parts, _PLACE):
        total = mix((total ^ part) * factor)
    return total


def shingles(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every run of ``size`` words; a text of fewer words, but not none, is one run."""
    counts = np.diff(block.bounds)
    h, rows = block.hashes, block.rows()
    if size == 1:
        return rows, h
    starts = np.arange(len(h))
    full = starts + size <= block.bounds[1:][rows]
    at = starts[full]
    found_rows, found = [rows[at]], [_combined([h[at + k] for k in range(size)])]
    for length in range(1, size):
        short = np.flatnonzero(counts == length)
        if len(short):
            at = block.bounds[:-1][short]
            found_rows.append(short)
            found.append(_combined([h[at + k] for k in range(length)]))
    return np.concatenate(found_rows), np.concatenate(found)


def distinct_sets(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingle set of every text: sorted hashes one after the other, and where each set starts and ends."""
    rows, found = shingles(block, size)
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])
    rows, found = rows[keep], found[keep]
    return found, np.searchsorted(rows, np.arange(block.last - block.first + 1))


class Vocabulary:
    """Some word hashes, numbered in ascending order, to be found among the words of a block."""

    BITS = 20

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(np.asarray(hashes, np.uint64))
        self.first_bits = np.zeros(1 << self.BITS, bool)
        self.first_bits[self._first(self.hashes)] = True

    def __len__(self) -> int:
        return len(self.hashes)

    def _first(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that hold a word of the vocabulary, and its number."""
        maybe = np.flatnonzero(self.first_bits[self._first(hashes)])
        if not len(maybe):
            return maybe, maybe
        wanted = hashes[maybe]
        numbers = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        same = self.hashes[numbers] == wanted
        return maybe[same], numbers[same]
