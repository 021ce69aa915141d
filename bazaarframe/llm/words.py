"""Words of whole texts as numpy arrays: boundaries, 64-bit word hashes and hashes of word windows.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Texts are taken from Arrow columns
in pieces of about a megabyte (a longer text is a piece of its own), so memory stays bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PIECE_BYTES = 1 << 20

# Odd multipliers and seeds; any odd 64-bit numbers serve.
TIMES, TIMES_AGAIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
WINDOW_SEEDS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
#: Bytes of a word that are hashed eight at a time with those of other words; longer words are hashed one by one.
SHORT_WORD = 64
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def fold(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One number for each pair; no sum of powers, which would be equal for whole families of sequences."""
    z = x * TIMES
    z += y
    z ^= z >> np.uint64(32)
    z *= TIMES_AGAIN
    return z


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes; words of up to eight bytes never share one with others of their length."""
    sizes = ends - starts
    eights = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).data, strides=(1,))
    hashes = mix((sizes.astype(np.uint64) * TIMES) ^ (eights[starts] & _MASKS[np.minimum(sizes, 8)]))
    more, done = np.flatnonzero((sizes > 8) & (sizes <= SHORT_WORD)), 8
    while len(more):
        chunk = eights[starts[more] + done] & _MASKS[np.minimum(sizes[more] - done, 8)]
        hashes[more] = mix(fold(hashes[more], chunk))
        done += 8
        more = more[sizes[more] > done]
    for i in np.flatnonzero(sizes > SHORT_WORD):
        hashes[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return hashes


@dataclass
class Piece:
    """Some neighbouring texts of a batch: rows first..last, and all their words in order."""

    first: int
    last: int
    data: np.ndarray  # bytes of the texts, one after the other
    starts: np.ndarray  # of each word, in data
    ends: np.ndarray
    hashes: np.ndarray  # uint64 of each word
    bounds: np.ndarray  # words of row first+i: bounds[i]..bounds[i+1]

    def windows(self, size: int, seed: int = WINDOW_SEEDS[0]) -> np.ndarray:
        """Hash of the size words from each word on; only those inside one text mean anything."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        runs, out, width, done = mix(self.hashes ^ np.uint64(seed)), None, 1, 0
        while True:  # runs of 1, 2, 4, ... words, and of them those that make up the size
            if size & width:
                part = runs[done : done + n]
                out = part if out is None else fold(out, part)
                done += width
            if done == size:
                return mix(out)
            runs = fold(runs[:-width], runs[width:])
            width *= 2

    def texts_of_words(self) -> np.ndarray:
        """Row offset (0 = first) of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def texts_and_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offset of each; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def pieces(column: pa.Array, lower: bool) -> Iterator[Piece]:
    """The words of a text column, piece by piece; lower: with A-Z in lower case."""
    if not len(column):
        return
    data, offsets = texts_and_offsets(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + PIECE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield _piece(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first, last, lower)
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """LOWER[data] by arithmetic on bytes, of which a processor does many at a time."""
    return data + ((data - np.uint8(65) < 26).view(np.uint8) << 5)


def in_words(data: np.ndarray) -> np.ndarray:
    """~SPACES[data] by arithmetic on bytes."""
    return (data != 0x20) & (data - np.uint8(9) > 4)


def _piece(data: np.ndarray, offsets: np.ndarray, first: int, last: int, lower: bool) -> Piece:
    if lower:
        data = lowered(data)
    inside = in_words(data)
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cuts] = inside[cuts]
    closes[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    hashes = _word_hashes(data, starts, ends)
    return Piece(first, last, data, starts, ends, hashes, np.searchsorted(starts, offsets))


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Least of x[i:i+size] for every i that has so many."""
    width = 1
    while width * 2 <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def binaries(arrays: list[np.ndarray]) -> pa.Array:
    """An Arrow binary column of the arrays' bytes."""
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def lists(values: np.ndarray, per_row: int) -> pa.Array:
    """A list<int64> column with the same number of values in every row."""
    n = len(values) // per_row if per_row else 0
    offsets = np.arange(n + 1, dtype=np.int32) * per_row
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))
