"""Vectorised text work on the bytes of an Arrow column: words, hashes, shingles.

A slice is a run of rows whose texts lie one behind the other in one byte
array; ``offsets`` has the start of each text and the end of the last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
PIECE_BYTES = 1 << 18  # where a slice is only a step: what a worker has allocated once, it keeps
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, and its distance to 1 has few factors of two
_BASE -= (_BASE % 8) - 5
_MASK = (1 << 64) - 1

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random-looking 64-bit value for each byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2 to the 64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            have = _powers[i]
            while len(have) < n:
                have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
            _powers[i] = have
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Sums whose differences hash any substring (see ``hash_spans``)."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(len(data))[0], out=out[1:])
    return out


def hash_spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes from each start to each end; equal bytes have equal hashes wherever they are."""
    raw = (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def slices(array: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``most`` bytes; null is empty, a row is never cut."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.fill_null("") if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else array.cast(pa.string()).fill_null("")
    n = len(array)
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    _, ends, data = array.buffers()
    offsets = np.frombuffer(ends, kind)[array.offset : array.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end, whole[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of its first word (one more at the end); ``space``: which bytes part words."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~space[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True  # a text's first byte begins a word even if the text before ends with one
    begins = inside[1:] & (~inside[:-1] | first)
    ends = inside[:-1] & (~inside[1:] | np.concatenate([first[:-1], [True]]))
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends), np.searchsorted(starts, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles, with the bounds of each text's shingles.

    Words are lower-cased (A-Z only). A text with fewer words than ``width``
    has its whole sequence as one shingle, and none without words.
    """
    starts, ends, words = word_spans(data, offsets)
    hashes = hash_spans(prefix_hashes(LOWER[data]), starts, ends)
    counts = np.diff(words)
    many = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(many)])
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - words[:-1], many)
    length = np.repeat(np.minimum(counts, width), many)
    base = powers(width + 1)[0]
    out = np.zeros(len(place), np.uint64)
    for i in range(width):
        part = place + i
        short = length <= i
        part[short] = 0
        out += np.where(short, np.uint64(0), hashes[part] if len(hashes) else np.uint64(0)) * base[i]
    return mix(out + length.astype(np.uint64)), bounds
