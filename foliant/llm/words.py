"""Words of texts as 64-bit hashes, in numpy, for use inside tasks.

A word is a run of bytes other than blank and 0x09-0x0D, with A-Z lower-cased.
Whole Arrow columns are hashed at once: no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C55  # odd, so that its powers have inverses
_INVERSE = pow(_BASE, -1, 1 << 64)
BLANKS = np.zeros(256, bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = True
#: Also ASCII punctuation and control characters.
NOT_ALPHANUMERIC = np.array([x < 128 and not chr(x).isalnum() for x in range(256)])
_VALUE = np.arange(1, 257, dtype=np.uint64)
_VALUE[65:91] += np.uint64(32)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input reaches every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""

    def of(base: int) -> np.ndarray:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    if n > CHUNK:  # one word of more than a chunk
        return of(_BASE), of(_INVERSE)
    if not _POWERS:
        n = CHUNK
        _POWERS.update(up=of(_BASE), down=of(_INVERSE))
    return _POWERS["up"], _POWERS["down"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each text begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def portions(column: pa.Array, size: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about so many bytes of text each; a longer text is one alone."""
    offsets = text_buffer(column)[1]
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = to


def _cuts(data: np.ndarray, offsets: np.ndarray, is_blank: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about a chunk that end where a text ends or at a blank."""
    at, end = 0, len(data)
    while at < end:
        to = min(at + CHUNK, end)
        if to < end:
            text_end = offsets[np.searchsorted(offsets, to, "right") - 1]
            if text_end > at:
                to = int(text_end)
            else:
                stop = int(offsets[np.searchsorted(offsets, to, "left")])
                blanks = np.flatnonzero(is_blank[data[at:to]])
                if len(blanks):
                    to = at + int(blanks[-1]) + 1
                else:
                    while to < stop and not is_blank[data[to]]:
                        to += 1
        yield at, to
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray, blanks: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and each text's first place in them (n + 1 places).

    blanks: which of the 256 byte values part words.
    """
    hashes, places = [], []
    for at, to in _cuts(data, offsets, blanks):
        part = data[at:to]
        blank = blanks[part]
        word = ~blank
        begins = word.copy()
        begins[1:] &= blank[:-1]
        ends = word.copy()
        ends[:-1] &= blank[1:]
        inside = offsets[(offsets > at) & (offsets < to)] - at
        begins[inside] |= word[inside]
        ends[inside - 1] |= word[inside - 1]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        up, down = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUE[part] * up[: len(part)], out=sums[1:])
        h = (sums[last] - sums[first]) * down[first]
        hashes.append(mix(h + (last - first).astype(np.uint64)))
        places.append(first + at)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(starts, offsets)


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; with fewer words, of the whole as one; of none, none."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    size = len(hashes) - n + 1
    total = np.full(size, n, np.uint64)
    for i in range(n):
        factor = np.uint64(int(mix(np.array([i + 1], np.uint64))[0]) | 1)
        total += mix(hashes[i : i + size] * factor)
    return mix(total)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
