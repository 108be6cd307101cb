"""Places and 64-bit hashes of words and finer pieces of texts, in numpy, for use inside tasks.

Like ``words``, but a piece keeps its place, so that its text can be read again:
many pieces are equal, and only one of each needs to be looked at in Python.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np

from foliant.llm.words import _VALUE, _cuts, _powers, mix

_EACH = np.arange(1, 257, dtype=np.uint64)
#: cut(part, begins of texts in part) gives first and behind-last places of the pieces of a part.
Cut = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Pieces(NamedTuple):
    """Pieces of all texts in order; text i has those from bounds[i] to bounds[i + 1]."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def between(blanks: np.ndarray) -> Cut:
    """Words: whatever lies between blanks, by byte value, or ends of texts."""

    def cut(part: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        blank = blanks[part]
        word = ~blank
        begins, ends = word.copy(), word.copy()
        begins[1:] &= blank[:-1]
        ends[:-1] &= blank[1:]
        begins[inside] |= word[inside]
        ends[inside - 1] |= word[inside - 1]
        return np.flatnonzero(begins), np.flatnonzero(ends) + 1

    return cut


def pieces(data: np.ndarray, offsets: np.ndarray, blanks: np.ndarray, cut: Cut, fold: bool = True) -> Pieces:
    """The pieces of all texts. No piece holds a blank, and none reaches over two texts. fold: A-Z hash as a-z."""
    value = _VALUE if fold else _EACH
    hashes, starts, ends = [], [], []
    for at, to in _cuts(data, offsets, blanks):
        part = data[at:to]
        first, last = cut(part, offsets[(offsets > at) & (offsets < to)] - at)
        up, down = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(value[part] * up[: len(part)], out=sums[1:])
        hashes.append(mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)))
        starts.append(first + at)
        ends.append(last + at)
    if not hashes:
        none = np.zeros(0, np.int64)
        return Pieces(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    begins = np.concatenate(starts)
    return Pieces(np.concatenate(hashes), begins, np.concatenate(ends), np.searchsorted(begins, offsets))
