"""Words and word windows of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tallyloom.llm.tables import SPACE_BYTES

_CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True
#: Random odd numbers from a fixed seed: a code for each byte, a factor for each place in a window.
_CODES = np.random.default_rng(20240917).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = np.random.default_rng(77003).integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _CODES.copy()
_FOLDED[65:91] = _CODES[97:123]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_bounds(
    data: np.ndarray, at: np.ndarray, is_space: np.ndarray = _IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of words before each text (and in all)."""
    inside = ~is_space[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = at[:-1][np.diff(at) > 0]
    begins[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[first[1:] - 1] = inside[first[1:] - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool) -> np.ndarray:
    """A hash of each word's bytes; with ``fold_case`` A-Z count as a-z.

    Hashes come from running sums over pieces of about a megabyte, so memory doesn't follow the text.
    """
    codes = _FOLDED if fold_case else _CODES
    out = np.empty(len(starts), np.uint64)
    up = down = np.empty(0, np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(starts, low + _CHUNK)))
        n = int(ends[j - 1] - low)
        if len(up) < n + 1:
            up, down = _powers(_BASE, n + 1), _powers(_INVERSE, n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes[data[low : low + n]] * up[:n], out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` words in a row; the first stands at its first word."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out += words[k : k + n] * _FACTORS[k]
    return mixed(out)


def text_words(
    data: np.ndarray, at: np.ndarray, fold_case: bool, is_space: np.ndarray = _IS_SPACE
) -> Iterator[np.ndarray]:
    """The word hashes of each text, a few megabytes of text at a time."""
    i, last = 0, len(at) - 1
    while i < last:
        j = max(i + 1, int(np.searchsorted(at, at[i] + 4 * _CHUNK)))
        j = min(j, last)
        part = data[at[i] : at[j]]
        starts, ends, before = word_bounds(part, at[i : j + 1] - at[i], is_space)
        hashes = word_hashes(part, starts, ends, fold_case)
        for k in range(j - i):
            yield hashes[before[k] : before[k + 1]]
        i = j


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct windows; a shorter text counts as one window, an empty one has none."""
    if not len(words):
        return np.empty(0, np.uint64)
    if len(words) < width:
        return windows(words, len(words)) ^ np.uint64(len(words))
    found = np.sort(windows(words, width))
    return found[np.concatenate(([True], found[1:] != found[:-1]))]
