"""Bloom filters over 64-bit hashes, for tasks that hold one filter at a time."""

from __future__ import annotations

import numpy as np

#: Bits per hash and probes: about one strange hash in 2,000 is taken for a known one.
BITS, PROBES = 16, 8
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """By probe and hash: the bit to look at."""
    hashes = hashes.view(np.uint64)
    step = (hashes * _SPREAD) >> np.uint64(17) | np.uint64(1)
    return (hashes + np.arange(PROBES, dtype=np.uint64)[:, None] * step) % np.uint64(bits)


def bloom_filter(hashes: np.ndarray) -> bytes:
    bits = np.zeros(max(64, BITS * len(hashes)), bool)
    bits[_places(hashes, len(bits)).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(filter_bytes: bytes, hashes: np.ndarray, n: int) -> np.ndarray:
    """Whether each hash may be one of the ``n`` that the filter was made from; never False for one of them."""
    bits = max(64, BITS * n)
    places = _places(hashes, bits)
    packed = np.frombuffer(filter_bytes, np.uint8)
    shift = (7 - places % np.uint64(8)).astype(np.uint8)
    return ((packed[places // np.uint64(8)] >> shift) & 1).all(axis=0)
