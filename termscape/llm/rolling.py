"""Hashes of all substrings of one length, and sliding minima, over blocks of whole documents."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_FACTOR = 0x9E3779B97F4A7C15

#: Documents are put together up to so many bytes; small enough for the processor's cache.
BLOCK_BYTES = 1 << 17


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.RandomState(7).randint(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def blocks(ends: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents, ``first`` to ``last`` (not included), of about ``size`` bytes or one document."""
    first = 0
    while first < len(ends):
        start = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, start + size, side="right")))
        yield first, last
        first = last


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes (a power of two) from each place on, by doubling the length."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    found, have, factor = _byte_values()[data], 1, _FACTOR
    while have < size:
        found = found[:-have] * np.uint64(factor) + found[have:]
        have, factor = 2 * have, factor * factor & 0xFFFFFFFFFFFFFFFF
    return mixed(found)


def row_hashes(rows: np.ndarray) -> np.ndarray:
    """What ``gram_hashes`` gives for each row of a matrix of bytes, whose width is a power of two."""
    found, factor = _byte_values()[rows], _FACTOR
    while found.shape[1] > 1:
        found = found[:, 0::2] * np.uint64(factor) + found[:, 1::2]
        factor = factor * factor & 0xFFFFFFFFFFFFFFFF
    return mixed(found[:, 0])


def sliding(values: np.ndarray, width: int, combine: np.ufunc) -> np.ndarray:
    """``combine`` over each run of ``width`` values, by doubling the run."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = combine(values[: len(values) - step], values[step:])
        have += step
    return values
