"""Hashes of byte spans and of their sequences, whole arrays at a time."""

from functools import lru_cache

import numpy as np

#: Odd base of the polynomial over the bytes of a span, and odd factors that mix.
BASE, MIX, NEXT = 0x9E3779B97F4A7C55, np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes whose powers are worked on at a time; a longer span is a run of its own.
RUN = 1 << 19


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i up to ``n``."""
    inverse = pow(base, -1, 1 << 64)
    steps = np.full(n + 1, base, np.uint64), np.full(n + 1, inverse, np.uint64)
    for step in steps:
        step[0] = 1
    return np.cumprod(steps[0]), np.cumprod(steps[1])


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * MIX
    x = (x ^ (x >> np.uint64(27))) * NEXT
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """64-bit hashes of the spans ``data[start:end]``, which ascend and do not overlap."""
    found, first = np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        at = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, at + RUN, side="right")))
        stop = int(ends[last - 1])
        power, inverse = _powers(max(RUN, stop - at), base)
        sums = np.zeros(stop - at + 1, np.uint64)
        np.cumsum((data[at:stop].astype(np.uint64) + np.uint64(1)) * power[: stop - at], out=sums[1:])
        begin = starts[first:last] - at
        found[first:last] = (sums[ends[first:last] - at] - sums[begin]) * inverse[begin]
        first = last
    return mixed(found)


def followed(hashes: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Hashes of sequences that go on: each of ``hashes`` and then the one of ``by`` at its place."""
    return mixed(hashes * NEXT + by)


def edges(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of true values begin and end."""
    padded = np.zeros(len(inside) + 2, np.int8)
    padded[1:-1] = inside
    change = np.diff(padded)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def counted(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array, and how often each stands in it."""
    if not len(ordered):
        return ordered, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], np.diff(np.append(first, len(ordered)))
