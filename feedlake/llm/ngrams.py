"""Hashed character n-grams of whole texts as numpy arrays."""

from __future__ import annotations

from functools import cache

import numpy as np

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D], np.uint32)
_SPACE = 0x20


@cache
def _letters() -> np.ndarray:
    """Which code points are letters, once per process."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters_only(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, each run of anything else one space, spaces at both ends.

    A text without a letter gives an empty array.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, np.uint32(_SPACE))
    points = np.concatenate(([_SPACE], points, [_SPACE])).astype(np.uint32)
    spaces = points == _SPACE
    points = points[~(spaces & np.concatenate(([False], spaces[:-1])))]
    return points if len(points) > 1 else points[:0]


def buckets(points: np.ndarray, sizes: tuple[int, ...], bits: int, within_words: bool) -> np.ndarray:
    """The bucket of every n-gram; ``within_words`` leaves out those with a space inside."""
    found = []
    for n in sizes:
        count = len(points) - n + 1
        if count <= 0:
            continue
        h = np.full(count, n * 0x1000193 & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            h += (points[k : k + count] ^ (h >> np.uint32(15))) * _MULTIPLIERS[k]
        h ^= h >> np.uint32(16)
        h *= np.uint32(0x7FEB352D)
        if within_words and n > 2:
            spaces = np.concatenate(([0], np.cumsum(points == _SPACE)))
            h = h[spaces[n - 1 : n - 1 + count] == spaces[1 : 1 + count]]
        found.append(h >> np.uint32(32 - bits))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)
