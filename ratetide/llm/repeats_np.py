"""Byte-string names for the repeated-span search, in numpy.

A *name* stands for the rank of a byte string: equal strings have equal names.
The name of a string of length 2h is made from the pair of names of length h
at offset h (prefix doubling: 1, 2, 4, ... and a last, overlapping step to the
wanted length).  Names are content hashes, so tasks agree on them without
talking; Spark only has to bring equal names together.

Positions are thinned by content: each window of ``SPAN`` bytes owns one
*anchor*, the start of its smallest-named ``GRAM``-byte string.  Equal windows
own anchors at equal offsets.
"""

from __future__ import annotations

import numpy as np

GRAM = 16
U = np.uint64
_M1, _M2, _M3 = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93), U(0xC2B2AE3D27D4EB4F)
CHUNK = 1 << 18


def _bytes() -> np.ndarray:
    x = np.arange(1, 257, dtype=U) * _M3
    for _ in range(3):
        x ^= x >> U(31)
        x *= _M2
    return x


TABLE = _bytes()


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> U(29)
    x *= _M2
    x ^= x >> U(32)
    return x


def pair(names: np.ndarray, offset: int) -> np.ndarray:
    """Names of (string at p, string at p + offset)."""
    out = names[: len(names) - offset] * _M1
    out += names[offset:]
    return _mix(out)


def gram_names(data: np.ndarray) -> np.ndarray:
    """Names of all ``GRAM``-byte strings, by doubling from single bytes."""
    names, h = TABLE[data], 1
    while h < GRAM:
        step = min(h, GRAM - h)
        names, h = pair(names, step), h + step
    return names


def names_at(grams: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Names of the ``length``-byte strings at the given positions: the
    doubling goes on from the gram names, only where it is asked for."""
    offsets, h = [0], GRAM
    while h < length:
        step = min(h, length - h)
        offsets = [*offsets, *(o + step for o in offsets)]
        h += step
    names = [grams[at + o] for o in offsets]
    while len(names) > 1:
        half = len(names) // 2
        names = [_mix(a * _M1 + b) for a, b in zip(names[:half], names[half:], strict=True)]
    return names[0] if len(offsets) > 1 else names[0].copy()


def check_names(grams: np.ndarray, lo: np.ndarray, hi: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Two names (64 and 32 bits) of the strings [lo, hi) of ``longest`` bytes
    at most: their length and the grams that tile them."""
    a = _mix((hi - lo).astype(U) * _M2)
    b = a * _M3
    for step in range(0, longest, GRAM):
        g = grams[np.minimum(lo + step, hi - GRAM)]
        a = _mix(a * _M1 + g)
        b = _mix(b * _M3 + (g ^ _M2))
    return a, (b >> U(32)).astype(np.uint32)


def spread(names: np.ndarray) -> np.ndarray:
    """Names anew, over the whole range: those of anchors are small ones."""
    return _mix(names * _M3)


def anchors(grams: np.ndarray, windows: int, width: int) -> np.ndarray:
    """For each of ``windows`` window starts, the start of its smallest-named
    gram (leftmost of equals); a window holds ``width`` grams."""
    key = (grams[: windows + width - 1] & U(0xFFFFFFFF00000000)) | np.arange(windows + width - 1, dtype=U)
    h = 1
    while h < width:
        step = min(h, width - h)
        key = np.minimum(key[: len(key) - step], key[step:])
        h += step
    return (key & U(0xFFFFFFFF)).astype(np.int64)
