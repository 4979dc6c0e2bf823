"""Vectorised word finding and hashing over the UTF-8 bytes of many texts.

All functions take one segment: the concatenated bytes of its texts and their
``len + 1`` offsets.  Words are maximal runs of bytes of a class; a class is a
256-entry table, so classes of ASCII characters plus "all non-ASCII" are exact
on UTF-8.  Hashes are 64-bit and lower-case A-Z.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_MUL = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INV = U(pow(int(_MUL), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads all bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U) + U(seed * 1_000_003)) * _MUL)


_BYTES = constants(256, 7)
_BYTES[65:91] = _BYTES[97:123]

#: Byte classes: anything but ASCII white space; ASCII letters, digits and all non-ASCII.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def powers(n: int, kind: str = "up") -> np.ndarray:
    """``_MUL ** i`` (or of its inverse) for i below ``n``, kept between calls
    up to a bound."""
    have = _powers[kind]
    if len(have) < n:
        base = np.full(max(n, 1 << 20) + 1, _MUL if kind == "up" else _INV, U)
        base[0] = 1
        have = np.multiply.accumulate(base)
        if len(have) <= 1 << 23:
            _powers[kind] = have
    return have[:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``value[i] * _MUL**i``: the basis of window hashes."""
    out = np.empty(len(values) + 1, U)
    out[0] = 0
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


def window_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``[start, end)``, the same wherever equal content stands."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), "down")[start])


def word_bounds(raw: np.ndarray, off: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each text the index of its
    first word (``len + 1`` entries); words never span texts."""
    inside = cls[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    before = np.empty(len(raw), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(raw), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return window_hash(prefix_hash(_BYTES[raw]), start, end)
