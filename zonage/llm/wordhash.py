"""Hashes of the words of many texts at once, without a loop over words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

SECTION = 1 << 16      # bytes whose words are hashed together; they fit a core's cache
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_SPACE_BYTE = re.compile(rb"[\x09-\x0D\x20]")
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of the base, and of its inverse


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            step = np.full(n, base, np.uint64)
            step[0] = 1
            _powers[k] = np.cumprod(step)
    return _powers


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word (what ASCII white space divides) of
    lower-cased bytes.  A word's hash is a polynomial in its bytes, taken from
    one running sum over all bytes."""
    word = np.concatenate([[False], ~_SPACE[raw], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _power(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power[:len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts]), starts, ends


def sections(text: bytes) -> Iterator[bytes]:
    """A long text in sections cut at white space."""
    at = 0
    while len(text) - at > SECTION:
        m = _SPACE_BYTE.search(text, at + SECTION)
        if m is None:
            break
        cut = m.start()
        yield text[at:cut]
        at = cut
    yield text[at:]
