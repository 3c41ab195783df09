"""Vectorised byte, word and shingle hashing over whole texts (numpy, one pass per batch).

Every function works on one UTF-8 buffer at a time; memory is a small multiple of the
text's own bytes.  Hashes are 64-bit: polynomial over a random byte table, finished with
an avalanche mix.  A polynomial modulo 2^64 has equal values for some texts of 1,024 bytes and more that were
made to (Thue-Morse words), so words of over LONG_WORD bytes are named by blake2b instead, and `range_hash` is for
ranges under 1,024 bytes.  Hashes name buckets and shingles; what is decided on names alone, and on how many bits of
them, each operator says.
"""

from __future__ import annotations

import hashlib

import numpy as np

#: Longer words are hashed by blake2b.
LONG_WORD = 256

_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
_BYTE_TABLES = np.random.RandomState(20240229).randint(1, 2**63 - 1, size=(2, 256)).astype(np.uint64)
_WORD_SALTS = np.random.RandomState(77).randint(1, 2**63 - 1, size=64).astype(np.uint64) | np.uint64(1)

#: ASCII white space as in the class [\x20\x09-\x0D].
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class _Cache(dict):
    """Powers by kind; pickled empty, so that tasks stay small."""

    def __reduce__(self):
        return _Cache, ()


_powers = _Cache()


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        step = np.full(size, base & (2**64 - 1), dtype=np.uint64)
        step[0] = 1
        have = np.multiply.accumulate(step)
        if size <= 1 << 22:  # longer ones are not kept
            _powers[kind] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (in a new array)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_sums(data: np.ndarray, table: int = 0) -> np.ndarray:
    """Prefix polynomial sums; range_hash turns two of them into the hash of a byte range."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_TABLES[table][data] * _power("up", _MULT, len(data)), out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], the same wherever those bytes stand."""
    with np.errstate(over="ignore"):
        raw = (sums[end] - sums[start]) * _power("down", _INV, len(sums))[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, outside: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes that are not `outside`."""
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~outside[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray, outside: np.ndarray = IS_SPACE) -> np.ndarray:
    starts, ends = word_spans(data, outside)
    out = range_hash(prefix_sums(data), starts, ends)
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the windows of `width` consecutive word hashes (none if there are fewer)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            total += words[k : k + n] * _WORD_SALTS[k]
        return mix(total)
