"""Vectorised work on the UTF-8 bytes of Arrow string columns: words, substring hashes, mixing.

A substring's hash is a polynomial over random byte values modulo 2**64, taken from prefix sums and
then mixed; equal bytes give equal hashes wherever they stand, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
WORD_SPACES = np.zeros(256, dtype=bool)
WORD_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BASE = U(0x9E3779B97F4A7C55)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C55, -1, 1 << 64))
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
_LOWERED = _VALUES.copy()
_LOWERED[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; works on a copy."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16 if have is None else 2 * len(have))
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        have = _powers[name] = np.multiply.accumulate(factors)
    return have


class Substrings:
    """Hashes of substrings of one byte buffer."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        n = len(data)
        terms = (_LOWERED if lower else _VALUES)[data]
        terms *= _power_table("up", BASE, n + 1)[:n]
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.inverse = _power_table("down", BASE_INVERSE, n + 1)

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self.sums[ends] - self.sums[starts]
        out *= self.inverse[starts]
        out += (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93)
        return mix(out)


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _valid, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def blocks(data: np.ndarray, offsets: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts with about ``limit`` bytes: first, last + 1, bytes, offsets in them."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray = WORD_SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of several texts, and where each text's words begin in them.
    ``spaces``: by byte, what lies between words."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    solid = ~spaces[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    filled = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    first[heads] = solid[heads]
    last[tails] = solid[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Per text the sorted hashes of its distinct ``size``-word shingles (A-Z lowered); a shorter
    text gives its whole word sequence as one; no words, none."""
    starts, ends, at = words(data, offsets)
    if not len(starts):
        return [np.zeros(0, dtype=np.uint64)] * (len(offsets) - 1)
    one = Substrings(data, lower=True).hash(starts, ends)
    total = one.copy()
    for j in range(1, size):
        total[: len(one) - j] += mix(one[j:] + U(j)) if len(one) > j else U(0)
    total = mix(total)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= size:
            got = np.sort(total[a : b - size + 1])
            out.append(got[np.concatenate(([True], got[1:] != got[:-1]))])
        elif b > a:
            whole = one[a : a + 1].copy()
            for j in range(1, b - a):
                whole += mix(one[a + j : a + j + 1] + U(j))
            out.append(mix(whole + U(b - a)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
