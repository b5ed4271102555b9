"""numpy kernels on the bytes of many texts at once: words, polynomial hashes, window minima.

All hashes are polynomials modulo 2**64 (Rabin-Karp), so that the hash of any
byte range or any run of words is a difference of two prefix sums.  A word is
a maximal run of bytes other than 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
#: Bases (odd, 5 modulo 8: the longest period) of bytes and of words, one pair for each half of a 128-bit hash.
BYTE_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED05)
WORD_BASES = (0xA0761D6478BD642D, 0xE7037ED1A0B428DD)

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=16)
def _powers_to(base: int, log_n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full((1 << log_n) + 1, b, U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i = 0..n at least."""
    return _powers_to(base, max(10, int(n).bit_length()))


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(base, len(values))[0][: len(values)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hashes of the value ranges [start, end), independent of where they stand."""
    return mix((sums[end] - sums[start]) * powers(base, len(sums))[1][start])


def words(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each text's first word (texts + 1).

    ``separator`` tells for each of the 256 bytes whether it stands between words.
    """
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    sep = separator[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    before = np.concatenate(([True], sep[:-1])) | first[:-1]
    after = np.concatenate((sep[1:], [True])) | first[1:]
    start = np.flatnonzero(~sep & before)
    end = np.flatnonzero(~sep & after) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, half: int = 0) -> np.ndarray:
    base = BYTE_BASES[half]
    return range_hash(prefix_sums(data.astype(U) + U(1), base), start, end, base) + (end - start).astype(U)


def window_hashes(hashes: np.ndarray, size: int, half: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (runs may cross texts; callers drop those)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    base = WORD_BASES[half]
    at = np.arange(n)
    return range_hash(prefix_sums(hashes, base), at, at + size, base)


def inside(text_starts: np.ndarray, size: int) -> np.ndarray:
    """For each run of ``size`` positions: does it lie in one text?  ``text_starts`` has texts + 1 entries."""
    total = int(text_starts[-1])
    n = total - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    crossing = np.zeros(total + 1, np.int64)
    lo = np.maximum(text_starts[:-1] - size + 1, 0)
    np.add.at(crossing, lo[text_starts[:-1] > 0], 1)
    np.add.at(crossing, text_starts[:-1][text_starts[:-1] > 0], -1)
    return np.cumsum(crossing)[:n] == 0


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each run of ``size`` values, by doubling."""
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out
