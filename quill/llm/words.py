"""Words of a byte buffer as numpy arrays, without a Python object per word.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D. Its 64-bit hash is
a polynomial over random byte values modulo 2**64: prefix sums of
``value[byte] * P**position`` give every word's sum by one subtraction, and a
multiplication with ``P**-start`` removes the position. A final mixing step
spreads the bits.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_MASK = (1 << 64) - 1
P = 0x9E3779B97F4A7C15 | 1
P_INV = pow(P, -1, 1 << 64)
M1 = _U(0xBF58476D1CE4E5B9)
M2 = _U(0x94D049BB133111EB)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply rounds)."""
    x = x ^ (x >> _U(30))
    x *= M1
    x ^= x >> _U(27)
    x *= M2
    x ^= x >> _U(31)
    return x


VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(P))
FOLDED = VALUES.copy()
FOLDED[65:91] = VALUES[97:123]        # A-Z hash as a-z

_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = 1 << max(12, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            a = np.full(size, P, np.uint64)
            a[0] = 1
            _pow = np.cumprod(a, dtype=np.uint64)
            a = np.full(size, P_INV, np.uint64)
            a[0] = 1
            _inv = np.cumprod(a, dtype=np.uint64)
    return _pow, _inv


def spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of a uint8 buffer."""
    pad = np.ones(len(buf) + 2, bool)
    pad[1:-1] = IS_SPACE[buf]
    edge = np.flatnonzero(pad[1:] != pad[:-1])
    return edge[0::2], edge[1::2]


def _hash_block(buf, starts, ends, table):
    pw, inv = _powers(len(buf))
    v = table[buf]
    v *= pw[: len(buf)]
    s = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(v, out=s[1:])
    return mix((s[ends] - s[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes, fold: bool = True, block: int = 1 << 18) -> np.ndarray:
    """uint64 hash of each word, in order. Long texts go block by block, cut
    between words, so the tables of powers stay small."""
    buf = np.frombuffer(text, np.uint8)
    starts, ends = spans(buf)
    table = FOLDED if fold else VALUES
    if not len(starts):
        return np.empty(0, np.uint64)
    if len(buf) <= block:
        return _hash_block(buf, starts, ends, table)
    out, i = [], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + block, side="right")))
        at = starts[i]
        out.append(_hash_block(buf[at:ends[j - 1]], starts[i:j] - at, ends[i:j] - at, table))
        i = j
    return np.concatenate(out)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words (empty when there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    s = h[:n].copy()
    for i in range(1, k):
        s *= _U(P)
        s ^= s >> _U(29)
        s += h[i:n + i]
    return mix(s)


def shingle_set(text: bytes, k: int = 5) -> np.ndarray:
    """Sorted distinct k-word shingle hashes of the A-Z folded text. With fewer
    words the whole sequence is the only one; without words the set is empty."""
    h = word_hashes(text, fold=True)
    if not len(h):
        return h
    s = windows(h, min(k, len(h)))
    if len(h) < k:          # its length keeps it apart from true shingles
        return mix(s + _U(len(h)))
    s.sort()
    return s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) > 1 else s
