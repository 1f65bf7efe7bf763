"""Words and shingles of UTF-8 texts as 64-bit hashes, computed on flat numpy arrays.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; A-Z count as a-z. Each byte has a
random 64-bit value; a word's hash is the polynomial of its bytes' values, mixed.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: For words without punctuation: all ASCII but letters and digits separates.
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
EXACT = _VALUES.copy()  # for hashes that tell A-Z from a-z
_VALUES[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_PIECE = 1 << 20
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, _PIECE + 1)
        up, down = np.full(size, _P, np.uint64), np.full(size, _P_INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers[0], _powers[1]


def _alone(raw: np.ndarray) -> np.ndarray | None:
    """Where a code point of a script without blanks begins: Thai, Lao, Burmese, Khmer, kana, ideographs; None if nowhere."""
    if not (raw >= 0xE0).any():
        return None
    then = np.r_[raw[1:], np.uint8(0)]
    out = (raw >= 0xE3) & (raw <= 0xE9)
    out |= (raw == 0xE0) & (then >= 0xB8) & (then <= 0xBB)
    out |= (raw == 0xE1) & ((then <= 0x82) & (then >= 0x80) | (then == 0x9E) | (then == 0x9F))
    out |= (raw == 0xEF) & (then >= 0xA4) & (then <= 0xAB)
    out |= (raw == 0xF0) & (then >= 0xA0) & (then <= 0xB3)
    return out if out.any() else None


def unit_bounds(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``word_bounds``, but each code point of a script without blanks is a word of its own."""
    starts, ends, firsts = word_bounds(raw, offsets, separators)
    alone = _alone(raw)
    if alone is None:
        return starts, ends, firsts
    at = np.flatnonzero(alone)
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    edge[np.minimum(at + np.where(raw[at] >= 0xF0, 4, 3), len(raw))] = True  # of the next code point
    edge[starts] = edge[ends] = False
    cuts = np.flatnonzero(edge)
    cuts = cuts[np.searchsorted(starts, cuts, side="right") > np.searchsorted(ends, cuts, side="right")]  # inside a word
    starts, ends = np.sort(np.r_[starts, cuts]), np.sort(np.r_[ends, cuts])
    return starts, ends, np.searchsorted(starts, offsets)


def word_bounds(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each text the number of its first word."""
    inside = ~separators[raw]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    if len(raw):
        before[0] = after[-1] = False
    before[edges] = False
    after[edges - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and for each text the number of its first word."""
    starts, ends, firsts = word_bounds(raw, offsets, separators)
    return run_hashes(raw, starts, ends), firsts


def run_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _VALUES) -> np.ndarray:
    """Hash of each run of bytes from a start to its end."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # pieces of whole words, so that memory stays bounded in a long text
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + _PIECE, side="right")))
        piece = raw[base : ends[to - 1]]
        up, down = _tables(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * up[: len(piece)], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


_STEPS = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (order counts)."""
    out = np.full(max(0, len(hashes) - n + 1), n, np.uint64)
    for k in range(n):
        out += hashes[k : k + len(out)] * _STEPS[k % 64]
        out = mix(out)
    return out


def shingle_sets(hashes: np.ndarray, firsts: np.ndarray, n: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``n``-word shingles.

    A text of 1 to n-1 words has its whole word sequence as its one shingle; one without words has none.
    """
    runs, out = combine(hashes, n), []
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        elif b > a:
            out.append(combine(hashes[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
