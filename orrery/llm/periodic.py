"""Periodic runs of words within a document, by repeated k-gram masking and Main-Lorentz (operator 12).

A run is a stretch of words with smallest period q (words q apart are equal) of at least
``max(min_length, exponent * q)`` words that neither neighbour extends. Its words q apart overlap in
``length - q`` words, at least k = min over q of ``max(min_length, exponent * q) - q`` of them, so every word of a run lies in
a k-gram that the document repeats. Words outside all repeated k-grams are masked; the stretches between them are few in
most texts, and only these are searched, those of all documents of a batch at once:

Main-Lorentz: a stretch is halved again and again; a run crosses the middle of the smallest part that holds it. For every part
and every period that fits, the places ``middle`` and ``middle + q`` (or ``middle - q`` and ``middle``) are compared:
how far equal words reach to the right and to the left of them gives the run. A level's pairs of places are numpy arrays in
pieces of bounded size. Pairs without an equal k-gram around them are left out; the reach is found by
doubling steps over prefix hashes. Every run found is compared word by word; a stretch with a run that fails this (a collision) is
searched anew, period by period.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` and equal if their bytes are (by a 64-bit hash). A null or empty text,
or one without words, has no runs and an empty collapsed text. Texts have any length; a document is handled by one task, as it is one row.
Repeated rows get the same result each, an empty table gives an empty one; columns of ``docs`` keep their
values, whatever their names, but for those called as a result. A null id is like any other.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import flat_bytes, map_texts
from orrery.llm.words import EXACT, combine, mix, run_hashes, word_bounds

_BASE = 0x9E3779B97F4A7C15
#: Pairs of places that are compared at once.
PAIRS = 1 << 18
RESULT = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


@dataclass(frozen=True)
class Settings:
    min_length: int = 6
    exponent: int = 4  # repetitions of the period that a run has at least; 2 or more

    def needed(self, q):
        """Words that a run of period ``q`` has at least."""
        return np.maximum(self.min_length, self.exponent * q)

    @property
    def overlap(self) -> int:
        """Words that a run of any period has equal to those a period on, at least; at least one."""
        return max(1, min(int(self.needed(q)) - q for q in range(1, self.min_length + 1)))


def repeated_stretches(words: np.ndarray, firsts: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of words that lie in k-grams which their document repeats; ``firsts`` are the documents' first words and the end."""
    k, n = s.overlap, len(words)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    whole = np.flatnonzero(doc[: n - k + 1] == doc[k - 1 :])
    key = mix(combine(words, k)[whole] ^ (doc[whole].astype(np.uint64) * np.uint64(_BASE)))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    again = np.r_[same, False] | np.r_[False, same]
    covered = np.zeros(n + 1, bool)
    at = whole[order[again]]
    for j in range(k):
        covered[at + j] = True
    edge = np.zeros(n + 1, bool)
    edge[firsts] = True
    before = np.r_[False, covered[:-1]]
    starts = np.flatnonzero(covered & (~before | edge))
    ends = np.flatnonzero(before & (~covered | edge))
    long = ends - starts >= s.min_length
    return starts[long], ends[long]


def _reach(limit: np.ndarray, same) -> np.ndarray:
    """The largest number of words up to ``limit`` for which ``same(rows, number)`` holds, by doubling steps."""
    out = np.zeros(len(limit), np.int64)
    step = 1 << (int(limit.max(initial=0)).bit_length())
    while step := step >> 1:
        rows = np.flatnonzero(out + step <= limit)
        rows = rows[same(rows, out[rows] + step)]
        out[rows] += step
    return out


class _Words:
    """Words with prefix hashes and k-grams, to compare stretches of them."""

    def __init__(self, words: np.ndarray, k: int) -> None:
        self.words, self.k, self.grams = words, k, combine(words, k)
        self.power = np.full(len(words) + 1, _BASE, np.uint64)
        self.power[0] = 1
        np.cumprod(self.power, out=self.power)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * self.power[:-1], out=self.sums[1:])

    def equal(self, at: np.ndarray, period: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` words from ``at`` on are those a period later."""
        left = self.sums[at + n] - self.sums[at]
        return left * self.power[period] == self.sums[at + period + n] - self.sums[at + period]

    def near(self, at: np.ndarray, period: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Whether some k-gram over ``at``, within the stretch, is there again a period later."""
        out = np.zeros(len(at), bool)
        for d in range(self.k):
            x = at - d
            rows = np.flatnonzero((x >= lo) & (x + period + self.k <= hi) & ~out)
            out[rows] = self.grams[x[rows]] == self.grams[x[rows] + period[rows]]
        return out


def _crossing(w: _Words, mid: np.ndarray, lo: np.ndarray, hi: np.ndarray, periods: np.ndarray, s: Settings) -> list[np.ndarray]:
    """``start, end, period`` of runs over the middles ``mid``, of periods up to ``periods``, within ``lo`` to ``hi``; in pieces."""
    ends = np.cumsum(periods)
    found = []
    for a in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        pair = np.arange(a, min(a + PAIRS, int(ends[-1])))
        node = np.searchsorted(ends, pair, side="right")
        q = pair - (ends[node] - periods[node]) + 1
        for back in (0, 1):
            at = mid[node] - back * q
            rows = np.flatnonzero((at >= lo[node]) & (at + q < hi[node]))
            rows = rows[w.words[at[rows]] == w.words[at[rows] + q[rows]]]
            x, p, of = at[rows], q[rows], node[rows]
            rows = np.flatnonzero(w.near(x, p, lo[of], hi[of]))
            x, p, of = x[rows], p[rows], of[rows]
            right = _reach(hi[of] - x - p, lambda r, n, x=x, p=p: w.equal(x[r], p[r], n))
            left = _reach(x - lo[of], lambda r, n, x=x, p=p: w.equal(x[r] - n, p[r], n))
            rows = np.flatnonzero(left + right + p >= s.needed(p))
            found.append(np.stack([x - left, x + p + right, p], 1)[rows])
    return found


def _plain(words: np.ndarray, s: Settings) -> np.ndarray:
    """As ``main_lorentz`` of one stretch, period by period: exact, for stretches with colliding hashes."""
    found = []
    for q in range(1, len(words) // s.exponent + 1):
        same = np.r_[False, words[:-q] == words[q:], False]
        starts, ends = np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])
        long = ends - starts + q >= s.needed(q)
        found.append(np.stack([starts[long], ends[long] + q, np.full(long.sum(), q)], 1))
    return _smallest(found)


def _smallest(found: list[np.ndarray]) -> np.ndarray:
    """Of equal stretches the one with the smallest period, by start, then period (multiples of a run's period give the same stretch)."""
    rows = np.concatenate([*found, np.zeros((0, 3), np.int64)]).astype(np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    rows = rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)][: len(rows)]]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def main_lorentz(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, s: Settings) -> np.ndarray:
    """Rows ``start, end, period`` of all runs within the stretches of ``words`` (64-bit hashes) from ``starts`` to ``ends``, by start and period."""
    sizes = ends - starts
    seg_hi = np.cumsum(sizes)
    seg_lo = seg_hi - sizes
    shift = np.repeat(starts - seg_lo, sizes)
    w = _Words(words[np.arange(len(shift)) + shift], s.overlap)
    found, lo, hi, of = [], seg_lo, seg_hi, np.arange(len(starts))
    while len(lo):
        mid = (lo + hi) // 2
        found += _crossing(w, mid, seg_lo[of], seg_hi[of], (hi - lo) // s.exponent, s)
        lo, hi, of = np.r_[lo, mid], np.r_[mid, hi], np.r_[of, of]
        long = hi - lo >= s.min_length
        lo, hi, of = lo[long], hi[long], of[long]
    rows = _smallest(found)
    for at in {int(np.searchsorted(seg_hi, a, side="right")) for a, b, q in rows.tolist() if not np.array_equal(w.words[a : b - q], w.words[a + q : b])}:
        again = _plain(w.words[seg_lo[at] : seg_hi[at]], s) + [seg_lo[at], seg_lo[at], 0]
        rows = _smallest([rows[(rows[:, 0] < seg_lo[at]) | (rows[:, 0] >= seg_hi[at])], again])
    if len(rows):
        rows[:, :2] += shift[rows[:, 0]][:, None]
    return rows


def find(column: pa.Array, s: Settings = Settings()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of all texts of a column as rows ``start, end, period`` over the words of the whole column, the texts' first words, and the row offsets of their runs."""
    raw, offsets = flat_bytes(column)
    starts, ends, firsts = word_bounds(raw, offsets)
    words = run_hashes(raw, starts, ends, EXACT)
    rows = main_lorentz(words, *repeated_stretches(words, firsts, s), s)
    return rows, firsts, np.searchsorted(rows[:, 0], firsts)


def _collapsed(text: str | None, runs: np.ndarray, first: int) -> str:
    """The words joined by one space, without those that a run holds after its first period."""
    words = (text or "").encode().split()  # bytes split at exactly the separators of words
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] - first + runs[:, 2], 1)
        np.add.at(change, runs[:, 1] - first, -1)
        words = compress(words, (np.cumsum(change[:-1]) == 0).tolist())
    return b" ".join(words).decode()


def periodic_runs(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``runs`` (start word, length and period, by start, then period) and ``collapsed``, the text without repetitions."""

    def make():
        def compute(column):
            rows, firsts, upto = find(column, settings)
            starts = rows[:, 0] - firsts[np.searchsorted(firsts, rows[:, 0], side="right") - 1]
            parts = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (starts, rows[:, 1] - rows[:, 0], rows[:, 2])], names=["start", "length", "period"])
            texts = [_collapsed(t, rows[upto[i] : upto[i + 1]], firsts[i]) for i, t in enumerate(column.to_pylist())]
            return [pa.ListArray.from_arrays(pa.array(upto, pa.int32()), parts), pa.array(texts, pa.string())]

        return compute

    return map_texts(docs, text_col, make, RESULT, keep)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document the number of runs, the longest (ties: smallest start, then period; null without runs), and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    lines: Column = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    out = found.select(id_col, "runs", "collapsed", best.alias("best"))
    return out.select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
