"""Quality classifier: an interpolated modified Kneser-Ney word trigram model of trusted text (operator 8).

Tokens are runs of letters, digits and non-ASCII bytes, and runs of other ASCII bytes but white space; case counts.
The trigrams of trusted documents are counted, sharded by n-gram: raw counts at the highest order,
continuation counts below, three discounts an order from the counts of counts. The lowest order is interpolated
with equal chances of the known tokens and one more, which is the estimate of an unknown token.

The job is done in rounds, each over the trigrams of its share of the middle words. A trigram ``abc`` needs the counts of ``abc``, ``ab``, ``bc``, ``b`` and ``c``.
A round deals learnt trigrams and those that texts ask for by ``b``, or by ``b`` and ``a`` where ``b`` fills much of a part (it has several ways); so all that is learnt of ``abc`` and ``ab`` meets what is
asked. That of ``bc`` does too, or where ``b`` has several ways is counted once before the rounds and sent to each of them. Words are ranks among the ``head`` most frequent ones,
whose counts are broadcast, or their own codes; a rare word's counts are sent to the part of its n-grams, and a trigram that ends with one goes through a second exchange for the count of ``c``. There sums of log probabilities by text meet as well.
Messages from task to part are columns of bytes, compressed. What is asked passes a part in pieces. Before the rounds all is counted once, for the discounts and
the words' counts. A round reads and tokenises all texts again, and its shuffles are deleted when it ends.

A model of words knows the text it learnt from far too well. So it learns from the trusted documents outside the
held-out fold, and a document is kept if its perplexity per token is at most the ``quantile`` of the held-out trusted
documents of its language. Where either part is empty, all trusted documents stand in for it.

Defined results: a null text, or one without tokens, has no perplexity and isn't kept. A language without held-out trusted
documents, or none, has the threshold of all held-out trusted documents; without trusted text nothing has a
perplexity and nothing is kept. Rows that share an id are scored separately. An empty table
gives an empty one; texts have any length, and other columns aren't read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import collected, drop_scratch, flat_bytes, fold, session_setting, ship, text_slices, written
from orrery.llm.hashtable import HashTable
from orrery.llm.words import _SPACE, EXACT, NOT_ALNUM, mix, run_hashes


@dataclass(frozen=True)
class Settings:
    head: int = 1 << 18  # most frequent words, whose n-grams are dealt by pairs of words
    shards: int = 5  # most rounds, each over the trigrams of its share of the middle words
    shard_bytes: int = 32 << 20  # text for which a round more is made
    more_shards: int = 3  # most rounds more, one for each 32 parts of a round: with many parts each token of a text goes alone, with its row's number
    part_bytes: int = 48 << 20  # text whose trigrams one part of a round is asked for
    learnt_bytes: int = 8 << 20  # text whose trigrams one part of a round learns
    count_shards: int = 2  # most rounds of counting
    count_bytes: int = 4 << 20  # text whose trigrams one part of a round counts
    bits: int = 28  # of a bitmap that is no longer made; kept for callers that name it
    quantile: float = 0.99
    broadcast_ids: int = 500_000  # trusted ids up to this number are broadcast; beyond it they are joined by a shuffle


#: The multipliers of XXH64.
_XX = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
_LONG, _CACHED, _FULL = 32, 1 << 18, np.uint64(0xFFFFFFFFFFFFFFFF)
_KIND = np.where(_SPACE, 0, np.where(NOT_ALNUM, 2, 1)).astype(np.uint8)
_START, _END = np.uint64(1), np.uint64(2)
_WORD, _HALF = 42, 21  # bits of a token; a trigram is two longs: a and half of b, half of b and c
_LOW_WORD, _LOW_HALF = (1 << _WORD) - 1, (1 << _HALF) - 1


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code of each token, and for each text the number of its first one."""
    kind = _KIND.take(raw)
    edge = np.ones(len(raw) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    inside = kind > 0
    starts, ends = np.flatnonzero(edge[:-1] & inside), np.flatnonzero(edge[1:] & inside) + 1
    return _hashes(raw, starts, ends) & np.uint64(_LOW_WORD), np.searchsorted(starts, offsets)


def _hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes, eight bytes at a time; of long ones as elsewhere."""
    words = np.zeros(len(raw) // 8 + 2, np.uint64)
    words.view(np.uint8)[: len(raw)] = raw
    sizes = ends - starts
    out = sizes.astype(np.uint64)
    at, begin, size = slice(None), starts, sizes
    for step in range(0, _LONG, 8):
        if step:
            at = np.flatnonzero((sizes > step) & (sizes <= _LONG))
            begin, size = starts[at] + step, sizes[at] - step
        place, shift = begin >> 3, (begin & 7).astype(np.uint64) << np.uint64(3)
        value = words[place] >> shift | words[place + 1] << np.uint64(1) << (np.uint64(63) - shift)
        value &= _FULL >> ((8 - np.minimum(size, 8)).astype(np.uint64) << np.uint64(3))
        out[at] = mix(out[at] * _XX[0] + value)
    at = np.flatnonzero(sizes > _LONG)
    out[at] = run_hashes(raw, starts[at], ends[at], EXACT)
    return out


@dataclass(frozen=True)
class Split:
    """Words to shards: by a hash, but the last shards have a word of their own."""

    shards: int = 1
    salt: int = 0
    own: tuple[int, ...] = ()

    def of(self, words: np.ndarray) -> np.ndarray:
        hashed = self.shards - len(self.own)
        out = ((words * np.uint64(2 * self.salt + 1) & np.uint64(0xFFFFFFFF)) * np.uint64(hashed) >> np.uint64(32)).astype(np.int32)
        for i, word in enumerate(self.own, start=hashed):
            out[words == np.uint64(word)] = i
        return out


def even_split(words: np.ndarray, counts: np.ndarray, shards: int) -> Split:
    """Words that fill half of an even shard get one of their own, at most half of the shards; the hash is the best of a few. ``words`` by falling counts."""
    own = words[: shards // 2][counts[: shards // 2] * 2 * shards >= counts.sum()] if shards > 1 else words[:0]
    splits = [Split(shards, salt, tuple(own.tolist())) for salt in range(64 if shards > 1 else 1)]
    return min(splits, key=lambda x: _sum(x.of(words), counts, shards).max())


def _grams(column: pa.Array, split: Split = Split(), taken: range = range(1)) -> tuple[np.ndarray, ...]:
    """For each prediction after a word of the shards ``taken`` its text, and the words ``a, b, c`` of its trigram."""
    codes, firsts = tokens(*flat_bytes(column))
    sizes = np.diff(firsts)
    some = np.flatnonzero(sizes)
    begins = np.r_[0, np.cumsum(sizes[some] + 3)]
    seq = np.full(begins[-1], _START, np.uint64)
    seq[np.arange(len(codes)) + np.repeat(3 * np.arange(len(some)) + 2, sizes[some])] = codes
    seq[begins[1:] - 1] = _END
    here = np.ones(len(seq), bool)
    here[begins[:-1]] = here[begins[:-1] + 1] = False
    if split.shards > 1:
        shard = split.of(seq[:-1])
        here[1:] &= (shard >= taken.start) & (shard < taken.stop)
    at = np.flatnonzero(here)
    return some[np.searchsorted(begins, at, side="right") - 1], seq[at - 2], seq[at - 1], seq[at]


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def _xx64(values: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of 8-byte integers, as Spark's ``xxhash64`` has it."""
    h = _turned(values * _XX[1], 31) * _XX[0] ^ (seed + (_XX[4] + np.uint64(8)))
    h = _turned(h, 27) * _XX[0] + _XX[3]
    h = (h ^ h >> np.uint64(33)) * _XX[1]
    h = (h ^ h >> np.uint64(29)) * _XX[2]
    return h ^ h >> np.uint64(32)


def _key(order: int, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """``xxhash64(order, hi, lo)`` of longs."""
    seed = _xx64(np.array([order], np.uint64), np.array([42], np.uint64))
    return _xx64(lo, _xx64(np.atleast_1d(hi), seed))


def _flagged(docs: DataFrame, trusted: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, text, lang, trusted``."""
    ids = trusted.select(F.col("doc_id").alias("t_id")).where("t_id is not null").distinct()
    if ids.limit(s.broadcast_ids + 1).count() <= s.broadcast_ids:
        ids = F.broadcast(ids)
    return docs.select("doc_id", "text", "lang").join(ids, F.col("doc_id") == F.col("t_id"), "left").select("doc_id", "text", "lang", F.col("t_id").isNotNull().alias("trusted"))


def discounts(counts_of_counts: dict[int, int]) -> tuple[float, float, float]:
    """D1, D2, D3+ of modified Kneser-Ney, kept within (0, count); 0.5 each where the estimate lacks counts."""
    n = [counts_of_counts.get(i, 0) for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else None
    out = []
    for i in range(3):
        d = i + 1 - (i + 2) * y * n[i + 1] / n[i] if y is not None and n[i] else 0.5
        out.append(min(max(d, 0.05), i + 0.95))
    return tuple(out)


#: Lists of a message, from one task to one part. ``runs`` are the lengths of stretches of one text, ``rows`` their texts.
_LISTS = {"a": np.uint64, "b": np.uint64, "c": np.uint64, "n": np.int64, "d": np.float64, "e": np.float64, "rows": np.int64, "runs": np.int32}
_IDS = ("a", "b", "c")
_SENT = "part int, tag int, data binary"
_LEARNT, _PAIRS, _WORDS, _ASKED, _SUMS = range(5)  # tags, in the order in which a part reads them
_COUNTED = "kind int, w bigint, c bigint, total bigint, n1 bigint, n2 bigint, n3 bigint, raw bigint"
_TAIL = np.uint64(1 << _WORD)  # of the id of a word outside the head, which is its code; others' is their rank
_RARE = np.uint64((1 << 24) - 1)  # stands for such a word among ranks
_ZSTD = pa.Codec("zstd", 1)
_AT_ONCE = 1 << 19  # trigrams that a task deals at once
_KEYS = 1 << 18  # sums that a task holds at least before it sends them


def _planes(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of each value, all first bytes before all second ones: so ranks and counts compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize)[:, :width].T).reshape(-1)


def _values(planes: np.ndarray, width: int, kind) -> np.ndarray:
    out = np.zeros((len(planes) // width, np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = planes.reshape(width, -1).T
    return out.reshape(-1).view(kind)


def _packed(lists: dict[str, np.ndarray]) -> bytes:
    """Lists as bytes: ids as three bytes of rank, with the codes of rare words apart."""
    sizes, out = [], []
    for name, kind in _LISTS.items():
        values = np.ascontiguousarray(lists.get(name, ()), kind)
        pieces = [(np.minimum(values, _RARE), 3), (values[values >= _TAIL], 6)] if name in _IDS else [(values, values.itemsize)]
        for x, width in pieces:
            sizes.append(len(x))
            out.append(_planes(x, width))
    raw = np.concatenate([np.array(sizes, np.int32).view(np.uint8), *out])
    return np.int64(len(raw)).tobytes() + _ZSTD.compress(raw, asbytes=True)


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    raw = np.frombuffer(_ZSTD.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little")), np.uint8)
    count = len(_LISTS) + len(_IDS)
    sizes, at, out = iter(raw[: 4 * count].view(np.int32).tolist()), 4 * count, {}

    def next_values(width: int, kind) -> np.ndarray:
        nonlocal at
        begin, at = at, at + next(sizes) * width
        return _values(raw[begin:at], width, kind)

    for name, kind in _LISTS.items():
        if name in _IDS:
            out[name] = next_values(3, np.uint64)
            rare = next_values(6, np.uint64)
            out[name][out[name] == _RARE] = rare | _TAIL
        else:
            out[name] = next_values(np.dtype(kind).itemsize, kind)
    return out


def _dealt(part: np.ndarray, tag: int, rows: np.ndarray | None = None, **lists: np.ndarray) -> pa.RecordBatch:
    """A row for each part, with its elements of ``lists`` in their order."""
    part = part.astype(np.uint16)  # sorted by radix
    order = np.argsort(part, kind="stable")
    part = part[order]
    at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
    ends = np.r_[at, len(part)]
    lists = {k: v[order] for k, v in lists.items()}
    if rows is not None:
        rows = rows[order]
        new = np.r_[True, rows[1:] != rows[:-1]] if len(rows) else np.zeros(0, bool)
        new[at] = True
        starts = np.flatnonzero(new)
        cut, rows, runs = np.searchsorted(starts, ends), rows[starts], np.diff(np.r_[starts, len(rows)])
    data = []
    for i, (x, y) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        own = {k: v[x:y] for k, v in lists.items()}
        data.append(_packed(own if rows is None else own | {"rows": rows[cut[i] : cut[i + 1]], "runs": runs[cut[i] : cut[i + 1]]}))
    return pa.RecordBatch.from_arrays([pa.array(part[at].astype(np.int32)), pa.array(np.full(len(at), tag, np.int32)), pa.array(data, pa.binary())], ["part", "tag", "data"])


def _exchange(sent: DataFrame) -> DataFrame:
    return sent.repartition("part").sortWithinPartitions("part", "tag")


def _work(batches: Iterator[pa.RecordBatch], build, answer) -> Iterator[pa.RecordBatch]:
    """For each part ``build(lists by tag)``, a state and what it sends, then ``answer(state, asked, tag)``; what is asked passes in pieces."""
    now, kept, state = None, {}, None

    def built():
        joined = {t: {k: np.concatenate([np.zeros(0, kind), *(x.pop(k) for x in kept.get(t, ()))]) for k, kind in _LISTS.items()} for t in (_LEARNT, _PAIRS, _WORDS)}
        kept.clear()
        return build(joined)

    for batch in batches:
        for part, tag, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if part != now:
                if now is not None and state is None:
                    yield from built()[1]
                now, state = part, None
                kept.clear()
            lists = _unpacked(data.as_py())
            if tag < _ASKED:
                kept.setdefault(tag, []).append(lists)
                continue
            if state is None:
                state, sends = built()
                yield from sends
            yield from answer(state, lists, tag)
    if now is not None and state is None:
        yield from built()[1]


class _Index:
    """Places of hashes among sorted distinct ones, by their first bits; of an absent one their number."""

    def __init__(self, keys: np.ndarray) -> None:
        self.n, bits = len(keys), max(len(keys).bit_length(), 1)
        self.keys, self.shift = np.r_[keys, _FULL], np.uint64(64 - bits)
        self.starts = np.r_[0, np.cumsum(np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits))].astype(np.int32)

    def find(self, asked: np.ndarray) -> np.ndarray:
        at = self.starts[asked >> self.shift]
        found = self.keys[at]
        todo = np.flatnonzero(found < asked)
        while len(todo):
            at[todo] += 1
            found[todo] = now = self.keys[at[todo]]
            todo = todo[now < asked[todo]]
        at[found != asked] = self.n
        return at


def _pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Key of a pair of words."""
    return mix(mix(x * _XX[0] + _XX[1]) + y * _XX[2])


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, an order that sorts all, and where in it each distinct one begins."""
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[at], order, at


def _sums(values: np.ndarray, order: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values[order], at) if len(at) else values[:0]


def _sum(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, values, n)


def _trigrams(learnt: dict) -> tuple[np.ndarray, ...]:
    """``key, a, b, c, count`` of distinct trigrams, by key."""
    keys, order, at = _grouped(_pair(_pair(learnt["a"], learnt["b"]), learnt["c"]))
    first = order[at]
    return keys, learnt["a"][first], learnt["b"][first], learnt["c"][first], _sums(learnt["n"], order, at)


def _to_part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of each hash, by bits that an index among a part's hashes doesn't begin with."""
    return (keys & np.uint64(0xFFFFFFFF)) * np.uint64(parts) >> np.uint64(32)


def _at(ids: np.ndarray, of_head: np.ndarray) -> np.ndarray:
    """Place of each word in an array of the head's words and one element for all others."""
    return np.minimum(ids, np.uint64(len(of_head) - 1)).astype(np.int64)


def _own_part(a: np.ndarray, b: np.ndarray, ways: np.ndarray, parts: int) -> np.ndarray:
    """Part of trigrams by the middle word, of a word with several ``ways`` by the first word too."""
    return _to_part(_pair(b, (mix(a) >> np.uint64(32)) * ways[_at(b, ways)] >> np.uint64(32)), parts)


def _send(docs: DataFrame, split: Split, taken: range, part, head=None, ways=None, ask: bool = False) -> DataFrame:
    """Trigrams of ``docs (text, row, learnt)`` with a middle word of the shards ``taken``: counted if learnt, and if wanted each as a question.

    ``part(a, b, c)`` is their part. With ``ways`` and no questions, only those whose middle word has several ways.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = HashTable(head.value[0]) if head is not None else None

        def ids(words: np.ndarray) -> np.ndarray:
            place = table.find(words).astype(np.int64) if table is not None else np.full(len(words), -1)
            return np.where(place < 0, words | _TAIL, place.view(np.uint64))

        def dealt(batch: pa.RecordBatch, found: list[tuple]) -> Iterator[pa.RecordBatch]:
            row, a, b, c = (np.concatenate(x) for x in zip(*found, strict=True))
            learnt = np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False)[row])
            la, lb, lc = a[learnt], b[learnt], c[learnt]
            _, order, at = _grouped(_pair(_pair(la, lb), lc))
            first, n = order[at], np.diff(np.r_[at, len(order)])
            la, lb, lc = la[first], lb[first], lc[first]
            yield _dealt(part(la, lb, lc), _LEARNT, a=la, b=lb, c=lc, n=n)
            if ask:
                yield _dealt(part(a, b, c), _ASKED, rows=batch.column(1).to_numpy()[row], a=a, b=b, c=c)

        for batch in batches:
            found, size = [], 0
            for x, y in text_slices(batch.column(0), _CACHED):
                row, a, b, c = _grams(batch.column(0)[x:y], split, taken)
                b = ids(b)
                if ways is not None and not ask:
                    at = np.flatnonzero(ways.value[_at(b, ways.value)] > 1)
                    row, a, b, c = row[at], a[at], b[at], c[at]
                found.append((row + x, ids(a), b, ids(c)))
                size += len(row)
                if size > _AT_ONCE:
                    yield from dealt(batch, found)
                    found, size = [], 0
            if found:
                yield from dealt(batch, found)

    return docs.select("text", "row", "learnt").mapInArrow(run, _SENT)


def _send_words(words: DataFrame, columns: list[str], head, part, split: Split = Split(), taken: int = 0) -> DataFrame:
    """The words outside the head with up to two of their counts, to the part of their n-grams; those of one shard only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = HashTable(head.value[0])
        for batch in batches:
            w, *counts = (x.to_numpy() for x in batch.columns)
            w = w.view(np.uint64)
            at = np.flatnonzero((split.of(w) == taken) & (table.find(w) < 0))
            ids = w[at] | _TAIL
            yield _dealt(part(ids), _WORDS, a=ids, **{k: v[at] for k, v in zip(("n", "d"), counts, strict=False)})

    return words.select("w", *columns).mapInArrow(run, _SENT)


def _count(docs: DataFrame, shards: int, parts: int) -> DataFrame:
    """Counts of counts of trigrams (kind 3) and bigrams (kind 2); for each word (kind 1) its counts as the last word and as the first one of bigrams."""

    def build(kept: dict):
        _, _, b, c, c3 = _trigrams(kept[_LEARNT])
        _, order, at = _grouped(_pair(b, c))
        first, c2, raw = order[at], np.diff(np.r_[at, len(order)]), _sums(c3, order, at)
        w, at = np.unique(np.r_[b[first], c[first]], return_inverse=True)
        at_b, at_c = at[: len(first)], at[len(first) :]
        of = [np.bincount(at_c, minlength=len(w)), _sum(at_b, c2, len(w)), *(_sum(at_b, (c2 == i) if i < 3 else (c2 >= 3), len(w)) for i in (1, 2, 3)), _sum(at_b, raw, len(w))]
        rows = [np.ones(len(w)), (w ^ _TAIL).view(np.int64), *of]
        few = np.arange(1, 5)
        for kind, counts in ((2, c2), (3, c3)):
            more = [np.full(4, kind), few, np.bincount(np.minimum(counts, 5), minlength=6)[1:5], *[np.zeros(4)] * 5]
            rows = [np.r_[x.astype(np.int64), y.astype(np.int64)] for x, y in zip(rows, more, strict=True)]
        names = [x.split()[0] for x in _COUNTED.split(", ")]
        return None, [pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32) if i == 0 else x) for i, x in enumerate(rows)], names)]

    out = []
    for shard in range(shards):
        sent = _exchange(_send(docs, Split(shards), range(shard, shard + 1), lambda a, b, c: _to_part(_pair(b, c), parts)))
        counted = sent.mapInArrow(lambda batches: _work(batches, build, None), _COUNTED)
        out.append(written(counted.groupBy("kind", "w").agg(*(F.sum(x).alias(x) for x in ("c", "total", "n1", "n2", "n3", "raw"))), "counted"))
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    rows = written(rows.groupBy("kind", "w").agg(*(F.sum(x).alias(x) for x in ("c", "total", "n1", "n2", "n3", "raw"))), "counts")
    for done in out:
        drop_scratch(done)
    return rows


def _cuts(counts: DataFrame, kind: int) -> tuple[float, float, float]:
    if kind > 1:
        return discounts({r["w"]: r["c"] for r in counts.where(F.col("kind") == kind).collect()})
    return discounts({r["c"]: r["count"] for r in counts.where("kind = 1 and c between 1 and 4").groupBy("c").count().collect()})


def _pairs(docs: DataFrame, head, ways, parts: int) -> DataFrame:
    """``data``: bigrams that begin with a word of several ways and the number of words before them, from the learnt ``docs``."""

    def build(kept: dict):
        _, _, b, c, _ = _trigrams(kept[_LEARNT])
        _, order, at = _grouped(_pair(b, c))
        first = order[at]
        data = _packed({"b": b[first], "c": c[first], "n": np.diff(np.r_[at, len(order)])})
        return None, [pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])]

    sent = _exchange(_send(docs, Split(), range(1), lambda a, b, c: _to_part(_pair(b, c), parts), head, ways))
    return written(sent.mapInArrow(lambda batches: _work(batches, build, None), "data binary"), "pairs")


def _send_pairs(pairs: DataFrame, head, ways, parts: int, split: Split, taken: int) -> DataFrame:
    """The bigrams of ``pairs`` with a first word of one shard, to each part of that word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                lists = _unpacked(data.as_py())
                at = np.flatnonzero(split.of(head.value[0][lists["b"].astype(np.int64)]) == taken)
                b, c, n = (lists[k][at] for k in ("b", "c", "n"))
                way = 0
                while len(b):
                    yield _dealt(_to_part(_pair(b, np.full(len(b), way, np.uint64)), parts), _PAIRS, b=b, c=c, n=n)
                    way += 1
                    at = np.flatnonzero(ways.value[b.astype(np.int64)] > way)
                    b, c, n = b[at], c[at], n[at]

    return pairs.mapInArrow(run, _SENT)


def _of_word(ids: np.ndarray, in_head: np.ndarray, tail: _Index, in_tail: np.ndarray) -> np.ndarray:
    """A count of each word, of the head or of a part's other words; the last of ``in_tail`` where it is absent."""
    rare = np.flatnonzero(ids >= _TAIL)
    out = in_head[_at(ids, in_head)]
    out[rare] = in_tail[tail.find(mix(ids[rare]))]
    return out


class _BySum:
    """Sums and numbers of log probabilities by row, sent when they are many."""

    def __init__(self, send) -> None:
        self.send, self.held, self.size = send, [], 0

    def add(self, rows: np.ndarray, sums: np.ndarray, n: np.ndarray):
        self.held.append((rows, sums, n))
        self.size += len(rows)
        if self.size > _KEYS:
            self._merge()
            if self.size > _KEYS // 2:
                yield from self.rest()

    def _merge(self) -> None:
        rows, sums, n = (np.concatenate(x) for x in zip(*self.held, strict=True))
        rows, order, at = _grouped(rows)
        self.held, self.size = [(rows, _sums(sums, order, at), _sums(n, order, at))], len(rows)

    def rest(self):
        if self.held:
            self._merge()
            yield self.send(*self.held[0])
        self.held, self.size = [], 0


def _scores(docs: DataFrame, counts: DataFrame, head_words: int, shards: int, parts: int) -> DataFrame:
    """``row, s, n``: sums of log probabilities and numbers of tokens of ``docs (text, row, learnt)``, in one row a text and shard."""
    cut = {kind: np.array([0.0, *_cuts(counts, kind)]) for kind in (1, 2, 3)}
    words = counts.where("kind = 1")
    d = cut[2].tolist()
    words = written(words.select("w", "c", "total", F.when(F.col("total") > 0, (F.col("n1") * d[1] + F.col("n2") * d[2] + F.col("n3") * d[3]) / F.col("total")).otherwise(1.0).alias("rest"), "raw"), "words")
    d = cut[1].tolist()
    total, given, n = words.where("c > 0").agg(F.sum("c"), F.sum(F.when(F.col("c") == 1, d[1]).when(F.col("c") == 2, d[2]).otherwise(d[3])), F.count("*")).first()
    unknown = given / total / (n + 1)
    first = collected(words.orderBy(F.desc("raw"), "w").limit(head_words))  # of fixed size
    split = even_split(first["w"].view(np.uint64), first["raw"], shards)
    head = docs.sparkSession.sparkContext.broadcast((first["w"].view(np.uint64), first["c"], first["total"], first["rest"]))
    of_shard = np.maximum(_sum(split.of(first["w"].view(np.uint64)), first["raw"], shards), 1)[split.of(first["w"].view(np.uint64))]
    ways = np.r_[np.clip(np.ceil(4 * parts * first["raw"] / of_shard - 1), 1, parts), 1].astype(np.uint64)  # the last is that of all other words
    ways = docs.sparkSession.sparkContext.broadcast(ways)
    pairs = _pairs(docs.where("learnt"), head, ways, parts)
    less = lambda c, order: c - cut[order][np.minimum(c, 3)]
    p_word = lambda c1: np.where(c1 > 0, less(c1, 1) / total, 0.0) + unknown

    def own_part(a, b, c):
        return _own_part(a, b, ways.value, parts)

    def word_part(ids):
        return _to_part(_pair(ids, np.zeros(1, np.uint64)), parts)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_c, head_total, head_rest = (np.r_[x, x[:1]] for x in head.value[1:])
        by_row = _BySum(lambda rows, s, n: _dealt(_to_part(mix(rows.view(np.uint64)), parts), _SUMS, rows=rows, d=s, n=n))

        def build(kept: dict):
            keys, a, b, c, c3 = _trigrams(kept[_LEARNT])
            contexts, order, at = _grouped(_pair(a, b))
            totals = _sums(c3, order, at)
            rests = _sums(cut[3][np.minimum(c3, 3)], order, at) / totals
            alone = np.flatnonzero(ways.value[_at(b, ways.value)] == 1)
            pair, order, at = _grouped(_pair(b[alone], c[alone]))
            more, of_more, first = _grouped(_pair(kept[_PAIRS]["b"], kept[_PAIRS]["c"]))  # one that came by two ways counts once
            pair, c2 = np.r_[pair, more], np.r_[np.diff(np.r_[at, len(order)]), kept[_PAIRS]["n"][of_more[first]]]
            order = np.argsort(pair)
            tail = mix(kept[_WORDS]["a"])
            by_word = np.argsort(tail)
            of_tail = np.r_[kept[_WORDS]["n"][by_word], 0], np.r_[kept[_WORDS]["d"][by_word], 1.0]
            return (_Index(keys), np.r_[c3, 0], _Index(contexts), np.r_[totals, 1], np.r_[rests, 1.0], _Index(pair[order]), np.r_[c2[order], 0], _Index(tail[by_word]), *of_tail), []

        def answer(state, asked: dict, _: int):
            trigrams, counts3, contexts, totals, rests, pair, counts2, tail, tail_total, tail_rest = state
            a, b, c = asked["a"], asked["b"], asked["c"]
            ab = _pair(a, b)
            context, c2 = contexts.find(ab), counts2[pair.find(_pair(b, c))]
            known = np.flatnonzero((context < contexts.n) & (c2 > 0))  # others have no trigram
            c3 = np.zeros(len(a), np.int64)
            c3[known] = counts3[trigrams.find(_pair(ab[known], c[known]))]
            factor = rests[context]
            p = less(c3, 3) / totals[context] + factor * (less(c2, 2) / np.maximum(_of_word(b, head_total, tail, tail_total), 1))
            factor = factor * _of_word(b, head_rest, tail, tail_rest)
            rare = np.flatnonzero(c >= _TAIL)  # their counts are in another part
            c1 = head_c[_at(c, head_c)]
            s, n = np.log(p + factor * p_word(c1)), np.ones(len(p), np.int64)
            s[rare] = n[rare] = 0
            at = np.r_[0, np.cumsum(asked["runs"])[:-1]]
            yield from by_row.add(asked["rows"], np.add.reduceat(s, at), np.add.reduceat(n, at))
            if len(rare):
                yield _dealt(word_part(c[rare]), _ASKED, rows=np.repeat(asked["rows"], asked["runs"])[rare], a=c[rare], d=p[rare], e=factor[rare])

        yield from _work(batches, build, answer)
        yield from by_row.rest()

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_row = _BySum(lambda rows, s, n: pa.RecordBatch.from_arrays([pa.array(rows), pa.array(s), pa.array(n)], ["row", "s", "n"]))

        def build(kept: dict):
            tail = mix(kept[_WORDS]["a"])
            order = np.argsort(tail)
            return (_Index(tail[order]), np.r_[kept[_WORDS]["n"][order], 0]), []

        def answer(state, asked: dict, tag: int):
            if tag == _SUMS:
                yield from by_row.add(asked["rows"], asked["d"], asked["n"])
                return
            tail, counts1 = state
            s = np.log(asked["d"] + asked["e"] * p_word(counts1[tail.find(mix(asked["a"]))]))
            yield from by_row.add(asked["rows"], np.add.reduceat(s, np.r_[0, np.cumsum(asked["runs"])[:-1]]), asked["runs"].astype(np.int64))

        yield from _work(batches, build, answer)
        yield from by_row.rest()

    out = None
    for shard in range(shards):
        sent = _send(docs, split, range(shard, shard + 1), own_part, head, ways, True).unionByName(_send_words(words, ["total", "rest"], head, word_part, split, shard))
        sent = sent.unionByName(_send_pairs(pairs, head, ways, parts, split, shard))
        sent = _exchange(sent).mapInArrow(predict, _SENT).unionByName(_send_words(words, ["c"], head, word_part))
        sums = _exchange(sent).mapInArrow(combine, "row bigint, s double, n bigint").groupBy("row").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        sums = written(sums, "sums")
        out = sums if out is None else out.unionByName(sums)
    for done in (words, pairs):
        drop_scratch(done)
    return out


def perplexities(flagged: DataFrame, s: Settings) -> DataFrame | None:
    """``doc_id, lang, role, perplexity`` per token; None without trusted text."""
    docs = flagged.withColumn("row", F.xxhash64("text", "doc_id"))  # the same in each round; rows with equal ids and texts share their sums
    size, learnt_size, trusted_size = (x or 0 for x in flagged.agg(*(F.sum(F.when(F.expr(x), F.octet_length("text"))) for x in ("true", "role = 1", "role > 0"))).first())
    learnt_size = learnt_size or trusted_size
    shards = min(s.shards, 1 + size // s.shard_bytes)
    most = lambda n: min(max(16, size // (n * s.part_bytes), learnt_size // (n * s.learnt_bytes)), 60_000)
    shards += min(s.more_shards, most(shards) // 32)
    parts, count_shards = most(shards), min(s.count_shards, shards)
    count_parts = min(max(16, learnt_size // (count_shards * s.count_bytes)), 60_000)
    for learnt in ("role = 1", "role > 0"):
        counts = _count(docs.where(learnt).withColumn("learnt", F.lit(True)), count_shards, count_parts)
        if not counts.where("kind = 1").isEmpty():
            break
    else:
        return None
    rounds = _scores(docs.withColumn("learnt", F.expr(learnt)), counts, s.head, shards, parts)
    sums = rounds.groupBy("row").agg((F.sum("s") / F.sum("n")).alias("mean"))
    out = written(docs.drop("text").join(sums, "row", "left").select("doc_id", "lang", "role", F.exp(-F.col("mean")).alias("perplexity")), "perplexities")
    for done in (counts, rounds):
        drop_scratch(done)
    return out


def classify(docs: DataFrame, trusted: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, perplexity, threshold, kept`` of ``docs (doc_id, text, lang)``, given ``trusted (doc_id)``."""
    ship(docs.sparkSession)
    role = F.when(~F.col("trusted"), 0).when(fold("doc_id") == 0, 2).otherwise(1)  # 2: held out
    flagged = _flagged(docs, trusted, settings).select("doc_id", "text", "lang", role.alias("role"))
    with session_setting(docs.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):  # a round's shuffles go with it
        scored = perplexities(flagged.withColumn("doc_id", F.col("doc_id").cast("long")), settings)
    if scored is None:
        return docs.select(F.col("doc_id").cast("long"), F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), F.lit(False).alias("kept"))
    known = scored.where("role = 2 and perplexity is not null")
    if known.isEmpty():
        known = scored.where("role > 0 and perplexity is not null")
    cut = F.percentile_approx("perplexity", settings.quantile, 10_000)
    by_lang = written(known.where("lang is not null").groupBy("lang").agg(cut.alias("own")), "thresholds")  # so that Spark knows its size
    overall = known.agg(cut).first()[0]
    out = scored.join(by_lang, "lang", "left").withColumn("threshold", F.coalesce("own", F.lit(overall).cast("double")))
    return out.select("doc_id", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("kept"))
