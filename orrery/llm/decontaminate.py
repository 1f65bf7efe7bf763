"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment (operator 6).

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased; in scripts without blanks (ideographs, kana, Thai, Lao,
Burmese, Khmer) each code point is one. The n-grams of a test item that training
rows hold are counted over all rows. Those that are ``common`` times as frequent as the item's median
n-gram say little and are no seeds; all others are, at least half of them, so that no n-gram is left out for one a little
rarer, which could be the very one that an edited copy lost. Items are classed by the power of two of their length. The text around seeds of one class in a training row is
a passage, as wide as an alignment with an item of that class can be and no wider, whatever other items there are; it is
joined with every item of the class that has one of its seeds. A passage that in no stretch as long as an alignment can be has
enough words of the item can't reach the score and goes; the others are aligned (match +2, mismatch and gap -1).
The best score over twice the item's words is the similarity. Rows scan the texts against Bloom filters, one of all seeds and one a class, whose size
follows from the number of n-grams, ``most_bits`` at most, beyond which they only let more through; joins by n-gram are exact.

Defined results: pairs below ``similarity``, or whose score is below that of ``least_words`` words (or of all
words of a shorter item), aren't returned; an item of fewer words than an n-gram is found only in rows that consist of
just these words, as a common word or two alone say nothing; null or empty
texts and rows with a null id on either side are never returned. Rows that share an id are one document or item, with every one of its
texts; the best alignment counts, ties to the earliest. Empty tables give an empty one. Texts have any length;
other columns aren't read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import collected, flat_bytes, ship, text_slices, written
from orrery.llm.words import NOT_ALNUM, combine, run_hashes, unit_bounds


@dataclass(frozen=True)
class Settings:
    n: int = 3  # words of a seed
    common: float = 64.0  # an n-gram that so many times more rows hold than the item's median n-gram isn't a seed
    similarity: float = 0.5
    least_words: int = 6
    most_bits: int = 27  # a Bloom filter has 2 ** 20 bits, or 16 for each n-gram, but 2 ** most_bits at most


MATCH, MISMATCH, GAP = 2, -1, -1


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """(score, end in the passage) of the best local alignment of two arrays, the earliest end."""
    if not len(item) or not len(passage):
        return 0, 0
    ramp = -GAP * np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + step)
        new = np.maximum.accumulate(new + ramp) - ramp  # gaps along the passage
        row = np.maximum(new, 0)
        row[0] = 0
        at = int(row.argmax())
        if row[at] > best or row[at] == best and 0 < at < end:
            best, end = int(row[at]), at
    return best, end


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """(score, start, end) of the best local alignment; start from the alignment of the reversed arrays."""
    score, end = smith_waterman(item, passage)
    if not score:
        return 0, 0, 0
    _, back = smith_waterman(item[::-1], passage[:end][::-1])
    return score, end - back, end


def threshold(length: int, s: Settings) -> float:
    """The score that makes a find of an item of so many words."""
    return max(2 * s.similarity * length, MATCH * min(s.least_words, length))


def enough(score: int, length: int, s: Settings) -> bool:
    """Whether an alignment's score with an item of so many words makes a find."""
    return score >= threshold(length, s)


def span(length: int, s: Settings) -> int:
    """The most words of a passage that an alignment which makes a find covers.

    An alignment with m matches and o other steps scores 2 m - o. To make a find, 2 m - o >= t with m <= length, so o <= 2 length - t
    and it covers 3 length - t words at most.
    """
    return int(3 * length - threshold(length, s))


def admits(item: np.ndarray, passage: np.ndarray, s: Settings) -> bool:
    """False only if no alignment of the passage can make a find: too few of the item's words in any stretch that one covers."""
    reach = span(len(item), s)
    held = np.r_[0, np.cumsum(np.isin(passage, item))]
    most = int((held[reach:] - held[:-reach]).max()) if 0 < reach < len(held) - 1 else int(held[-1])
    return MATCH * most >= threshold(len(item), s)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = flat_bytes(column)
    starts, ends, firsts = unit_bounds(raw, offsets, NOT_ALNUM)
    return run_hashes(raw, starts, ends), firsts


def _short(hashes: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text of 1 to n - 1 words the number of its first word and one gram of all its words."""
    sizes, at, grams = np.diff(firsts), [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for k in range(1, n):
        if len(first := firsts[:-1][sizes == k]):
            at.append(first)
            grams.append(combine(hashes[(first[:, None] + np.arange(k)).ravel()], k)[::k])
    return np.concatenate(at), np.concatenate(grams)


def _grams(hashes: np.ndarray, firsts: np.ndarray, n: int, keep=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams within the texts, the number of the first word of each, and its text; those that ``keep`` gives the places of."""
    grams = combine(hashes, n)
    at = np.arange(len(grams)) if keep is None else keep(grams)
    grams = grams[at]
    text = np.searchsorted(firsts, at, side="right") - 1
    whole = at + n <= firsts[text + 1]
    first, short = _short(hashes, firsts, n)
    if keep is not None:
        kept = keep(short)
        first, short = first[kept], short[kept]
    grams, at = np.r_[grams[whole], short], np.r_[at[whole], first]
    if len(short):
        order = np.argsort(at, kind="stable")
        grams, at = grams[order], at[order]
    return grams, at, np.searchsorted(firsts, at, side="right") - 1


def _items(items: DataFrame, s: Settings, id_col: str, text_col: str) -> DataFrame:
    """``item_id, words, grams`` of the items' texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                hashes, firsts = _words(batch.column(1)[a:b])
                grams, _, text = _grams(hashes, firsts, s.n)
                ends = np.r_[0, np.cumsum(np.bincount(text, minlength=b - a))]
                lists = [pa.ListArray.from_arrays(pa.array(e, pa.int32()), pa.array(v.view(np.int64))) for e, v in ((firsts, hashes), (ends, grams))]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *lists], ["item_id", "words", "grams"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("item_id is not null")
    return rows.mapInArrow(run, "item_id bigint, words array<bigint>, grams array<bigint>").where(F.size("grams") > 0).distinct()


def _bloom(grams: DataFrame, bits: int) -> np.ndarray:
    """A bit array of fixed size that has two bits of each gram, built on the executors."""
    at = F.explode(F.array(F.col("gram").bitwiseAND(F.lit((1 << bits) - 1)), F.shiftrightunsigned("gram", 64 - bits)))
    words = grams.select(at.alias("at")).select(F.shiftrightunsigned("at", 5).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(31)).cast("int")).alias("bit"))
    rows = collected(words.groupBy("word").agg(F.bit_or("bit").alias("bits")))  # 2 ** (bits - 5) at most
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[rows["word"]] = rows["bits"].astype(np.uint32)
    return out


def _in_bloom(bloom: np.ndarray, bits: int, grams: np.ndarray) -> np.ndarray:
    """Places of the grams that may be in the filter."""
    at = (grams & np.uint64((1 << bits) - 1)).astype(np.int64)
    found = np.flatnonzero(bloom[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1))
    at = (grams[found] >> np.uint64(64 - bits)).astype(np.int64)
    return found[(bloom[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1)).astype(bool)]


def _filter(grams: DataFrame, s: Settings) -> tuple[np.ndarray, int]:
    """A Bloom filter of ``grams (gram)`` and its bits."""
    grams = grams.distinct()
    bits = min(s.most_bits, max(20, (16 * grams.count()).bit_length()))
    return _bloom(grams, bits), bits


def _held(rows: DataFrame, grams: DataFrame, s: Settings) -> DataFrame:
    """Of ``rows (key, text)`` the grams in the filter of ``grams (gram)``, once a row: ``gram``."""
    shared = rows.sparkSession.sparkContext.broadcast(_filter(grams, s))  # 2 ** most_bits bits at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                hashes, firsts = _words(batch.column(1)[a:b])
                grams, _, text = _grams(hashes, firsts, s.n, lambda g: _in_bloom(*shared.value, g))
                if not len(grams):
                    continue
                order = np.lexsort((grams, text))
                grams, text = grams[order], text[order]
                once = np.r_[True, (text[1:] != text[:-1]) | (grams[1:] != grams[:-1])]
                yield pa.RecordBatch.from_arrays([pa.array(grams[once].view(np.int64))], ["gram"])

    return rows.mapInArrow(run, "gram bigint")


def _passages(rows: DataFrame, seeds: DataFrame, classes: list[tuple[int, int, int]], s: Settings) -> DataFrame:
    """Of ``rows (key, text)`` the passages around ``seeds (gram, class)``: ``key, class, start, words, grams``.

    ``classes`` has for each class of items (class, words to either side of a seed, least words of a passage).
    """
    each = [(*c, *_filter(seeds.where(F.col("class") == c[0]).select("gram"), s)) for c in classes]
    shared = rows.sparkSession.sparkContext.broadcast((_filter(seeds.select("gram"), s), each))  # a filter a class, of which there are some dozen

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        union, by_class = shared.value
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                hashes, firsts = _words(batch.column(1)[a:b])
                all_grams, all_hits, all_texts = _grams(hashes, firsts, s.n, lambda g: _in_bloom(*union, g))
                rows, texts = [], []
                for number, reach, least, bloom, bits in by_class:
                    mine = _in_bloom(bloom, bits, all_grams)
                    grams, hit, text = all_grams[mine], all_hits[mine], all_texts[mine]
                    cut = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (hit[1:] - hit[:-1] > 2 * reach)]) if len(hit) else []
                    for x, y in zip(cut, [*cut[1:], len(hit)], strict=True) if len(hit) else ():
                        first, last = int(firsts[text[x]]), int(firsts[text[x] + 1])
                        start, end = max(first, int(hit[x]) - reach), min(last, int(hit[y - 1]) + s.n + reach)
                        if end - start >= least:
                            texts.append(text[x])
                            rows.append((number, start - first, hashes[start:end].view(np.int64), np.unique(grams[x:y]).view(np.int64)))
                if rows:
                    types = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)]
                    keys = batch.column(0)[a:b].take(pa.array(texts, pa.int64()))
                    yield pa.RecordBatch.from_arrays([keys, *columns], ["key", "class", "start", "words", "grams"])

    key = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {key}, class int, start bigint, words array<bigint>, grams array<bigint>")


def _seeds(tests: DataFrame, rows: DataFrame, s: Settings) -> DataFrame:
    """``gram, iid, class``: the n-grams of each item text that rows hold, without those far more frequent than its median one."""
    grams = tests.select("iid", "class", F.explode("grams").alias("gram")).distinct()
    counted = _held(rows, grams.select("gram"), s).groupBy("gram").agg(F.count("*").alias("df"))
    held = written(grams.join(counted, "gram"), "held")
    median = held.groupBy("iid").agg(F.median("df").alias("median"))  # an item's n-grams are bounded by its text
    return written(held.join(median, "iid").where(F.col("df") <= F.col("median") * s.common).select("gram", "iid", "class"), "seeds")


def _best(pairs: DataFrame, s: Settings) -> DataFrame:
    """``key, item_id, score, similarity, start_word, end_word``: the finds among ``pairs (key, item_id, start, words, item_words)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, words, wanted = (batch.column(i) for i in (2, 3, 4))
            rows = []
            for i in range(batch.num_rows):
                item, passage = wanted[i].values.to_numpy(), words[i].values.to_numpy()
                if not admits(item, passage, s):
                    continue
                score, start, end = align(item, passage)
                if enough(score, len(item), s):
                    base = bases[i].as_py()
                    rows.append((i, score, score / (MATCH * len(item)), base + start, base + end))
            if rows:
                at, *found = zip(*rows, strict=True)
                kept = [batch.column(c).take(pa.array(at)) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, k) for c, k in zip(found, [pa.int64(), pa.float64(), pa.int64(), pa.int64()], strict=True))], ["key", "item_id", "score", "similarity", "start_word", "end_word"])

    key = pairs.schema["key"].dataType.simpleString()
    aligned = pairs.mapInArrow(run, f"key {key}, item_id bigint, score bigint, similarity double, start_word bigint, end_word bigint")
    best = aligned.groupBy("key", "item_id").agg(F.max(F.struct("similarity", "score", (-F.col("start_word")).alias("s"), (-F.col("end_word")).alias("e"))).alias("x"))
    return best.select("key", "item_id", "x.score", "x.similarity", (-F.col("x.s")).alias("start_word"), (-F.col("x.e")).alias("end_word"))


def contaminated_keys(docs: DataFrame, key: Column, items: DataFrame, settings: Settings = Settings(), text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``key, item_id, score, similarity, start_word, end_word`` of rows that hold a test item or an edited copy; ``key`` names the rows."""
    ship(docs.sparkSession)
    s = settings
    rows = docs.select(key.alias("key"), F.col(f"`{text_col}`").alias("text")).where("key is not null")
    size = F.size("words")
    tests = _items(items, s, item_id_col, item_text_col).withColumns({"class": F.ceil(F.log2(size)).cast("int"), "iid": F.monotonically_increasing_id()})
    tests = written(tests, "items")
    lengths = tests.groupBy("class").agg(F.min(size).alias("least"), F.max(size).alias("most")).collect()  # some dozen rows
    classes = [(r["class"], max(0, span(r["most"], s) - s.n), int(np.ceil(threshold(r["least"], s) / MATCH))) for r in lengths]
    seeds = _seeds(tests, rows, s)
    passages = written(_passages(rows, seeds, classes, s).withColumn("pid", F.monotonically_increasing_id()), "passages", wide=True)
    pairs = passages.select("pid", "class", F.explode("grams").alias("gram")).join(seeds, ["gram", "class"]).select("pid", "iid").distinct()
    pairs = pairs.join(passages.select("pid", "key", "start", "words"), "pid").join(tests.select("iid", "item_id", F.col("words").alias("item_words")), "iid")
    return _best(pairs.select("key", "item_id", "start", "words", "item_words"), s)


def contaminated(docs: DataFrame, items: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, score, similarity, start_word, end_word`` of training rows that hold a test item or an edited copy."""
    found = contaminated_keys(docs, F.col(f"`{id_col}`").cast("long"), items, settings, text_col, item_id_col, item_text_col)
    return found.withColumnRenamed("key", "doc_id")
