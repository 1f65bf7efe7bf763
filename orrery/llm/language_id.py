"""Language identification by prediction by partial matching (operator 2).

Each language has a variable-order byte context tree with frozen counts. A byte's code length follows
PPM method C without exclusions: if the byte has followed the longest known context, ``-log2(c / (n + d))``
with its count c, the context's count n and its d distinct successors; else the escape ``-log2(d / (n + d))``
and the code length in the next shorter context; an unseen byte costs 8 bits after the last escape. Texts
are coded whole, after a fixed start context; the language with the shortest code wins, ties to the
smaller name. The score is the posterior under equal priors.

The trees are fitted on a bounded sample: whole documents, chosen by a hash of their id, of about
``train_bytes`` bytes a language (a parameter), or one document where a single one is longer; their n-grams are counted on the executors.
A language of fewer than ``least_documents`` documents isn't learnt, as that few can't be told from mislabelled ones; of more than
``most_languages`` those with the most documents are (ties to the smaller name). Languages share trees in blocks of 16, so the model
and the time of a prediction grow with their number and not with its square; where all samples together would exceed ``model_bytes``, the largest are made
smaller, all to the same size.

Defined results: ``und`` with score 0 for a text that is null or has no letter, and for every text if
nothing was learnt; an empty table gives an empty one. Rows with a null id are predicted and never learnt from; rows that share an id are predicted each by its
own text, repeated rows alike. Texts have any length and are coded whole; a column named like a result is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import collected, flat_bytes, fold, map_texts, ship, written
from orrery.llm.hashtable import HashTable

ORDER = 3
TRAIN_BYTES = 2_000_000
MODEL_BYTES = 1 << 30
LEAST_DOCUMENTS = 3
MOST_LANGUAGES = 1024
BLOCK = 16  # languages that share a table of code lengths
_START = 10  # the byte before a text
_UNIT = 4096  # code lengths count in 1/4096 bit, so that sums are exact
_PIECE = 1 << 20


def _grams(raw: np.ndarray, offsets: np.ndarray, order: int):
    """Yields (rows, keys): for pieces of the texts' bytes, each byte with the ``order`` bytes before it."""
    sizes = np.diff(offsets)
    padded = np.full(len(raw) + order * len(sizes), _START, np.uint8)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(raw)) + order * (row + 1)
    padded[at] = raw
    for a in range(0, len(raw), _PIECE):
        here = at[a : a + _PIECE]
        keys = np.zeros(len(here), np.uint64)
        for back in range(order, -1, -1):
            keys = keys << np.uint64(8) | padded[here - back]
        yield row[a : a + _PIECE], keys


@dataclass
class Block:
    """The trees of up to ``BLOCK`` languages: dense in these, sparse over all."""

    size: int
    order: int
    gram_keys: np.ndarray  # the length in the high byte
    gram_costs: np.ndarray  # by language
    context_keys: np.ndarray
    context_costs: np.ndarray


@dataclass
class Model:
    langs: list[str]
    blocks: list[Block]


def _tag(keys: np.ndarray, length: int) -> np.ndarray:
    return keys | np.uint64(length << 56)


def build(langs: list[str], lang: np.ndarray, keys: np.ndarray, counts: np.ndarray, order: int = ORDER) -> Model:
    """The code lengths of all seen n-grams and escapes, from the counts of (order+1)-grams by language."""
    blocks = []
    for first in range(0, len(langs), BLOCK):
        here = (lang >= first) & (lang < first + BLOCK)
        blocks.append(_block(min(BLOCK, len(langs) - first), lang[here] - first, keys[here], counts[here], order))
    return Model(langs, blocks)


def _block(n_langs: int, lang: np.ndarray, keys: np.ndarray, counts: np.ndarray, order: int) -> Block:
    by_length = {}
    for length in range(order + 1, 0, -1):
        uniq, back = np.unique(keys & np.uint64((1 << 8 * length) - 1), return_inverse=True)
        table = np.zeros((len(uniq), n_langs), np.int64)
        np.add.at(table, (back, lang), counts)
        by_length[length] = uniq, table
    gram_keys, gram_costs, context_keys, context_costs = [], [], [], []
    shorter_keys, shorter = np.zeros(1, np.uint64), np.full((1, n_langs), 8.0)
    for length in range(1, order + 2):
        uniq, table = by_length[length]
        contexts, of = np.unique(uniq >> np.uint64(8), return_inverse=True)
        total, distinct = np.zeros((len(contexts), n_langs)), np.zeros((len(contexts), n_langs))
        np.add.at(total, of, table)
        np.add.at(distinct, of, table > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
            seen = -np.log2(table / (total + distinct)[of])
        suffix = np.searchsorted(shorter_keys, uniq & np.uint64((1 << 8 * (length - 1)) - 1))
        cost = np.where(table > 0, seen, escape[of] + shorter[suffix])
        gram_keys.append(_tag(uniq, length))
        gram_costs.append(cost)
        context_keys.append(_tag(contexts, length))
        context_costs.append(escape)
        shorter_keys, shorter = uniq, cost
    units = lambda x: np.rint(np.concatenate(x) * _UNIT).astype(np.int32)
    return Block(n_langs, order, np.concatenate(gram_keys), units(gram_costs), np.concatenate(context_keys), units(context_costs))


def _languages(docs: DataFrame, least_documents: int, most_languages: int) -> DataFrame:
    """``lang, size`` of the languages to learn, ``most_languages`` rows at most."""
    sizes = docs.groupBy("lang").agg(F.sum(F.octet_length("text").cast("double")).alias("size"), F.count("*").alias("n"))
    return sizes.where(F.col("n") >= least_documents).orderBy(F.desc("n"), "lang").limit(most_languages).select("lang", "size")


def _share(sizes: np.ndarray, train_bytes: int, budget: int) -> float:
    """The most bytes a language, up to ``train_bytes``, with which all samples together keep to ``budget``."""
    left = float(budget)
    for i, size in enumerate(np.sort(np.minimum(sizes, train_bytes))):
        if size * (len(sizes) - i) > left:
            return left / (len(sizes) - i)
        left -= size
    return float(train_bytes)


def fit(docs: DataFrame, order: int = ORDER, train_bytes: int = TRAIN_BYTES, model_bytes: int = MODEL_BYTES, least_documents: int = LEAST_DOCUMENTS, most_languages: int = MOST_LANGUAGES) -> Model | None:
    """Learns from the rows of ``docs (doc_id, text, lang)``; those with a null in any are left out."""
    if not 1 <= order <= 6:
        raise ValueError("order is 1 to 6 bytes")
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text", "lang").dropna().where("lang <> 'und'")
    sizes = written(_languages(docs, least_documents, most_languages), "sizes")
    each = _share(collected(sizes)["size"], train_bytes, model_bytes // (4 * BLOCK))  # most_languages rows at most
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    docs = docs.join(F.broadcast(sizes), "lang").withColumn("place", place)  # most_languages rows at most
    # A language all of whose sampled places are empty would not be learnt: its first document that fits goes in whatever its place.
    order_of = F.struct((F.octet_length("text") > each).alias("long"), "place")
    firsts = written(docs.groupBy("lang").agg(F.min(order_of).alias("first")), "firsts")
    sample = docs.join(F.broadcast(firsts), "lang").where((F.col("place") / float(1 << 30) * F.col("size") < each) | (order_of == F.col("first")))

    def count(batches):
        for batch in batches:
            for name in pc.unique(batch.column(1)):
                raw, offsets = flat_bytes(batch.column(0).filter(pc.equal(batch.column(1), name)))
                for _, keys in _grams(raw, offsets, order):
                    uniq, n = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name.as_py()] * len(uniq), pa.string()), pa.array(uniq.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    counted = sample.select("text", "lang").mapInArrow(count, "lang string, gram bigint, n bigint")
    rows = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()  # of a bounded sample
    if not rows.num_rows:
        return None
    langs = sorted(pc.unique(rows["lang"]).to_pylist())
    code = pc.index_in(rows["lang"], pa.array(langs)).to_numpy().astype(np.int64)
    return build(langs, code, rows["gram"].to_numpy().view(np.uint64), rows["n"].to_numpy(), order)


class BlockCoder:
    """Code lengths under the trees of a block."""

    def __init__(self, block: Block) -> None:
        self.block = block
        self.grams, self.contexts = HashTable(block.gram_keys), HashTable(block.context_keys)
        self.context_costs = np.concatenate([block.context_costs, np.zeros((1, block.size), np.int32)])

    def _costs(self, keys: np.ndarray, length: int) -> np.ndarray:
        keys = keys & np.uint64((1 << 8 * length) - 1)
        row = self.grams.find(_tag(keys, length))
        out = self.block.gram_costs[row]
        if len(miss := np.flatnonzero(row < 0)):
            rest = self._costs(keys[miss], length - 1) if length > 1 else np.int32(8 * _UNIT)
            out[miss] = self.context_costs[self.contexts.find(_tag(keys[miss] >> np.uint64(8), length))] + rest
        return out

    def lengths(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """In 1/4096 bit, by text and language."""
        out = np.zeros((len(offsets) - 1, self.block.size), np.int64)
        for row, keys in _grams(raw, offsets, self.block.order):
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            out[row[starts]] += np.add.reduceat(self._costs(keys, self.block.order + 1), starts, axis=0, dtype=np.int64)
        return out


class Coder:
    """Code lengths under a model's trees."""

    def __init__(self, model: Model) -> None:
        self.model, self.blocks = model, [BlockCoder(b) for b in model.blocks]

    def lengths(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """In 1/4096 bit, by text and language."""
        return np.concatenate([b.lengths(raw, offsets) for b in self.blocks], axis=1)

    def best(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language with the shortest code and its posterior, by text; one block's lengths are held at a time."""
        n = len(offsets) - 1
        least, found, odds = np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n)
        for k, coder in enumerate(self.blocks):
            bits = coder.lengths(raw, offsets) / _UNIT
            here = bits.min(axis=1)
            now = np.minimum(least, here)
            odds = odds * np.exp2(np.maximum(now - least, -1000.0)) + np.exp2(np.maximum(now[:, None] - bits, -1000.0)).sum(axis=1)
            found = np.where(here < least, k * BLOCK + bits.argmin(axis=1), found)
            least = now
        return found, 1 / odds


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred string`` and ``score double``; only the text is read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a bounded sample

    def make():
        coder = Coder(shared.value) if shared.value else None

        def compute(texts):
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            if coder is None:
                return [pa.array(["und"] * len(texts), pa.string()), pa.array(np.zeros(len(texts)))]
            best, chance = coder.best(*flat_bytes(texts))
            names = np.where(letters, np.array(coder.model.langs, object)[best], "und")
            return [pa.array(names, pa.string()), pa.array(np.where(letters, chance, 0.0))]

        return compute

    return map_texts(docs, text_col, make, "lang_pred string, score double", keep)


def fit_on_folds(docs: DataFrame, order: int = ORDER, train_bytes: int = TRAIN_BYTES) -> Model | None:
    """Learns only from rows whose fold is not the held-out one."""
    return fit(docs.where(fold("doc_id") != 0), order, train_bytes)
