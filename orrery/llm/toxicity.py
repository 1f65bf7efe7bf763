"""Toxicity by non-negative positive-unlabelled learning (operator 9).

Confirmed toxic documents are the positives; a sample of all training texts, whatever their labels,
is the unlabelled set. Features are words (runs of letters, digits and non-ASCII characters, so that what is attached
to a word does not hide it), the first 4 and 6 bytes of words, which their inflected forms share, and whether such a beginning
comes twice or three times. A linear model minimises the class-prior-corrected
risk  ``pi E_p[l(g)] + max(0, E_u[l(-g)] - pi E_p[l(-g)])``  with the logistic loss, in numpy. Where the
bracket falls below zero the step goes the other way, as in the non-negative estimator of Kiryo et al. A feature whose
shares in the two samples differ by z standard errors (the root of the likelihood ratio, which holds for small counts too) is
scaled by z^4 / (z^4 + half_z^4), so that chance finds count for little, relative to the most telling feature, so that few
confirmed documents do; below ``least_scale`` it is left out.

Bounds, all parameters of :class:`Settings`: documents in either sample. The samples are the documents with
the smallest hash of their id; features are counted over whole texts, however long.

Defined results: a null or empty text gets the score of a text without any feature of the model. Without
confirmed toxic documents, or without training texts, every score is 0; one confirmed document is enough to learn from. Without
confirmed clean ones the prior is the share of confirmed toxic documents among all training rows, a lower bound.
Rows with a null or repeated id are scored like others; an empty table gives an empty one. A column named like a
result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import collected, drop_scratch, flat_bytes, fold, map_texts, written
from orrery.llm.hashtable import HashTable
from orrery.llm.words import NOT_ALNUM, mix, run_hashes, word_bounds


@dataclass(frozen=True)
class Settings:
    positives: int = 2_000
    unlabelled: int = 12_000
    half_z: float = 8.0  # standard errors between the two samples at which a feature counts half; millions of features are tried
    least_scale: float = 0.3
    prior: float | None = None  # of toxic documents; None: their share among the labelled training rows, or among all training rows if none is labelled clean
    steps: int = 300
    rate: float = 0.1
    decay: float = 1e-4


@dataclass
class Model:
    features: np.ndarray  # keys, sorted
    weights: np.ndarray
    bias: float


_BEGINNINGS = (4, 6)  # bytes
_ROOT = np.uint64(~3 & (1 << 64) - 1)  # the last two bits of a key: how often the beginning comes again


def _roots(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, key) of the words, then of the beginnings of each size."""
    starts, ends, firsts = word_bounds(raw, offsets, NOT_ALNUM)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    out = [(text, run_hashes(raw, starts, ends) & _ROOT)]
    for size in _BEGINNINGS:
        long = np.flatnonzero(ends - starts >= size)
        out.append((text[long], mix(run_hashes(raw, starts[long], starts[long] + size) + np.uint64(size)) & _ROOT))
    return out


def _again(text: np.ndarray, key: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, key) of the beginnings that come twice, and three times."""
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    same = (text[1:] == text[:-1]) & (key[1:] == key[:-1])
    twice, thrice = np.flatnonzero(same), np.flatnonzero(same[1:] & same[:-1])
    return [(text[twice], key[twice] | np.uint64(1)), (text[thrice], key[thrice] | np.uint64(2))]


def _sample(rows: DataFrame, n: int) -> DataFrame:
    """``n`` ids at most, those with the smallest hashes."""
    return rows.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def _feature_sets():
    def compute(texts):
        found = _roots(*flat_bytes(texts))
        for text, key in found[1:]:
            found = [*found, *_again(text, key)]
        text, key = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((key, text))
        text, key = text[order], key[order]
        once = np.ones(len(text), bool)
        once[1:] = (text[1:] != text[:-1]) | (key[1:] != key[:-1])
        ends = np.searchsorted(text[once], np.arange(len(texts) + 1))
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(key[once].view(np.int64)))]

    return compute


def _held(sampled: DataFrame, keys: np.ndarray) -> DataFrame:
    """``doc_id, p, u, at``: the places in ``keys`` of each document's features."""
    shared = sampled.sparkSession.sparkContext.broadcast(keys)  # of bounded samples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = HashTable(shared.value)
        for batch in batches:
            lists = batch.column(3)
            at = table.find(lists.flatten().to_numpy().view(np.uint64))
            held = np.r_[0, np.cumsum(at >= 0)][np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(pa.array(held, pa.int32()), pa.array(at[at >= 0], pa.int32()))], ["doc_id", "p", "u", "at"])

    return sampled.select(F.col("doc_id").cast("long"), "p", "u", "keys").mapInArrow(run, "doc_id bigint, p int, u int, at array<int>")


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Learns from ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``, the training rows of both."""
    counts = labels.groupBy().agg(F.count("toxic").alias("n"), F.count_if(F.col("toxic") == 1).alias("toxic")).first()
    if not counts["toxic"]:
        return None
    prior = settings.prior
    if prior is None:  # without a row that is labelled clean, labels say nothing of the share
        prior = counts["toxic"] / (counts["n"] if counts["n"] > counts["toxic"] else max(docs.count(), counts["toxic"]))
    prior = min(max(prior, 1e-3), 0.9)
    ids = _sample(labels.where("toxic = 1"), settings.positives).select("doc_id", F.lit(1).alias("p"), F.lit(0).alias("u"))
    ids = ids.unionByName(_sample(docs, settings.unlabelled).select("doc_id", F.lit(0).alias("p"), F.lit(1).alias("u")))
    ids = ids.groupBy("doc_id").agg(F.max("p").alias("p"), F.max("u").alias("u"))
    # At most settings.positives + settings.unlabelled ids: a broadcast of a set size.
    sampled = map_texts(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"), "text", _feature_sets, "keys array<bigint>", ["doc_id", "p", "u"])
    sampled = written(sampled.groupBy("doc_id", "p", "u").agg(F.min("keys").alias("keys")), "toxicity-sample", wide=True)
    n_p, n_u = sampled.agg(F.sum("p"), F.sum("u")).first()
    if not n_p or not n_u:
        return None
    p, u = F.col("p"), F.col("u")
    share = (p + u) / (n_p + n_u)
    term = lambda x, n: F.when(x > 0, x * F.log(x / (share * n))).otherwise(0.0)
    z4 = F.pow(2 * (term(p, n_p) + term(u, n_u)), 2)  # the likelihood ratio is about z^2
    scale = z4 / (z4 + settings.half_z**4)
    exploded = sampled.select("doc_id", "p", "u", F.explode("keys").alias("key"))
    scaled = written(exploded.groupBy("key").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).select("key", scale.alias("scale")), "scales")
    most = scaled.agg(F.max("scale")).first()[0] or 1.0
    telling = scaled.withColumn("scale", F.col("scale") / most).where(F.col("scale") >= settings.least_scale)
    features = collected(telling)  # of bounded samples
    order = np.argsort(features["key"].view(np.uint64))
    keys, scales = features["key"].view(np.uint64)[order], features["scale"][order]
    rows = _held(sampled, keys).toArrow().sort_by("doc_id")  # the documents of the samples, each with the numbers of its features
    for done in (sampled, scaled):
        drop_scratch(done)
    lists = rows["at"].combine_chunks()
    row = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy())
    weights, bias = train(row, lists.flatten().to_numpy(), rows["p"].to_numpy() > 0, rows["u"].to_numpy() > 0, scales, prior, settings)
    return Model(keys, weights, bias)


def train(row: np.ndarray, column: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, scales: np.ndarray, prior: float, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk over features of these scales, by Adam on the whole sample.

    ``row`` (ascending) and ``column`` say which document has which feature.
    """
    n, size = len(positive), len(scales)
    w, bias = np.zeros(size), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    share_p, share_u = positive / positive.sum(), unlabelled / unlabelled.sum()
    by_column = np.argsort(column, kind="stable")
    rows, row_starts = np.unique(row, return_index=True)  # rows come in order
    columns, column_starts = np.unique(column[by_column], return_index=True)
    row_by_column = row[by_column]
    for step in range(1, settings.steps + 1):
        g = np.full(n, bias)
        if len(row):
            g[rows] += np.add.reduceat((w * scales)[column], row_starts)
        p = 1 / (1 + np.exp(-np.clip(g, -40, 40)))
        below = np.logaddexp(0, g)  # the loss of calling a document clean
        rest = (share_u - prior * share_p) @ below
        slope = -prior * share_p * (1 - p)
        clean = (share_u - prior * share_p) * p
        slope = slope + clean if rest >= 0 else -clean
        grad = np.r_[settings.decay * w, slope.sum()]
        if len(row):
            grad[columns] += np.add.reduceat(slope[row_by_column], column_starts) * scales[columns]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        move = settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w * scales, float(bias)


def score(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """``docs`` with the column ``name`` (double); only the text is read."""
    if model is None:
        kept = docs.columns if keep is None else keep
        return docs.select(*[F.col(f"`{c}`") for c in kept if c.lower() != name.lower()], F.lit(0.0).alias(name))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of bounded samples

    def make():
        found = shared.value
        table, n = HashTable(found.features), max(1, len(found.features))
        again = HashTable(np.unique(found.features[(found.features & ~_ROOT) > 0] & _ROOT))

        def compute(texts):
            roots = _roots(*flat_bytes(texts))
            for text, key in roots[1:]:
                some = np.flatnonzero(again.find(key) >= 0)
                roots = [*roots, *_again(text[some], key[some])]
            text, key = (np.concatenate(x) for x in zip(*roots, strict=True))
            column = table.find(key)
            at = np.flatnonzero(column >= 0)
            pairs = np.unique(text[at].astype(np.int64) * n + column[at])
            g = found.bias + np.bincount(pairs // n, found.weights[pairs % n], len(texts))
            return [pa.array(1 / (1 + np.exp(-np.clip(g, -700, 700))), pa.float64())]

        return compute

    return map_texts(docs, text_col, make, f"`{name}` double", keep)


def fit_on_folds(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Learns only from rows whose fold is not the held-out one."""
    return fit(docs.where(fold("doc_id") != 0), labels.select("doc_id", "toxic").where(fold("doc_id") != 0), settings)
