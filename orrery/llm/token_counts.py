"""Exact token counts by overlap resynchronisation (operator 13).

Texts of up to ``chunk`` code points are encoded whole, by the merge rounds of operator 7, whose workers remember words. Longer ones are cut into chunks that overlap; the chunks are rows of
their own, so many tasks encode one document. Of each chunk go on the number of its tokens and, within the two overlaps,
each token's place in the document and id. Neighbours are spliced at the first token that both have at the same place:

Why that is exact: byte-pair encoding merges the best pair first, the leftmost of equals. Where no merge crosses the ends of a stretch,
what happens inside it doesn't depend on what is outside. So two tokens that are neighbours in the encoding of any chunk are what their joined text
is encoded to, and a sequence of tokens all of whose neighbours are so is the encoding of its text: the first merge across one of its
borders would also be made in the joined text of the two tokens there. Left of a shared token all neighbours are from one
chunk's encoding, right of it from the other's, and it belongs to both. (A character outside the vocabulary merges with nothing, its first
byte counts as such a token.) A shared border alone would prove nothing.

Where two neighbours share no token in their overlap, the whole document is taken up again with chunks and overlaps ``widen`` times as
long, until all its chunks align or it is one chunk. Nothing is estimated.

Defined results: a null text counts as empty; an empty text has no bytes and no tokens. Strings of special tokens in a text are
text. Counts are those of the sentencepiece library for BPE models without normalisation (others are refused). Repeated rows are counted alike, null ids too; an empty
table gives an empty one; columns of ``docs`` keep their values, whatever their names, but for those called as a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import drop_scratch, map_texts, ship, written
from orrery.llm.sentencepiece_bpe import Merger, Vocabulary

RESULT = ["n_bytes", "n_tokens", "over_limit"]
_ID_BITS = 24


@dataclass(frozen=True)
class Settings:
    chunk: int = 65_536  # code points that are encoded at once
    overlap: int = 1_024  # code points that neighbours share, a quarter of a chunk at most
    widen: int = 4  # times as long both are where neighbours don't align
    limit: int = 4_096  # tokens beyond which ``over_limit`` is set

    def __post_init__(self) -> None:
        if not 0 < 4 * self.overlap <= self.chunk or self.widen < 2:
            raise ValueError("an overlap is a quarter of a chunk at most, and widening makes it longer")


@dataclass(frozen=True)
class Tokenizer:
    """The model's bytes and vocabulary, and how many code points each piece stands for; of fixed size, sent to every worker."""

    model: bytes
    vocab: Vocabulary
    widths: np.ndarray  # -1: a byte that continues a character

    @classmethod
    def load(cls, path: str) -> Tokenizer:
        vocab = Vocabulary.load(path)  # refuses models that normalise
        widths = np.array([len(p) for p in vocab.pieces], np.int64)
        for b in range(256):
            widths[vocab.first_byte + b] = -1 if 0x80 <= b < 0xC0 else 1
        with open(path, "rb") as f:
            return cls(f.read(), vocab, widths)

    def processor(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    def places(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code point at which each token begins, from -1 for the space that encoding puts before a text; and whether it begins a character."""
        width = self.widths[ids]
        own = width > 0
        width = np.where(own, width, 0)
        return np.cumsum(width) - width - 1, own


def _cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``doc, no, final, start, text``: the chunks of ``texts (doc, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, doc in enumerate(batch.column(0).to_pylist()):
                text = batch.column(1)[i].as_py()  # one at a time
                start = no = 0
                while True:
                    end = min(start + chunk, len(text))
                    yield pa.RecordBatch.from_pylist([{"doc": doc, "no": no, "final": end == len(text), "start": start, "text": text[start:end]}], schema)
                    if end == len(text):
                        break
                    start, no = end - overlap, no + 1

    schema = pa.schema([("doc", pa.int64()), ("no", pa.int64()), ("final", pa.bool_()), ("start", pa.int64()), ("text", pa.string())])
    return texts.select("doc", "text").mapInArrow(run, "doc bigint, no bigint, final boolean, start bigint, text string")


def _encoded(chunks: DataFrame, shared, overlap: int) -> DataFrame:
    """Chunks with ``n`` tokens and the keys (place and id) of those that begin in the overlaps, ``head`` and ``tail``, and the numbers of the first of them."""

    def make():
        tokenizer = shared.value
        processor = tokenizer.processor()

        def compute(texts, starts):
            counts, heads, tails, firsts, lasts = [], [], [], [], []
            for text, start in zip(texts.to_pylist(), starts.to_pylist(), strict=True):
                ids = np.array(processor.encode(text), np.int64)
                at, own = tokenizer.places(ids)
                keys = ((at + start) << _ID_BITS) | ids
                a, b, c = np.searchsorted(at, [0, overlap, len(text) - overlap])
                counts.append(len(ids))
                firsts.append(a)
                lasts.append(c)
                heads.append(np.where(own, keys, -1)[a:b])  # a key of its own side is in no other
                tails.append(np.where(own, keys, -2)[c:])
            keys = pa.list_(pa.int64())
            return [pa.array(counts, pa.int64()), pa.array(heads, keys), pa.array(tails, keys), pa.array(firsts, pa.int64()), pa.array(lasts, pa.int64())]

        return compute

    fields = "n bigint, head array<bigint>, tail array<bigint>, head_from bigint, tail_from bigint"
    return map_texts(chunks, "text", make, fields, keep=["doc", "no", "final"], also=["start"])


def splice(encoded: DataFrame) -> DataFrame:
    """``doc, n_tokens``: tokens of each document, null where neighbouring chunks share no token in their overlap.

    A chunk's tokens count from the one it shares with its left neighbour up to the one that it shares with its right one.
    """
    left = encoded.where("not final").select("doc", (F.col("no") + 1).alias("no"), (F.col("n") - F.col("tail_from")).alias("tail_n"), "tail")
    pairs = left.join(encoded.where("no > 0").select("doc", "no", "head", "head_from"), ["doc", "no"])
    pairs = pairs.withColumn("common", F.get(F.array_intersect("head", "tail"), F.lit(0)))
    dropped = F.col("tail_n") - (F.array_position("tail", F.col("common")) - 1) + F.col("head_from") + F.array_position("head", F.col("common")) - 1
    pairs = pairs.select("doc", F.lit(0).cast("bigint").alias("n"), dropped.alias("dropped"), F.col("common").isNull().alias("apart"))
    whole = encoded.select("doc", "n", F.lit(0).cast("bigint").alias("dropped"), F.lit(False).alias("apart"))
    sums = whole.unionByName(pairs).groupBy("doc").agg((F.sum("n") - F.coalesce(F.sum("dropped"), F.lit(0))).alias("n"), F.max("apart").alias("apart"))
    return sums.select("doc", F.when(~F.col("apart"), F.col("n")).alias("n_tokens"))


def _count_long(texts: DataFrame, shared, s: Settings) -> DataFrame:
    """``doc, n_tokens`` of long ``texts (doc, text)``, in rounds of chunks that get longer."""
    chunk, overlap, todo, counted = s.chunk, s.overlap, texts, None
    while True:
        chunks = _cut(todo, chunk, overlap).repartition("doc", "no")
        encoded = written(_encoded(chunks, shared, overlap), "chunk-tokens")
        round_ = written(splice(encoded), "token-counts")
        drop_scratch(encoded)
        good = round_.where("n_tokens is not null")
        counted = good if counted is None else counted.unionByName(good)
        left = round_.where("n_tokens is null").select("doc")
        if left.isEmpty():
            return counted
        todo, chunk, overlap = texts.join(left, "doc", "left_semi"), chunk * s.widen, overlap * s.widen


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, settings: Settings = Settings(), text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``; short texts don't shuffle."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(tokenizer)  # of fixed size
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in RESULT]
    columns = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.lit(0).alias("none")).alias("kept")  # by place, whatever their names
    rows = docs.select(columns, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    is_long = F.length("text") > settings.chunk

    def make():
        merger = Merger(shared.value.vocab)
        return lambda texts: [pa.array(np.diff(merger.encode(texts.to_pylist())[1]), pa.int64())]

    short = rows.where(~is_long).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    out = map_texts(short, "text", make, "n_tokens bigint", keep=["kept", "n_bytes"])
    long = written(rows.where(is_long).withColumn("doc", F.monotonically_increasing_id()), "long-texts")  # written, so that the numbers stay
    if not long.isEmpty():
        counted = _count_long(long.select("doc", "text"), shared, settings)
        out = out.unionByName(long.select("doc", "kept", F.octet_length("text").cast("bigint").alias("n_bytes")).join(counted, "doc").select("kept", "n_bytes", "n_tokens"))
    return out.select(*[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(kept)], "n_bytes", "n_tokens", (F.col("n_tokens") > settings.limit).alias("over_limit"))
