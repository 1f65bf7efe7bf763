"""The corpus pipeline: toxicity, line dedup, near-duplicates, decontamination, encoding.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame`` over what its predecessor kept; every stage's result is
written as Parquet and read again as the next one's ``docs``. All stages but the last return the columns
of documents. SQL can't express the toxicity model or the tokenizer, so ``ORACLE_SQL`` is None and the
stages are tested against brute force.

Defined results: every stage judges rows, not ids: rows with a null id are scored, compared, aligned and encoded like
others (only line dedup, whose rule names ids, leaves them as they are), and of rows that share an id each goes or stays by its own
text. Of repeated rows one stays, as of all near-duplicates; texts without words are no near-duplicates of anything.
A text without lines left stays as an empty one. Columns of documents keep their values, whatever their names: where one is
called ``ids`` or ``decoded``, the results of the last stage get an underscore. Texts have any length; empty tables give an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import drop_scratch, scratch_path, table, written
from orrery.llm.decontaminate import contaminated_keys
from orrery.llm.line_dedup import NAMES, dedup_lines
from orrery.llm.minhash import Settings as NearDuplicates
from orrery.llm.minhash import near_duplicates
from orrery.llm.queries import PIECE_MODEL
from orrery.llm.sentencepiece_bpe import Vocabulary, encode_decode
from orrery.llm.toxicity import fit_on_folds, score

ORACLE_SQL: str | None = None

#: Five-word shingles at a similarity of 0.8.
NEAR = NearDuplicates(shingle=5, percent=80)


def _free(name: str, docs: DataFrame) -> str:
    """``name``, with underscores until no column is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _same(docs: DataFrame, changed: dict) -> list:
    """The columns of ``docs``, some of them changed."""
    return [changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects (a score of 0.5 or more) go."""
    model = fit_on_folds(docs, table(spark, sf_dir, "labels"))
    name = _free("toxicity", docs)
    return score(docs, model, name=name).where(F.col(name) < 0.5).select(*_same(docs, {}))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 code points or more in three documents or more stay only in the largest id."""
    names = [_free(n, docs) for n in NAMES]
    out = dedup_lines(docs, names=tuple(names))
    return out.select(*_same(docs, {"text": F.col(names[0]), "n_chars": F.length(names[0]).cast("long")}))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the smallest id (a null one last)."""
    key = _free("row", docs)
    keyed = written(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")  # written, so that the numbers stay
    groups = near_duplicates(keyed, NEAR, id_col=key).select(F.col(key).alias("of"), "component_id")
    groups = groups.join(keyed.select(F.col(key).alias("of"), F.struct(F.col("doc_id").isNull(), "doc_id", key).alias("place")), "of")
    first = groups.groupBy("component_id").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").select("component_id", "first")
    gone = groups.join(first, "component_id").where(F.col("place") != F.col("first")).select(F.col("of").alias(key))
    return keyed.join(gone, key, "left_anti").select(*_same(docs, {}))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text holds a benchmark item, or an edited copy of one, go."""
    digest = F.struct(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("text"), "text").alias("h2"))
    gone = contaminated_keys(docs, digest, table(spark, sf_dir, "benchmark")).select("key.h1", "key.h2").distinct()
    return docs.join(gone, (digest["h1"] == gone["h1"]) & (digest["h2"] == gone["h2"]), "left_anti").select(*_same(docs, {}))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with the ids of each text and the text that they decode to."""
    return encode_decode(docs, Vocabulary.load(public_tokenizers.path(PIECE_MODEL)), names=(_free("ids", docs), _free("decoded", docs)))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            drop_scratch(before)  # read for the last time
        docs = before = spark.read.parquet(path)
    return docs
