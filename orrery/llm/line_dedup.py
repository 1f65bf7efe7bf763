"""Line deduplication with levelled sorted runs of line hashes (operator 4). DataFrame functions only.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased; keys of at least
``least_chars`` code points take part, as 128-bit hashes. Documents come in batches, those with the largest ids first. A
batch's keys, with the number of its documents that hold them and its largest id, are merge-joined with the
runs: keys that no run has (the anti-join) are the batch's own, and its largest id is the one that keeps the line; of the others
only the count is new. The batch then becomes a sorted run of level 0; when a level has ``fanout`` runs they are merged into
one of the next. Runs are tables in the shared folder, bucketed and sorted by key, so that neither the join of a
batch nor a merge shuffles or sorts a run. A line goes if its key is in ``least_docs`` documents or more and the
document isn't the one that keeps it. Joins are by key and not by line until then, so a line that a third of all documents
have is one row in them.

Defined results: a null or empty text is one empty line. Rows that share an id are one holder, and their
texts lose lines separately; repeated rows lose the same ones. Rows with a null id hold nothing and keep all lines. An
empty table gives an empty one. Texts and lines have any length.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import drop_scratch, scratch_path, written

_BLANKS = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["h1", "h2"]
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


@contextmanager
def _in_order(spark: SparkSession) -> Iterator[None]:
    """Meanwhile Spark takes the order of bucket files as given, which they have: one file a bucket."""
    before = spark.conf.get(_ORDERED)
    spark.conf.set(_ORDERED, "true")
    try:
        yield
    finally:
        spark.conf.set(_ORDERED, before)


class LineRuns:
    """Sorted runs ``h1, h2, n_docs, top`` by level, merged when a level has ``fanout`` of them.

    ``top`` is the id that keeps the line, in the run of the batch that was the first to have the key; null in others.
    A run has as many buckets as Spark has shuffle partitions when the store is made.
    """

    def __init__(self, spark: SparkSession, fanout: int = 2) -> None:
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _written(self, run: DataFrame) -> str:
        name = f"orrery_run_{uuid.uuid4().hex}"
        writer = run.write.option("compression", "zstd").option("path", scratch_path(self.spark, "run"))
        with _in_order(self.spark):
            writer.bucketBy(self.buckets, *_KEY).sortBy(*_KEY).saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        drop_scratch(self.spark.table(name))
        self.spark.sql(f"DROP TABLE {name}")

    @staticmethod
    def merged(runs: list[DataFrame]) -> DataFrame:
        """Several runs as one, by merge joins; a key's ``top`` is in one of them."""
        out = runs[0]
        for run in runs[1:]:
            new = run.select(*_KEY, F.col("n_docs").alias("n"), F.col("top").alias("t"))
            total = F.coalesce("n_docs", F.lit(0)) + F.coalesce("n", F.lit(0))
            out = out.join(new.hint("merge"), _KEY, "full_outer").select(*_KEY, total.alias("n_docs"), F.coalesce("top", "t").alias("top"))
        return out

    def _put(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._written(self.merged([self.spark.table(x) for x in old])))
            for x in old:
                self._drop(x)

    def joined(self, rows: DataFrame) -> DataFrame:
        """``h1, h2, n_docs, top`` of a batch ``rows (h1, h2, id)``; ``top`` only for keys that no run has."""
        holders = rows.where("id is not null").select(*_KEY, "id").distinct()  # so that a hot line is counted in parts
        out = holders.groupBy(*_KEY).agg(F.count("*").alias("n_docs"), F.max("id").alias("top"))
        for i, run in enumerate(self.tables()):
            out = out.join(run.select(*_KEY, F.lit(True).alias(f"in{i}")).hint("merge"), _KEY, "left")
            out = out.select(*_KEY, "n_docs", F.when(F.col(f"in{i}").isNull(), F.col("top")).alias("top"))
        return out

    def add(self, rows: DataFrame) -> None:
        """Adds a batch ``h1, h2, id`` whose ids are smaller than those of all earlier batches."""
        self._put(0, self._written(self.joined(rows)))

    def admit(self, rows: DataFrame) -> DataFrame:
        """For an endless feed: the rows of ``rows (h1, h2, id, ...)`` whose hash no earlier batch had; the batch is added."""
        fresh = rows
        with _in_order(self.spark):
            for run in self.tables():
                fresh = fresh.join(run.select(*_KEY).hint("merge"), _KEY, "left_anti")
            fresh = written(fresh, "fresh")
        self.add(rows)
        return fresh

    def repeated(self, least_docs: int) -> DataFrame:
        """``h1, h2, top`` of the keys that so many documents hold."""
        if not self.levels:
            return self.spark.createDataFrame([], "h1 bigint, h2 bigint, top bigint")
        with _in_order(self.spark):
            return written(self.merged(self.tables()).where(F.col("n_docs") >= least_docs).select(*_KEY, "top"), "repeated")

    def close(self) -> None:
        """Deletes the runs."""
        for level in self.levels:
            for name in level:
                self._drop(name)
        self.levels = []


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """``id, t, pos, h1, h2`` of the lines that are long enough; t tells texts with one id apart."""
    lines = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("t"), F.posexplode(F.split(F.col(f"`{text_col}`"), "\n")).alias("pos", "line"))
    keyed = lines.select("id", "t", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= least_chars)
    return keyed.select("id", "t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))


NAMES = ("kept_text", "n_lines", "n_dropped")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 20, least_docs: int = 3, batches: int = 4, fanout: int = 2, keep: list[str] | None = None, names: tuple[str, str, str] = NAMES
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``kept_text``, ``n_lines`` and ``n_dropped``, or other ``names`` for these.

    A column named like one of them is replaced.
    """
    spark = docs.sparkSession
    id_ = F.col(id_col).cast("long")
    cuts = docs.agg(F.percentile_approx(id_, [i / batches for i in range(1, batches)], 1_000)).first()[0] if batches > 1 else []
    after = sum((F.when(F.col("id") > cut, 0).otherwise(1) for cut in cuts or []), F.lit(0))  # batch 0 has the largest ids
    rows = written(hashed_lines(docs, id_col, text_col, least_chars).withColumn("batch", after), "lines", by="batch")
    store = LineRuns(spark, fanout)
    try:
        for b in range(batches):
            store.add(rows.where(F.col("batch") == b).select(*_KEY, "id"))
        repeated = store.repeated(least_docs).select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "top")
    finally:
        store.close()
    gone = rows.join(repeated, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")) & (F.col("id") != F.col("top")), "left_semi")
    gone = gone.groupBy(F.col("id").alias("__id"), F.col("t").alias("__t")).agg(F.collect_set("pos").alias("__gone"))

    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in {n.lower() for n in names}]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")  # apart from the names used here
    whole = docs.select(row, id_.alias("did"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), F.xxhash64(F.col(f"`{text_col}`")).alias("dt"))
    joined = whole.join(gone, (F.col("did") == F.col("__id")) & (F.col("dt") == F.col("__t")), "left").withColumn("lines", F.split("text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda p: F.get(F.col("lines"), p)), "\n"))
    new = [text, F.size("lines").cast("long"), F.coalesce(F.size("__gone"), F.lit(0)).cast("long")]
    return joined.select(*[F.col("row").getField(c).alias(c) for c in kept], *[x.alias(n) for x, n in zip(new, names, strict=True)])
