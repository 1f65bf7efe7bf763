"""Resumable stages: a table and a marker that names parameters and inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from orrery.sources.storage import delete, read_text, write_text


def is_complete(spark: SparkSession, folder: str, stage: str, fingerprint: str) -> bool:
    return read_text(spark, f"{folder}/{stage}.checkpoint") == fingerprint


def staged(spark: SparkSession, folder: str, stage: str, fingerprint: str, resume: bool, make: Callable[[], DataFrame]) -> DataFrame:
    """The stage's table: read if ``resume`` and its marker fits, else made, written and marked.

    The marker goes before its table is replaced, so a run that fails leaves a stage to be made again and never a marked half.
    """
    path, marker = f"{folder}/{stage}.parquet", f"{folder}/{stage}.checkpoint"
    if not (resume and is_complete(spark, folder, stage, fingerprint)):
        delete(spark, marker)
        make().write.mode("overwrite").parquet(path)
        write_text(spark, marker, [fingerprint])
    return spark.read.parquet(path)


def staged_with_counts(
    spark: SparkSession, folder: str, stage: str, fingerprint: str, resume: bool, make: Callable[[], DataFrame], metrics: list[Column]
) -> tuple[DataFrame, DataFrame]:
    """The stage's table as ``staged`` has it, and one row of ``metrics`` over it.

    They are observed while the table is written, in its last step, where a task that is run again counts once; only a table that was taken up is scanned for them.
    """
    seen, made = Observation(), []

    def observed() -> DataFrame:
        made.append(True)
        return make().observe(seen, *metrics)

    table = staged(spark, folder, stage, fingerprint, resume, observed)
    counts = table.agg(*metrics)
    return table, spark.createDataFrame([tuple(seen.get[c] for c in counts.columns)], counts.schema) if made else counts
