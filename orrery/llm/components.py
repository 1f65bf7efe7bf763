"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import drop_scratch, written


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node of ``edges (u long, v long)``.

    Alternates large-star and small-star steps until the edges are stars. A step takes minima by node
    (combined before the shuffle) and joins them back, so no node's neighbours meet in one row. Every
    round is a table in the shared folder. Loops and repeated edges do no harm; nulls are left out.
    """
    now = written(edges.dropna().where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    digest = _digest(now)
    while digest[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")
        drop_scratch(now)
        now, before, digest = after, digest, _digest(after)
        if digest == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
