"""Written catalogs against each other and against the digests that they were written with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators import content
from orrery.operators.chunks import KEY
from orrery.plans import sinks
from orrery.sources.csv_files import SourceError
from orrery.sources.storage import scratch_folder


def _axis(spark: SparkSession, path: str) -> int:
    return sinks.layout(spark, f"{path}/chunks")["chunks_per_partition_axis"]


def _kept(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Stored, so that Spark knows how few they are and prunes folders by them."""
    df.withColumn("n", F.lit(1)).write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}").where("n > 0").drop("n")


def _in_regions(rows: DataFrame, regions: DataFrame) -> DataFrame:
    wanted = regions.select(F.concat_ws("_", *KEY).alias("region"))
    return rows.join(wanted, "region", "left_semi")


def unequal_chunks(spark: SparkSession, first: str, second: str) -> tuple[DataFrame, DataFrame]:
    """``ix, iy, iz`` of the chunks whose stars differ, and of their regions.

    The trees are descended from the root: of each level only the children of unequal nodes are compared, and only the chunk states
    of unequal regions are read. Equal roots end it at once. No star is read.
    """
    axis = _axis(spark, first)
    if _axis(spark, second) != axis:
        raise SourceError("the catalogs have different layouts")
    folder = scratch_folder(spark, "unequal")
    trees = [spark.read.parquet(f"{p}/nodes") for p in (first, second)]
    at = None
    for level in range(content.LEVELS + 1, 0, -1):
        sides = [t.where(F.col("level") == level) for t in trees]
        if at is not None:
            sides = [content.below(s, at, axis, root=level == content.LEVELS) for s in sides]
        at = _kept(content.unequal(*sides), folder, f"level-{level}")
    states = [content.below(_in_regions(sinks.read_states(spark, p), at), at, axis) for p in (first, second)]
    return _kept(content.unequal(*states), folder, "chunks"), at


def _stars(spark: SparkSession, path: str, chunks: DataFrame, regions: DataFrame) -> DataFrame:
    """The stars of ``chunks``, which lie in ``regions``; other folders aren't read."""
    places = regions.select(*[F.col(i).alias(r) for i, r in zip(KEY, sinks.REGION, strict=True)])
    rows = spark.read.parquet(f"{path}/chunks").join(places, sinks.REGION, "left_semi")
    return rows.join(chunks, KEY, "left_semi").drop(*sinks.REGION)


def _tasks(spark: SparkSession, paths: list[str], chunks: DataFrame, most: int) -> int:
    """In how many tasks the stars of ``chunks`` are compared, about ``most`` a task; counted by the chunks' states."""
    n = 0
    for path in paths:
        n += sinks.read_states(spark, path).join(chunks, KEY, "left_semi").agg(F.sum("star_count")).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // most))


def unequal_stars(spark: SparkSession, first: str, second: str, most: int = 250_000) -> DataFrame:
    """``source_id, ix, iy, iz, kind`` of the stars that were added, removed or changed from the first catalog to the second; a task compares about ``most``."""
    chunks, regions = unequal_chunks(spark, first, second)
    tasks = _tasks(spark, [first, second], chunks, most)
    return content.star_changes(_stars(spark, first, chunks, regions), _stars(spark, second, chunks, regions), tasks)


def damaged_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``ix, iy, iz`` of the chunks whose stars aren't those that the catalog was written with; reads all stars once."""
    return content.unequal(sinks.read_states(spark, path), content.chunk_states(spark.read.parquet(f"{path}/chunks")))


def damaged_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``level, ix, iy, iz`` of the tree's nodes that don't follow from the chunk states; reads no star."""
    stored, axis = spark.read.parquet(f"{path}/nodes"), _axis(spark, path)
    made, out = content.nodes(sinks.read_states(spark, path), axis), None
    for level in range(1, content.LEVELS + 2):
        rows = content.unequal(*(t.where(F.col("level") == level) for t in (stored, made))).select(F.lit(level).alias("level"), *KEY)
        out = rows if out is None else out.unionByName(rows)
    return out
