"""Stars along a Morton curve, for searches of a part of space over single stars."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.morton import cube_ranges, in_ranges, morton_key
from orrery.sources.csv_files import SourceError
from orrery.sources.storage import read_text, write_text

UNIT = 0.1  # parsecs; 2^20 of it are 104 kpc, beyond the farthest star that is kept
_LAYOUT = "_sky.json"


def write_sky(catalog: DataFrame, path: str, unit: float = UNIT, files: int | None = None, group_bytes: int = 16 << 20, group_rows: int | None = None) -> None:
    """The catalog in ranges of the curve, a file or more each, sorted along it: stars near each other share row groups.

    Ranges have like numbers of stars however dense a field is, as Spark samples the keys. ``files`` is their number, else
    that of shuffle partitions; row groups have up to ``group_bytes`` or ``group_rows``.
    """
    keyed = catalog.withColumn("morton", morton_key(F.col("x"), F.col("y"), F.col("z"), unit))
    ranged = keyed.repartitionByRange(*([files] if files else []), "morton", "source_id").sortWithinPartitions("morton", "source_id")
    writer = ranged.write.mode("overwrite").option("parquet.block.size", group_bytes)
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    write_text(catalog.sparkSession, f"{path}/{_LAYOUT}", [json.dumps({"unit_parsecs": unit})])


def _unit(spark: SparkSession, path: str) -> float:
    layout = read_text(spark, f"{path}/{_LAYOUT}")
    if layout is None:
        raise SourceError(f"{path} has no {_LAYOUT}")
    return json.loads(layout)["unit_parsecs"]


def stars_in_radius(spark: SparkSession, path: str, center: Sequence[float], radius: float, most_ranges: int = 64) -> DataFrame:
    """The stars at most ``radius`` parsecs from ``center``, with ``distance``: the cube's key ranges skip files and row groups, then the exact distance decides.

    A negative or NaN radius has no stars; stars without a position are in none.
    """
    ranges = cube_ranges(center, radius, _unit(spark, path), most_ranges)
    rows = spark.read.parquet(path).where(in_ranges(F.col("morton"), ranges))
    gaps = [F.col(axis) - F.lit(float(c)) for axis, c in zip("xyz", center, strict=True)]
    distance = F.sqrt(gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2])
    return rows.withColumn("distance", distance).where((F.col("distance") <= radius) & ~F.isnan("distance")).drop("morton")


def nearest_stars(spark: SparkSession, path: str, center: Sequence[float], n: int, start: float = 1.0, widest: float = 1e6) -> DataFrame:
    """The ``n`` stars nearest to ``center``, ties to the smaller id (all, if fewer): the radius is doubled until so many are inside.

    Each search reads only the row groups of its cube; the driver gets one count a search.
    """
    radius = start
    while radius < widest and stars_in_radius(spark, path, center, radius).limit(n).count() < n:
        radius *= 2
    return stars_in_radius(spark, path, center, radius).orderBy("distance", "source_id").limit(n)
