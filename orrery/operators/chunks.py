"""Chunks of the catalog: metadata, manifest, lookups and validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.astro import chunk_file
from orrery.schemas import INFERRED, OBSERVED, SYNTHETIC

KEY = ["ix", "iy", "iz"]
AABB_SLACK = 0.001  # parsecs


def metadata_aggregates() -> list[Column]:
    """Counts and the bounding box of a chunk's stars. NaN coordinates don't widen a box."""
    real = lambda c: F.when(~F.isnan(c), F.col(c))
    count = lambda cond, name: F.count_if(cond).alias(name)
    return [
        F.count("*").alias("star_count"),
        count(F.col("has_planets"), "planet_star_count"),
        *[count(F.col("quality") == q, f"{q.lower()}_count") for q in (OBSERVED, INFERRED, SYNTHETIC)],
        *[f(real(c)).alias(f"{name}_{c}") for name, f in (("min", F.min), ("max", F.max)) for c in "xyz"],
    ]


def with_file_names(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("file_name", chunk_file(*map(F.col, KEY)))


def chunk_metadata(catalog: DataFrame) -> DataFrame:
    """One row a chunk, from one aggregation: counts and the bounding box."""
    return with_file_names(catalog.groupBy(*KEY).agg(*metadata_aggregates()))


def manifest_totals(chunks: DataFrame) -> DataFrame:
    """``total_stars``, ``total_planets`` (stars that host planets) and the number of chunks."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return chunks.agg(total("star_count").alias("total_stars"), total("planet_star_count").alias("total_planets"), F.count("*").alias("n_chunks"))


def quality_distribution(chunks: DataFrame) -> DataFrame:
    """``quality, n, percent`` over all stars."""
    names = (OBSERVED, INFERRED, SYNTHETIC)
    sums = chunks.agg(*[F.coalesce(F.sum(f"{q.lower()}_count"), F.lit(0)).alias(q) for q in names])
    total = sum((F.col(q) for q in names[1:]), F.col(names[0]))
    rows = sums.select(F.explode(F.array(*[F.struct(F.lit(q).alias("quality"), F.col(q).cast("bigint").alias("n"), total.alias("total")) for q in names])).alias("r"))
    return rows.select("r.quality", "r.n", F.round(100.0 * F.col("r.n") / F.greatest("r.total", F.lit(1)), 1).alias("percent"))


def chunk_by_id(chunks: DataFrame, ix: int, iy: int, iz: int) -> DataFrame:
    """The chunk's row, or none."""
    return chunks.where((F.col("ix") == ix) & (F.col("iy") == iy) & (F.col("iz") == iz)).limit(1)


def chunks_in_radius(chunks: DataFrame, center: Sequence[float], radius: float, chunk_size: float | None = None, exact_sphere: bool = False) -> DataFrame:
    """Chunks whose box meets the cube of half side ``radius`` around ``center`` (touching counts), or the sphere itself.

    With ``chunk_size`` the cells are bounded too, which prunes partitions of a table partitioned by them.
    """
    if radius < 0:
        return chunks.limit(0)
    out = chunks
    for axis, c, i in zip("xyz", center, KEY, strict=True):
        out = out.where((F.col(f"min_{axis}") <= c + radius) & (F.col(f"max_{axis}") >= c - radius))
        if chunk_size is not None:
            out = out.where(F.col(i).between(int((c - radius) // chunk_size), int((c + radius) // chunk_size)))
    if exact_sphere:
        gap = [F.greatest(F.col(f"min_{a}") - c, c - F.col(f"max_{a}"), F.lit(0.0)) for a, c in zip("xyz", center, strict=True)]
        out = out.where(gap[0] * gap[0] + gap[1] * gap[1] + gap[2] * gap[2] <= radius * radius)
    return out


def sol_sample(catalog: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` stars of the chunk at the origin, by id, with ``n_planets``."""
    n_planets = F.size("planets") if "planets" in catalog.columns else F.lit(0)
    return catalog.where("ix = 0 and iy = 0 and iz = 0").withColumn("n_planets", n_planets.cast("bigint")).orderBy("source_id").limit(n)


def verify(manifest: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row a chunk of either side: its counts, stars outside its box (a little slack admitted), ``count_ok``, ``aabb_ok``,
    and ``stray``, the first star outside by id with its position.

    The stars are joined with the box of their chunk (broadcast only if Spark finds the manifest small) and
    aggregated once; chunks that only one side has are found by the outer join.
    """
    box = manifest.select(*KEY, "star_count", *[f"{m}_{c}" for m in ("min", "max") for c in "xyz"])
    outside: Column = F.lit(False)
    for c in "xyz":
        outside = outside | (F.col(c) < F.col(f"min_{c}") - AABB_SLACK) | (F.col(c) > F.col(f"max_{c}") + AABB_SLACK)
    stray = F.min(F.when(outside, F.struct("source_id", "x", "y", "z"))).alias("stray")
    held = catalog.select(*KEY, "source_id", "x", "y", "z").join(box, KEY, "left").groupBy(*KEY).agg(F.count("*").alias("found"), F.count_if(outside).alias("outside"), stray)
    both = manifest.select(*KEY, "star_count").join(held, KEY, "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    out = both.select(*KEY, zero("star_count").alias("star_count"), zero("found").alias("found"), zero("outside").alias("outside"), "stray")
    return out.withColumns({"count_ok": F.col("star_count") == F.col("found"), "aabb_ok": F.col("outside") == 0})


def total_check(manifest: DataFrame, verified: DataFrame) -> DataFrame:
    """One row: ``total_stars`` of the manifest, ``loaded``, the stars found in chunks that the verification knows by it, and ``total_ok``."""
    loaded = verified.where("star_count > 0").agg(F.coalesce(F.sum("found"), F.lit(0)).cast("bigint").alias("loaded"))
    total = manifest_totals(manifest).select("total_stars")
    return total.join(F.broadcast(loaded), F.lit(True)).withColumn("total_ok", F.col("total_stars") == F.col("loaded"))  # one row each


def verification_errors(verified: DataFrame) -> DataFrame:
    """Only the chunks with an error."""
    return verified.where("not count_ok or not aabb_ok")
