"""Estimates for missing colours, planet radii and temperatures, with their provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.config import CatalogConfig
from orrery.functions.astro import cell, magnitude_bin
from orrery.functions.inference import FALLBACK_COLOR, radius, tag, temperature
from orrery.operators.selection import grouped_median
from orrery.schemas import INFERRED, OBSERVED

_CELL = ["ix", "iy", "iz"]


def with_cells(stars: DataFrame, config: CatalogConfig = CatalogConfig()) -> DataFrame:
    return stars.withColumns({i: cell(F.col(c), config.chunk_size) for i, c in zip(_CELL, "xyz", strict=True)})


def bin_medians(stars: DataFrame, config: CatalogConfig = CatalogConfig(), by_selection: bool = False) -> DataFrame:
    """``ix, iy, iz, mag_bin, n, median_bp_rp``: exact medians of the observed colours by cell and half magnitude.

    The aggregate holds a bin's different colours in one task; ``by_selection`` doesn't, see ``grouped_median``.
    """
    rows = with_cells(stars, config).where("bp_rp is not null and not isnan(bp_rp)").withColumn("mag_bin", magnitude_bin(F.col("magnitude")))
    if by_selection:
        return grouped_median(rows, [*_CELL, "mag_bin"], "bp_rp").withColumnRenamed("median", "median_bp_rp")
    kind = stars.schema["bp_rp"].dataType
    return rows.groupBy(*_CELL, "mag_bin").agg(F.count("*").alias("n"), F.median("bp_rp").cast(kind).alias("median_bp_rp"))


def impute_colors(stars: DataFrame, config: CatalogConfig = CatalogConfig(), medians: DataFrame | None = None) -> DataFrame:
    """Stars with ``filled_bp_rp``: observed, else the median of its bin, the bin above, the bin below, else null.

    The bins are few (a row a cell and half magnitude) and offer their values beforehand, so that the stars are joined
    once; Spark broadcasts the bins if it finds them small, else both sides shuffle on cell and bin. ``medians`` are those of
    ``bin_medians``, if the caller has them from a cheaper table of the same stars.
    """
    placed = with_cells(stars, config).withColumn("mag_bin", magnitude_bin(F.col("magnitude")))
    medians = bin_medians(stars, config) if medians is None else medians
    # One row a bin with its own and its neighbours' values, so that the stars join once.
    offered = medians.select(*_CELL, F.explode(F.array(*[F.struct((F.col("mag_bin") - d).alias("mag_bin"), F.lit(i).alias("rank"), F.col("median_bp_rp").alias("v")) for i, d in enumerate((0, 1, -1))])).alias("o"))
    offered = offered.groupBy(*_CELL, F.col("o.mag_bin").alias("mag_bin")).agg(F.min_by("o.v", "o.rank").alias("guess"))
    return placed.join(offered, [*_CELL, "mag_bin"], "left").withColumn("filled_bp_rp", F.coalesce("bp_rp", "guess")).drop("guess", "mag_bin")


def _planet(p: Column, color: Column) -> Column:
    return F.struct(
        p["planet_name"].alias("planet_name"),
        p["semi_major_au"].alias("semi_major_au"),
        p["period_days"].alias("period_days"),
        radius(p["radius_earth"], p["period_days"]).alias("radius_earth"),
        temperature(p["eq_temp_kelvin"], color, p["semi_major_au"]).alias("eq_temp_kelvin"),
        tag(p["radius_earth"]).alias("quality"),
        tag(p["eq_temp_kelvin"]).alias("eq_temp_quality"),
    )


def infer(stars: DataFrame, config: CatalogConfig = CatalogConfig(), medians: DataFrame | None = None) -> DataFrame:
    """Catalog stars from stars with ``planets``; planets are mapped within their array, without a shuffle.

    ``quality`` counts a colour filled from a bin as observed, as catalogs of this form do; ``color_quality`` doesn't.
    Planet temperatures use the filled colour, not the fallback.
    """
    filled = impute_colors(stars, config, medians)
    color = F.col("filled_bp_rp")
    return filled.select(
        "source_id", "x", "y", "z", "magnitude",
        F.coalesce(color, F.lit(FALLBACK_COLOR)).alias("color_index"),
        (F.size("planets") > 0).alias("has_planets"),
        tag(color).alias("quality"),
        tag(F.col("bp_rp")).alias("color_quality"),
        F.transform("planets", lambda p: _planet(p, color)).alias("planets"),
        *_CELL,
    )


def without_planets(stars: DataFrame, config: CatalogConfig = CatalogConfig()) -> DataFrame:
    """Catalog stars of a run without planet input: no bins, only the fallback colour; missing coordinates are 0."""
    placed = with_cells(stars.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in "xyz"}), config)
    return placed.select(
        "source_id", "x", "y", "z", "magnitude",
        F.coalesce("bp_rp", F.lit(FALLBACK_COLOR)).alias("color_index"),
        F.lit(False).alias("has_planets"),
        tag(F.col("bp_rp")).alias("quality"),
        tag(F.col("bp_rp")).alias("color_quality"),
        *_CELL,
    )


def counter_metrics() -> list[Column]:
    """Counts over catalog stars: inferred colours, and over attached planets inferred radii and temperatures, and failures."""
    planets = lambda cond: F.coalesce(F.sum(F.size(F.filter("planets", cond))), F.lit(0)).cast("bigint")
    guessed = lambda p: p["eq_temp_quality"] == INFERRED
    return [
        F.count_if((F.col("color_quality") == INFERRED) & (F.col("quality") == OBSERVED)).alias("bp_rp_inferred"),
        planets(lambda p: p["quality"] == INFERRED).alias("radius_inferred"),
        F.coalesce(F.sum(F.lit(0)), F.lit(0)).cast("bigint").alias("radius_unresolvable"),  # every period has a radius
        planets(lambda p: guessed(p) & p["eq_temp_kelvin"].isNotNull()).alias("temp_inferred"),
        planets(lambda p: guessed(p) & p["eq_temp_kelvin"].isNull()).alias("temp_unresolvable"),
    ]


def inference_counters(catalog: DataFrame) -> DataFrame:
    """One row of ``counter_metrics``, by one pass."""
    return catalog.agg(*counter_metrics())
