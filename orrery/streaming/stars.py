"""The row-wise stages on a stream of stars, and running counts by chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.config import CatalogConfig
from orrery.operators.impute import without_planets
from orrery.operators.quality import checked
from orrery.plans.catalog import with_coordinates


def stream_catalog(stars: DataFrame, config: CatalogConfig = CatalogConfig()) -> DataFrame:
    """Gates, coordinates, fallback colours and cells; the same plan for batches and streams, without state."""
    kept = checked(stars, config).where("skip_reason is null").drop("skip_field", "skip_reason")
    return without_planets(with_coordinates(kept), config)


def stream_rejects(stars: DataFrame, config: CatalogConfig = CatalogConfig()) -> DataFrame:
    return checked(stars, config).where("skip_reason is not null").select("source_id", F.col("skip_field").alias("field"), F.col("skip_reason").alias("reason"))


def running_chunk_counts(stars: DataFrame, config: CatalogConfig = CatalogConfig()) -> DataFrame:
    """Stars by chunk so far; a stateful aggregation for the modes update and complete."""
    return stream_catalog(stars, config).groupBy("ix", "iy", "iz").agg(F.count("*").alias("star_count"), F.count_if(F.col("quality") == "Observed").alias("observed_count"))
