"""The catalog as one lazy plan: gates, coordinates, cross-match, estimates, chunks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.config import CatalogConfig
from orrery.functions.astro import cartesian
from orrery.operators import chunks, crossmatch, impute
from orrery.operators.quality import filter_stars


def with_coordinates(stars: DataFrame) -> DataFrame:
    """Adds x, y, z in parsecs; narrow."""
    return stars.withColumns(dict(zip("xyz", cartesian(F.col("ra"), F.col("dec_deg"), F.col("parallax")), strict=True)))


def require_coordinates(stars: DataFrame) -> DataFrame:
    """Fails the job at a star without coordinates; narrow, checked as rows pass."""
    missing = F.raise_error(F.concat(F.lit("star without coordinates: "), F.col("source_id").cast("string"))).cast("double")
    return stars.withColumns({c: F.coalesce(F.col(c), missing) for c in "xyz"})


@dataclass(frozen=True)
class Catalog:
    """Lazy tables of a run; what isn't used isn't computed."""

    stars: DataFrame  # catalog stars with their cell
    hosts: DataFrame | None = None
    matches: DataFrame | None = None
    enriched: DataFrame | None = None  # stars with raw planets

    @property
    def manifest(self) -> DataFrame:
        return chunks.chunk_metadata(self.stars)

    def register_views(self, prefix: str = "catalog") -> None:
        """Temporary views for Spark SQL: ``<prefix>_stars``, ``_chunks`` and, with planets, ``_hosts`` and ``_matches``."""
        named = {"stars": self.stars, "chunks": self.manifest, "hosts": self.hosts, "matches": self.matches}
        for name, df in named.items():
            if df is not None:
                df.createOrReplaceTempView(f"{prefix}_{name}")


def build(stars: DataFrame, planets: DataFrame | None = None, config: CatalogConfig = CatalogConfig()) -> Catalog:
    """The catalog of typed ``stars`` and, if given, ``planets``."""
    placed = with_coordinates(filter_stars(stars, config))
    if planets is None:
        return Catalog(impute.without_planets(placed, config))
    placed = require_coordinates(placed)
    few = True if crossmatch.fits(planets, config.broadcast_hosts // crossmatch.cells_of_a_host(config)) else None  # few planets have few hosts
    hosts = crossmatch.group_hosts(planets)
    matches = crossmatch.match_hosts(hosts, placed, config, few)
    enriched = crossmatch.attach_planets(placed, planets, matches, config, bool(few))
    return Catalog(impute.infer(enriched, config, impute.bin_medians(placed, config)), hosts, matches, enriched)
