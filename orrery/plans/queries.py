"""The registered queries of the catalog engine, each an operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.config import CatalogConfig
from orrery.functions.astro import chunk_file, distance_pc, magnitude_bin, normal_name, separation_arcsec
from orrery.functions.inference import effective_temperature, radius, tag, temperature
from orrery.operators import chunks, crossmatch, impute, quality
from orrery.operators.selection import grouped_median
from orrery.plans import compare, sinks
from orrery.plans.catalog import Catalog, build, with_coordinates
from orrery.plans.incremental import ingest
from orrery.plans.sky import nearest_stars, write_sky
from orrery.plans.sky import stars_in_radius as sky_radius
from orrery.plans.sql_functions import register
from orrery.sources import tables
from orrery.sources.csv_files import planet_rows, read_star_csv
from orrery.sources.fits_files import read_star_fits
from orrery.sources.fits_files import register as register_fits
from orrery.sources.storage import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    QUERIES[f"q_{f.__name__}"] = f
    return f


def _r(c: Column | str, name: str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name)


def _placed(spark: SparkSession, sf: str) -> DataFrame:
    return with_coordinates(quality.filter_stars(tables.stars(spark, sf)))


def _catalog(spark: SparkSession, sf: str) -> Catalog:
    return build(tables.stars(spark, sf), tables.planets(spark, sf))


def _designated(stars: DataFrame) -> DataFrame:
    """Every tenth star has a name."""
    return stars.withColumn("designation", F.when(F.col("source_id") % 10 == 0, F.concat(F.lit("GJ "), F.col("source_id").cast("string"))))


@_query
def quality_filter(spark, sf):
    return quality.filter_stars(tables.stars(spark, sf)).select("source_id", _r("parallax", "parallax"), _r(F.col("parallax") / F.col("parallax_error"), "snr"))


@_query
def skip_reasons(spark, sf):
    rows = quality.checked(tables.stars(spark, sf))
    return rows.groupBy(F.coalesce("skip_field", F.lit("kept")).alias("field"), F.coalesce("skip_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@_query
def cartesian(spark, sf):
    return _placed(spark, sf).select("source_id", _r(distance_pc(F.col("parallax")), "distance_pc"), _r("x", "x"), _r("y", "y"), _r("z", "z"))


@_query
def name_norm(spark, sf):
    return tables.planets(spark, sf).select("planet_name", normal_name(F.col("hostname")).alias("host"))


@_query
def angular_sep(spark, sf):
    sep = separation_arcsec(F.col("ra"), F.col("dec_deg"), F.lit(180.0), F.lit(10.0))
    return tables.stars(spark, sf).select("source_id", F.round(sep, 3).alias("sep_arcsec"))


@_query
def host_group(spark, sf):
    return crossmatch.group_hosts(tables.planets(spark, sf)).select("host", "n_planets", _r("ra", "ra"), _r("dec_deg", "dec_deg"))


@_query
def name_match(spark, sf):
    return crossmatch.match_names(crossmatch.group_hosts(tables.planets(spark, sf)), _designated(_placed(spark, sf)))


@_query
def proximity_match(spark, sf):
    out = crossmatch.match_nearest(crossmatch.group_hosts(tables.planets(spark, sf)), _placed(spark, sf))
    return out.select("host", "source_id", _r("sep_arcsec", "sep_arcsec"))


@_query
def proximity_dense(spark, sf):
    """The nearest star where half of all stars, and every fifth planet, lie in one field of a few arc seconds; both sides shuffle, dense cells are split."""
    config = CatalogConfig(broadcast_hosts=0, dense_cell=500)
    at = lambda k, c: F.col(c) * k % 100_003 * 1e-8
    half, fifth = F.col("source_id") % 2 == 0, F.col("row_ord") % 5 == 0
    stars = quality.filter_stars(tables.stars(spark, sf))
    stars = stars.withColumns({"ra": F.when(half, 150 + at(7919, "source_id")).otherwise(F.col("ra")), "dec_deg": F.when(half, 2 + at(104_729, "source_id")).otherwise(F.col("dec_deg"))})
    planets = tables.planets(spark, sf).where(fifth | (F.col("row_ord") % 5 == 1))
    planets = planets.withColumns({
        "hostname": F.when(fifth, F.concat(F.lit("Dense "), F.col("row_ord").cast("string"))).otherwise(F.col("hostname")),
        "ra": F.when(fifth, 150 + at(31_337, "row_ord")).otherwise(F.col("ra")),
        "dec_deg": F.when(fifth, 2 + at(27_644_437, "row_ord")).otherwise(F.col("dec_deg")),
    })
    out = crossmatch.match_nearest(crossmatch.group_hosts(planets), stars, config, few=False)
    return out.select("host", "source_id", _r("sep_arcsec", "sep_arcsec"))


@_query
def two_pass_match(spark, sf):
    return crossmatch.match_hosts(crossmatch.group_hosts(tables.planets(spark, sf)), _designated(_placed(spark, sf)))


@_query
def unmatched_hosts(spark, sf):
    c = _catalog(spark, sf)
    return crossmatch.unmatched_hosts(c.hosts, c.matches)


@_query
def match_stats(spark, sf):
    hosts = crossmatch.group_hosts(tables.planets(spark, sf))
    out = crossmatch.match_statistics(hosts, crossmatch.match_hosts(hosts, _designated(_placed(spark, sf))))
    return out.withColumn("match_rate", F.round("match_rate", 6))


@_query
def attach_planets(spark, sf):
    planets = F.col("planets")
    return _catalog(spark, sf).enriched.select("source_id", F.size(planets).cast("bigint").alias("n_planets"), F.get(planets, F.lit(0))["planet_name"].alias("first_planet"), (F.size(planets) > 0).alias("has_planets"))


@_query
def planet_estimates(spark, sf):
    rows = _catalog(spark, sf).stars.select("source_id", F.explode("planets").alias("p"))
    return rows.select("source_id", "p.planet_name", _r("p.radius_earth", "radius_earth"), _r("p.eq_temp_kelvin", "eq_temp_kelvin"), "p.quality", "p.eq_temp_quality")


@_query
def stage4_counters(spark, sf):
    c = _catalog(spark, sf)
    return impute.inference_counters(c.stars)


@_query
def no_planet_branch(spark, sf):
    return build(tables.stars(spark, sf)).stars.select("source_id", _r("color_index", "color_index"), "quality", "has_planets", "ix", "iy", "iz")


@_query
def stage12_stats(spark, sf):
    rows = quality.checked(tables.stars(spark, sf))
    kept = F.col("skip_reason").isNull()
    out = rows.agg(F.count("*").alias("total_rows"), F.count_if(~kept).alias("skipped_rows"), F.count_if(kept).alias("stars"), F.count_if(kept & F.col("bp_rp").isNotNull()).alias("with_color"))
    return out.withColumn("percent_with_color", F.round(100.0 * F.col("with_color") / F.greatest("stars", F.lit(1)), 1))


@_query
def bin_median(spark, sf):
    return impute.bin_medians(_placed(spark, sf)).select("ix", "iy", "iz", "mag_bin", "n", _r("median_bp_rp", "median_bp_rp"))


@_query
def bin_median_selection(spark, sf):
    """The same medians by distributed selection, over floats as catalogs store them."""
    placed = _placed(spark, sf).withColumn("bp_rp", F.col("bp_rp").cast("float"))
    out = impute.bin_medians(placed, by_selection=True)
    return out.select("ix", "iy", "iz", "mag_bin", "n", _r(F.col("median_bp_rp").cast("double"), "median_bp_rp"))


@_query
def magnitude_medians(spark, sf):
    """Medians of doubles over very large groups: of the parallaxes of each magnitude bin, whatever the cell."""
    rows = _placed(spark, sf).withColumn("mag_bin", magnitude_bin(F.col("magnitude")))
    return grouped_median(rows, ["mag_bin"], "parallax").select("mag_bin", "n", _r("median", "median_parallax"))


@_query
def color_impute(spark, sf):
    out = impute.impute_colors(_placed(spark, sf))
    return out.select("source_id", _r(F.coalesce("filled_bp_rp", F.lit(0.82)), "color_index"), tag(F.col("filled_bp_rp")).alias("quality"), tag(F.col("bp_rp")).alias("color_quality"))


@_query
def radius_infer(spark, sf):
    return tables.planets(spark, sf).select("planet_name", _r(radius(F.col("radius_earth"), F.col("period_days")), "radius_earth"), tag(F.col("radius_earth")).alias("quality"))


@_query
def eq_temp(spark, sf):
    color = F.when(F.col("row_ord") % 11 != 0, (F.col("row_ord") % 350) / 100.0)
    out = tables.planets(spark, sf)
    return out.select("planet_name", _r(effective_temperature(color), "star_kelvin"), _r(temperature(F.col("eq_temp_kelvin"), color, F.col("semi_major_au")), "eq_temp_kelvin"), tag(F.col("eq_temp_kelvin")).alias("quality"))


@_query
def quality_distribution(spark, sf):
    return chunks.quality_distribution(_catalog(spark, sf).manifest)


@_query
def chunk_assign(spark, sf):
    return impute.with_cells(_placed(spark, sf)).select("source_id", "ix", "iy", "iz", chunk_file(F.col("ix"), F.col("iy"), F.col("iz")).alias("file_name"))


@_query
def chunk_count(spark, sf):
    cells = impute.with_cells(_placed(spark, sf)).select("ix", "iy", "iz").distinct()
    return cells.agg(F.count("*").alias("n_chunks"))


@_query
def manifest(spark, sf):
    bounds = [_r(f"{m}_{c}", f"{m}_{c}") for m in ("min", "max") for c in "xyz"]
    return _catalog(spark, sf).manifest.select("ix", "iy", "iz", "star_count", "planet_star_count", "observed_count", "inferred_count", "synthetic_count", *bounds, "file_name").orderBy("ix", "iy", "iz")


@_query
def manifest_totals(spark, sf):
    return chunks.manifest_totals(_catalog(spark, sf).manifest)


@_query
def chunks_in_radius(spark, sf):
    return chunks.chunks_in_radius(_catalog(spark, sf).manifest, (20.0, -30.0, 10.0), 120.0, 50.0).select("ix", "iy", "iz", "star_count")


@_query
def chunk_lookup(spark, sf):
    return chunks.chunk_by_id(_catalog(spark, sf).manifest, 0, 0, 0).select("ix", "iy", "iz", "star_count", "planet_star_count")


def _damaged(manifest: DataFrame) -> DataFrame:
    """A manifest with faults to find: wrong counts where ix is a multiple of 3, too small a box where iy is one of 4, no chunk where iz is 2."""
    return manifest.where("iz <> 2").withColumns({"star_count": F.col("star_count") + F.when(F.col("ix") % 3 == 0, 1).otherwise(0), "max_x": F.col("max_x") - F.when(F.col("iy") % 4 == 0, 0.5).otherwise(0.0)})


@_query
def verify_counts(spark, sf):
    c = _catalog(spark, sf)
    return chunks.verify(_damaged(c.manifest), c.stars).select("ix", "iy", "iz", "star_count", "found", "count_ok")


@_query
def verify_aabb(spark, sf):
    c = _catalog(spark, sf)
    out = chunks.verify(_damaged(c.manifest), c.stars)
    return out.select("ix", "iy", "iz", "outside", "aabb_ok", F.coalesce("stray.source_id", F.lit(-1)).alias("stray_id"), _r(F.coalesce("stray.x", F.lit(0.0)), "stray_x"))


@_query
def verify_total(spark, sf):
    """The manifest's total against the stars that its chunks hold."""
    c = _catalog(spark, sf)
    return chunks.total_check(c.manifest, chunks.verify(_damaged(c.manifest), c.stars))


@_query
def csv_stars(spark, sf):
    """Stars written as CSV, some of them damaged, and read again: what is kept, and why the others aren't."""
    folder = scratch_folder(spark, "stars.csv")
    raw = tables.stars(spark, sf)
    at = lambda k, c, wrong: F.when(F.col("source_id") % k == 0, F.lit(wrong)).otherwise(F.col(c).cast("string"))
    text = raw.select("source_id", at(11, "ra", "12h").alias("ra"), F.col("dec_deg").alias("dec"), at(13, "parallax", "").alias("parallax"), "parallax_error", at(17, "magnitude", "1e400x").alias("phot_g_mean_mag"), at(5, "bp_rp", " none").alias("bp_rp"))
    text.write.csv(folder, header=True)
    parsed = quality.parse_stars(read_star_csv(spark, folder))
    return parsed.select("source_id", _r("ra", "ra"), _r("parallax", "parallax"), _r(F.col("bp_rp").cast("double"), "bp_rp"), "skip_field", "skip_reason")


@_query
def csv_rejects(spark, sf):
    """Stars written as CSV, some lines with a field too many and some stars beyond 100 kpc, and read again: rows by what became of them."""
    folder = scratch_folder(spark, "rejects.csv")
    every = lambda k: F.col("source_id") % k == 0
    text = _star_csv(tables.stars(spark, sf)).withColumns({
        "parallax": F.when(every(29), 0.005).otherwise(F.col("parallax")),
        "parallax_error": F.when(every(29), 0.0005).otherwise(F.col("parallax_error")),
        "dec": F.when(every(23), F.concat(F.col("dec").cast("string"), F.lit(",7"))).otherwise(F.col("dec").cast("string")),
    })
    text.write.option("quote", "\u0000").csv(folder, header=True)
    parsed = quality.parse_stars(read_star_csv(spark, folder))
    return parsed.groupBy(F.coalesce("skip_field", F.lit("kept")).alias("field"), F.coalesce("skip_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@_query
def fits_stars(spark, sf):
    """Stars written as FITS binary tables, some of their values missing, and read again by ranges of rows: what is kept, and why the others aren't."""
    folder = scratch_folder(spark, "stars.fits")
    register_fits(spark)
    lost = lambda k, c: F.when(F.col("source_id") % k != 0, F.col(c))
    rows = tables.stars(spark, sf).select(
        "source_id",
        lost(11, "ra").alias("ra"),
        F.col("dec_deg").alias("dec"),
        lost(13, "parallax").alias("parallax"),
        "parallax_error",
        lost(17, "magnitude").cast("float").alias("phot_g_mean_mag"),
        lost(5, "bp_rp").cast("float").alias("bp_rp"),
    )
    rows.write.format("fits").mode("append").save(folder)
    judged = quality.judged(read_star_fits(spark, folder))
    return judged.select("source_id", _r("ra", "ra"), _r("parallax", "parallax"), _r(F.col("bp_rp").cast("double"), "bp_rp"), "skip_field", "skip_reason")


@_query
def csv_planets(spark, sf):
    """Planets written as CSV, some of them damaged, and read again: the usable ones."""
    folder = scratch_folder(spark, "planets.csv")
    raw = tables.planets(spark, sf)
    lost = lambda k, c: F.when(F.col("row_ord") % k != 0, F.col(c))
    text = raw.select(F.col("planet_name").alias("PL_NAME"), lost(7, "hostname").alias("hostname"), "ra", F.col("dec_deg").alias("dec"), lost(11, "semi_major_au").alias("pl_orbsmax"), lost(13, "period_days").alias("pl_orbper"), F.col("radius_earth").alias("pl_rade"), F.col("eq_temp_kelvin").alias("pl_eqt"), F.lit("Transit").alias("discoverymethod"))
    text.write.csv(folder, header=True)
    rows = planet_rows(spark, folder)
    return rows.select("planet_name", normal_name(F.col("hostname")).alias("host"), _r(F.col("semi_major_au").cast("double"), "semi_major_au"), _r(F.col("radius_earth").cast("double"), "radius_earth"), "usable")


@_query
def chunk_files(spark, sf):
    """A catalog written by regions with its manifest, and the chunk at the origin opened by its file name."""
    folder = scratch_folder(spark, "catalog")
    config = CatalogConfig()
    stars = build(tables.stars(spark, sf)).stars
    sinks.write_catalog(stars, folder, config)
    out = sinks.open_chunk(spark, folder, "catalog_0_0_0.bin")
    return out.select("source_id", _r("x", "x"), _r("y", "y"), _r("z", "z"), _r("color_index", "color_index"), "quality")


def _star_csv(stars: DataFrame) -> DataFrame:
    """Stars in the columns of their CSV files."""
    return stars.select(
        "source_id", "ra", F.col("dec_deg").alias("dec"), "parallax", "parallax_error", F.col("magnitude").alias("phot_g_mean_mag"), "bp_rp"
    )


def _planet_csv(planets: DataFrame) -> DataFrame:
    """Planets in the columns of their CSV file, in order."""
    named = {"planet_name": "pl_name", "hostname": "hostname", "ra": "ra", "dec_deg": "dec", "semi_major_au": "pl_orbsmax", "period_days": "pl_orbper", "radius_earth": "pl_rade", "eq_temp_kelvin": "pl_eqt"}
    return planets.orderBy("row_ord").select(*[F.col(c).alias(name) for c, name in named.items()], F.lit("Transit").alias("discoverymethod"))


@_query
def incremental_manifest(spark, sf):
    """A catalog ingested in two batches of files: near stars first, then all others; its manifest is that of one build. Spark's names of files are no order of stars, so equally near ones go by their id."""
    folder = scratch_folder(spark, "incremental")
    _planet_csv(tables.planets(spark, sf)).write.csv(f"{folder}/planets", header=True)
    raw, near = tables.stars(spark, sf), F.col("parallax") >= 40
    for part in (raw.where(near), raw.where(~near)):
        _star_csv(part).write.mode("append").csv(f"{folder}/stars", header=True)
        ingest(spark, f"{folder}/stars", f"{folder}/catalog", f"{folder}/planets", by_id=True)
    bounds = [_r(f"{m}_{c}", f"{m}_{c}") for m in ("min", "max") for c in "xyz"]
    out = spark.read.parquet(f"{folder}/catalog/manifest.parquet")
    return out.select("ix", "iy", "iz", "star_count", "planet_star_count", "observed_count", "inferred_count", "synthetic_count", *bounds, "file_name")


@_query
def content_diff(spark, sf):
    """A catalog against another with fainter, missing and new stars, found by their trees of digests."""
    folder, config = scratch_folder(spark, "content"), CatalogConfig()
    stars = build(tables.stars(spark, sf)).stars
    by = lambda k: F.col("source_id") % k
    other = stars.where(by(101) != 7).withColumn("magnitude", F.col("magnitude") + F.when(by(97) == 5, 0.25).otherwise(0.0))
    new = stars.where(by(89) == 11).withColumn("source_id", -F.col("source_id"))
    sinks.write_catalog(stars, f"{folder}/one", config)
    sinks.write_catalog(other.unionByName(new), f"{folder}/other", config)
    return compare.unequal_stars(spark, f"{folder}/one", f"{folder}/other")


@_query
def content_damage(spark, sf):
    """Chunks of a written catalog whose stars were replaced by others with the same counts and boxes."""
    folder, config = scratch_folder(spark, "damage"), CatalogConfig()
    stars = build(tables.stars(spark, sf)).stars
    sinks.write_catalog(stars, folder, config)
    swapped = stars.withColumn("color_index", F.col("color_index") + F.when(F.col("source_id") % 1009 == 3, 0.01).otherwise(0.0))
    sinks.write_chunks(swapped, f"{folder}/chunks", config)
    return compare.damaged_chunks(spark, folder)


@_query
def stars_in_radius(spark, sf):
    """Stars along a Morton curve, and those of a sphere by ranges of keys."""
    folder = scratch_folder(spark, "sky")
    write_sky(build(tables.stars(spark, sf)).stars, folder)
    out = sky_radius(spark, folder, (20.0, -30.0, 10.0), 40.0)
    return out.select("source_id", _r("x", "x"), _r("y", "y"), _r("z", "z"), _r("distance", "distance"))


@_query
def nearest_to_point(spark, sf):
    folder = scratch_folder(spark, "sky")
    write_sky(build(tables.stars(spark, sf)).stars, folder)
    return nearest_stars(spark, folder, (20.0, -30.0, 10.0), 25).select("source_id", _r("distance", "distance"))


@_query
def sql_chunks_in_radius(spark, sf):
    """The radius query in SQL alone, by a table function."""
    register(_catalog(spark, sf), spark)
    return spark.sql("SELECT * FROM chunks_in_radius(20D, -30D, 10D, 120D)")


@_query
def sql_angular_sep(spark, sf):
    """Separations and distances in SQL alone."""
    register(build(tables.stars(spark, sf)), spark)
    tables.stars(spark, sf).createOrReplaceTempView("raw_stars")
    return spark.sql("SELECT source_id, round(angle_between(ra, dec_deg, 180D, 10D), 3) AS sep_arcsec FROM raw_stars")


@_query
def sql_cone_search(spark, sf):
    """The stars in a cone of ten degrees, joined with their chunk, in SQL alone."""
    register(build(tables.stars(spark, sf)), spark)
    return spark.sql(
        "SELECT source_id, round(angle_arcsec, 3) AS angle_arcsec, ix, iy, iz FROM cone_search(150D, 20D, 36000D) JOIN catalog_stars USING (source_id)"
    )


@_query
def sol_sample(spark, sf):
    out = chunks.sol_sample(_catalog(spark, sf).stars)
    return out.select("source_id", _r("x", "x"), _r("y", "y"), _r("z", "z"), "magnitude", _r("color_index", "color_index"), "quality", "has_planets", "n_planets")
