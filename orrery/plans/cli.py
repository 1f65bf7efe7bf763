"""Command line: ``python -m orrery.plans.cli build ...``, ``... ingest ...``, ``... verify ...`` and ``... diff ...``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.config import CatalogConfig
from orrery.operators import chunks, crossmatch, impute, quality
from orrery.plans import compare, sinks
from orrery.plans.catalog import require_coordinates, with_coordinates
from orrery.plans.checkpoint import staged, staged_with_counts
from orrery.plans.incremental import ingest
from orrery.sources.csv_files import planet_counts, planet_rows, read_planet_csv, read_star_csv
from orrery.sources.fits_files import read_star_fits
from orrery.sources.storage import file_states


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="orrery", description="Builds and verifies a chunked star catalog.")
    commands = out.add_subparsers(dest="command", required=True)
    build, default = commands.add_parser("build"), CatalogConfig()
    ingest_ = commands.add_parser("ingest", help="bring a catalog up to its input files; writes only regions that new, changed or removed files touch")
    for command in (build, ingest_):
        command.add_argument("--gaia-path", required=True, help="a CSV file or a folder of them")
        command.add_argument("--output-path", required=True)
        command.add_argument("--exoplanet-path")
        command.add_argument("--parallax-snr", type=float, default=default.parallax_snr)
        command.add_argument("--proximity-arcsec", type=float, default=default.proximity_arcsec)
        command.add_argument("--proximity-mag-tolerance", type=float, default=default.proximity_mag_tolerance)
        command.add_argument("--chunk-size", type=float, default=default.chunk_size)
    build.add_argument("--resume", action="store_true", help="take up stages that are complete for the same parameters and inputs (paths, lengths, times of change)")
    build.add_argument("--stats", action="store_true")
    build.add_argument("--gaia-format", choices=["csv", "fits"], default="csv", help="fits: binary tables with the columns of the CSV files")
    check = commands.add_parser("verify")
    check.add_argument("--output-path", required=True)
    check.add_argument("--content", action="store_true", help="also compare every chunk's stars with the digest that it was written with")
    diff = commands.add_parser("diff", help="list the stars that differ between two catalogs; reads only regions whose digests differ")
    diff.add_argument("--output-path", required=True)
    diff.add_argument("--other", required=True)
    return out


def _config(args: argparse.Namespace) -> CatalogConfig:
    return CatalogConfig(args.parallax_snr, args.proximity_arcsec, args.proximity_mag_tolerance, args.chunk_size)


def _stars(spark: SparkSession, args: argparse.Namespace, config: CatalogConfig) -> DataFrame:
    if args.gaia_format == "fits":
        return quality.judged(read_star_fits(spark, args.gaia_path), config)
    return quality.parse_stars(read_star_csv(spark, args.gaia_path), config)


def build_catalog(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Runs all stages, writes the outputs and returns one row of statistics."""
    config = _config(args)
    out = args.output_path.rstrip("/")
    inputs = [file_states(spark, p) for p in (args.gaia_path, args.exoplanet_path) if p]
    mark = config.fingerprint(json.dumps([args.gaia_path, args.exoplanet_path, inputs]))
    read = lambda: _stars(spark, args, config)
    parsed, stats = staged_with_counts(spark, out, "parsed", mark, args.resume, read, quality.parse_metrics())
    sinks.write_rejects(quality.rejects(parsed), f"{out}/rejects")
    placed = require_coordinates(with_coordinates(quality.kept_stars(parsed)))
    stats = stats.withColumn("percent_with_color", F.round(100.0 * F.col("stars_with_color") / F.greatest("stars", F.lit(1)), 1))
    if args.exoplanet_path:
        planets = read_planet_csv(spark, args.exoplanet_path)
        hosts = crossmatch.group_hosts(planets)
        matches = staged(spark, out, "matches", mark, args.resume, lambda: crossmatch.match_hosts(hosts, placed, config))
        sinks.write_unmatched(crossmatch.unmatched_hosts(hosts, matches), f"{out}/unmatched_hosts.txt")
        enriched = crossmatch.attach_planets(placed, planets, matches, config)
        inferred = lambda: impute.infer(enriched, config, impute.bin_medians(placed, config, by_selection=True))
        catalog, counters = staged_with_counts(spark, out, "catalog", mark, args.resume, inferred, impute.counter_metrics())
        stats = stats.join(planet_counts(planet_rows(spark, args.exoplanet_path)), F.lit(True))
        stats = stats.join(crossmatch.match_statistics(hosts, matches), F.lit(True)).join(counters, F.lit(True))  # one row each
    else:
        catalog = staged(spark, out, "catalog", mark, args.resume, lambda: impute.without_planets(placed, config))
    sinks.write_catalog(catalog, out, config)
    return stats.join(chunks.manifest_totals(spark.read.parquet(f"{out}/manifest.parquet")), F.lit(True))


def verify_catalog(spark: SparkSession, output_path: str) -> DataFrame:
    """Every chunk of a written catalog against its manifest, see ``chunks.verify``."""
    out = output_path.rstrip("/")
    return chunks.verify(sinks.read_manifest(spark, f"{out}/manifest.json"), sinks.read_chunks(spark, f"{out}/chunks"))


def print_manifest(spark: SparkSession, out: str) -> None:
    """Totals, qualities and the chunk at the origin, by the manifest's table; no star is read."""
    manifest, size = spark.read.parquet(f"{out}/manifest.parquet"), sinks.layout(spark, f"{out}/chunks")["chunk_size_parsecs"]
    totals = chunks.manifest_totals(manifest).first()
    print(f"Manifest: {totals['total_stars']} stars, {totals['n_chunks']} chunks of {size} pc")
    for r in chunks.quality_distribution(manifest).collect():  # three rows
        print(f"{r['quality']}: {r['n']} ({r['percent']:.1f} %)")
    sol = chunks.chunk_by_id(manifest, 0, 0, 0).collect()
    print(f"Sol chunk: {sol[0]['star_count']} stars, {sol[0]['planet_star_count']} with planets" if sol else "Sol chunk: not in the manifest")


def run_verify(spark: SparkSession, out: str) -> int:
    """Prints every error and what was verified; 1 if there is any."""
    head = sinks.read_manifest_head(spark, f"{out}/manifest.json")
    verified = verify_catalog(spark, out).persist()
    try:
        found = 0
        for found, r in enumerate(chunks.verification_errors(verified).orderBy(*chunks.KEY).toLocalIterator(), start=1):
            name = f"chunk {r['ix']}_{r['iy']}_{r['iz']}"
            if not r["count_ok"]:
                print(f"{name}: manifest {r['star_count']}, found {r['found']}")
            if not r["aabb_ok"]:
                s = r["stray"]
                print(f"{name}: {r['outside']} stars outside its box, the first {s['source_id']} at ({s['x']:.3f}, {s['y']:.3f}, {s['z']:.3f})")
        if found:
            print(f"{found} faulty chunks")
            return 1
        n, loaded = verified.agg(F.count("*"), F.coalesce(F.sum("found"), F.lit(0))).first()
    finally:
        verified.unpersist()
    if loaded != head["total_stars"]:
        print(f"total: manifest {head['total_stars']}, found {loaded}")
        return 1
    print(f"{n} chunks verified, {loaded} stars")
    sample = chunks.sol_sample(sinks.read_chunks(spark, f"{out}/chunks")).collect()  # three rows
    for r in sample:
        print(f"Sol chunk: star {r['source_id']} at ({r['x']:.3f}, {r['y']:.3f}, {r['z']:.3f}), magnitude {r['magnitude']:.2f}, colour {r['color_index']:.2f}, {r['n_planets']} planets")
    if not sample:
        print("Sol chunk: not in this catalog")
    return 0


def run_content_check(spark: SparkSession, out: str) -> int:
    """Prints every chunk whose stars aren't those that were written; 1 if there is any."""
    found = 0
    for found, r in enumerate(compare.damaged_chunks(spark, out).orderBy(*chunks.KEY).toLocalIterator(), start=1):
        print(f"chunk {r['ix']}_{r['iy']}_{r['iz']}: other stars than were written")
    for r in compare.damaged_nodes(spark, out).toLocalIterator():
        found += 1
        print(f"tree: level {r['level']}, node {r['ix']}_{r['iy']}_{r['iz']} doesn't follow from the chunks")
    print("content verified" if not found else f"{found} faults of content")
    return int(found > 0)


def run_diff(spark: SparkSession, out: str, other: str) -> int:
    """Prints every star that differs; 1 if there is any."""
    found = 0
    for found, r in enumerate(compare.unequal_stars(spark, out, other).orderBy("source_id", *chunks.KEY).toLocalIterator(), start=1):
        print(f"{r['kind']}: star {r['source_id']} of chunk {r['ix']}_{r['iy']}_{r['iz']}")
    print(f"{found} stars differ" if found else "no star differs")
    return int(found > 0)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("orrery").getOrCreate()
    if args.command == "build":
        stats = build_catalog(spark, args)
        if args.stats:
            for name, value in stats.first().asDict().items():
                print(f"{name}: {value}")
            print_manifest(spark, args.output_path.rstrip("/"))
        return 0
    if args.command == "ingest":
        for name, value in ingest(spark, args.gaia_path, args.output_path, args.exoplanet_path, _config(args)).items():
            print(f"{name}: {value}")
        return 0
    out = args.output_path.rstrip("/")
    if args.command == "diff":
        return run_diff(spark, out, args.other.rstrip("/"))
    faults = run_verify(spark, out)
    return run_content_check(spark, out) or faults if args.content else faults


if __name__ == "__main__":
    sys.exit(main())
