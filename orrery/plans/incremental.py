"""A catalog that grows by files: only the regions that new, changed or removed files touch are written anew.

Under the catalog's folder, beside the chunk table, chunk states and manifest of a full build:

| Path | Content |
|-|-|
| ``base`` | accepted stars with their place, file and cell, by region: what chunks are made from |
| ``ledger`` | by batch: each ingested file's state, and how many stars it has in which region |
| ``matches-N``, ``attached-N`` | after batch N: each host with its nearest star, each such star with its planets |
| ``state.json`` | the last batch that is complete, and the parameters; replaced by one rename, which commits a batch |
| ``pending.json`` | the batch that is being written, and the table of regions that it replaces |

What a batch touches: the regions of its stars; by the ledger, those of files that changed or went; and those of stars whose planets change because a host has a
nearer star now. Colour medians belong to a cell, and a cell to one region. A host's nearest star is the least of (separation, place in the files, or id)
over all stars, so the one of a batch is merged with the one before; only hosts that are new or whose star's file changed are
searched for in all stars.

A batch that fails is made again by the next one. If regions were being replaced, these may be damaged; the next batch reads every
file again that the ledger has in them, and keeps of it what lies in these regions. Nothing counts before ``state.json`` names it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.config import CatalogConfig
from orrery.operators import content, crossmatch, impute, quality
from orrery.operators.chunks import KEY
from orrery.plans import sinks
from orrery.plans.catalog import require_coordinates, with_coordinates
from orrery.schemas import RAW_STAR
from orrery.sources.csv_files import SourceError, collect_files, encoded_name, read_planet_csv, read_star_csv
from orrery.sources.storage import children, delete, file_states, read_text, write_text

PLACE = "struct<file:string,block:bigint,in_scan:bigint>"
BASE = f"{RAW_STAR}, x double, y double, z double, star_ord {PLACE}, ix int, iy int, iz int, region string"
LEDGER = "file string, length bigint, modified bigint, region string, n bigint, batch int"


def _document(spark: SparkSession, path: str) -> dict:
    return json.loads(read_text(spark, path) or "{}")


def _ledger(spark: SparkSession, out: str, committed: int) -> DataFrame:
    """``file, length, modified, region, n`` as of the last committed batch; a file has a row for each region, or one without."""
    if not children(spark, f"{out}/ledger"):
        return spark.createDataFrame([], LEDGER).drop("batch")
    rows = spark.read.schema(LEDGER).parquet(f"{out}/ledger").where(F.col("batch") <= committed)
    last = rows.groupBy("file").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["file", "batch"]).where("length is not null").drop("batch")  # without a length: removed


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """``file, length, modified, region, n`` of the ingested files."""
    return _ledger(spark, out, _document(spark, f"{out}/state.json").get("batch", 0))


def _base(spark: SparkSession, out: str) -> DataFrame:
    exists = bool(children(spark, f"{out}/base"))
    return spark.read.schema(BASE).parquet(f"{out}/base") if exists else spark.createDataFrame([], BASE)


def of_regions(rows: DataFrame, regions: DataFrame, on: list[str] | None = None) -> DataFrame:
    """The rows of ``regions (region, n, rx, ry, rz)``, found by the columns ``on``; where those are few, Spark prunes the folders by them."""
    on = on or ["region"]
    return rows.join(regions.where("n > 0").select(*on), on, "left_semi")


def _listed(spark: SparkSession, path: str) -> dict[str, tuple[str, int, int]]:
    """Path, length and time of change by name of the input's files, which the driver lists."""
    return {encoded_name(spark, p): state for p in collect_files(spark, path) for state in file_states(spark, p)}


def _kinds(listed: dict[str, tuple[str, int, int]], known: DataFrame) -> dict[str, str]:
    """Each file's name and whether it is added, changed, removed or the same; the driver has as many rows as files that it lists."""
    before = {r["file"]: (r["length"], r["modified"]) for r in known.select("file", "length", "modified").distinct().toLocalIterator()}
    now = {name: (length, modified) for name, (_, length, modified) in listed.items()}
    kind = lambda f: "removed" if f not in now else "added" if f not in before else "same" if now[f] == before[f] else "changed"
    return {f: kind(f) for f in sorted(now.keys() | before.keys())}


def _incoming(spark: SparkSession, work: str, out: str, batch: int, paths: list[str], config: CatalogConfig) -> DataFrame:
    """Accepted stars of the files, in the columns of the base; their rejects are logged by batch."""
    if not paths:
        return spark.createDataFrame([], BASE)
    quality.parse_stars(read_star_csv(spark, paths), config).write.mode("overwrite").parquet(f"{work}/parsed")
    parsed = spark.read.parquet(f"{work}/parsed")
    sinks.write_rejects(quality.rejects(parsed), f"{out}/rejects/batch={batch}")
    place = F.struct(F.element_at(F.split("file", "/"), -1).alias("file"), "block", "in_scan").alias("star_ord")
    stars = parsed.where("skip_reason is null").select("source_id", "ra", "dec_deg", "parallax", "parallax_error", "magnitude", "bp_rp", place)
    placed = sinks.with_regions(impute.with_cells(require_coordinates(with_coordinates(stars)), config), config)
    return placed.withColumn("region", sinks.region_name()).drop(*sinks.REGION)


def _merged_matches(spark: SparkSession, out: str, state: dict, hosts: DataFrame, kept: DataFrame, incoming: DataFrame, gone: DataFrame, config: CatalogConfig, ties: tuple[str, str]) -> DataFrame:
    """``host, ra, dec_deg, m``: each host's nearest of the stars ``kept`` and ``incoming``. ``gone`` are the files whose stars aren't as they were."""
    here = crossmatch.nearest(hosts, incoming, config, ties=ties)
    if not state.get("batch"):
        return hosts.select("host", "ra", "dec_deg").join(here, "host", "left")
    old = spark.read.parquet(f"{out}/matches-{state['batch']}")
    old = old.withColumn("file", F.col("m.ord.file")).join(gone.select("file", F.lit(True).alias("lost")), "file", "left").where("lost is null")
    known = hosts.join(old.select("host", "ra", "dec_deg", F.col("m").alias("before"), F.lit(True).alias("known")), ["host", "ra", "dec_deg"], "left")
    searched = known.where("known is null").select("host", "ra", "dec_deg")
    everywhere = None if searched.isEmpty() else crossmatch.nearest(searched, kept, config, ties=ties)
    best = known.select("host", "ra", "dec_deg", "before").join(here, "host", "left")
    if everywhere is None:
        return best.select("host", "ra", "dec_deg", F.least("before", "m").alias("m"))
    best = best.join(everywhere.withColumnRenamed("m", "elsewhere"), "host", "left")
    return best.select("host", "ra", "dec_deg", F.least("before", "m", "elsewhere").alias("m"))


def _changed_ids(spark: SparkSession, out: str, state: dict, attached: DataFrame) -> DataFrame:
    """Ids of stars whose planets aren't those of before."""
    if not state.get("batch"):
        return attached.select("source_id")
    old = spark.read.parquet(f"{out}/attached-{state['batch']}")
    both = attached.withColumnRenamed("planets", "new").join(old.withColumnRenamed("planets", "old"), "source_id", "full_outer")
    return both.where(~F.col("new").eqNullSafe(F.col("old"))).select("source_id")


def _drop_emptied(spark: SparkSession, out: str, touched: DataFrame, rows: DataFrame) -> None:
    """Deletes the folders of touched regions that have no star any more."""
    for r in touched.join(rows.select("region").distinct(), "region", "left_anti").select("region").toLocalIterator():
        at = "/".join(f"{c}={v}" for c, v in zip(sinks.REGION, r["region"].split("_"), strict=True))
        for folder in (f"{out}/base/region={r['region']}", f"{out}/states/region={r['region']}", f"{out}/chunks/{at}"):
            delete(spark, folder)


def ingest(spark: SparkSession, gaia_path: str, out: str, exoplanet_path: str | None = None, config: CatalogConfig = CatalogConfig(), by_id: bool = False) -> dict:
    """Brings the catalog in the folder ``out`` up to the files of ``gaia_path`` (a CSV file or a folder of them) and planets; says what was done.

    The result equals a build from all files. Of stars that are equally near to a host it takes the earliest in the files, or with ``by_id``, where
    the names of files say nothing about the order of stars, the one with the least id. A file counts as changed if its length or time of change has.
    Raises ``SourceError`` if the catalog was made with other parameters, if a folder holds one that wasn't made so, or if no star is left.
    """
    out = out.rstrip("/")
    state = _document(spark, f"{out}/state.json")
    ties = crossmatch.LEAST_ID if by_id else crossmatch.EARLIEST
    mark = config.fingerprint("planets" if exoplanet_path else "no planets", *(["ties by id"] if by_id else []))
    if state and state["parameters"] != mark:
        raise SourceError(f"{out} was made with other parameters")
    if not state and children(spark, f"{out}/chunks") and not children(spark, f"{out}/base"):
        raise SourceError(f"{out} holds a catalog that wasn't ingested")
    committed, batch = state.get("batch", 0), state.get("batch", 0) + 1
    work = f"{out}/work/batch-{batch}"

    listed, known = _listed(spark, gaia_path), _ledger(spark, out, committed)
    kinds = _kinds(listed, known)
    done = {k: list(kinds.values()).count(k) for k in ("added", "changed", "removed")} | {"batch": batch, "repaired_regions": 0}
    of_kind = lambda *wanted: [f for f, k in kinds.items() if k in wanted]
    names = lambda files: spark.createDataFrame([(f,) for f in files], "file string")
    pending, damaged, again = _document(spark, f"{out}/pending.json"), None, []
    if pending.get("batch", 0) > committed:
        damaged = spark.read.parquet(pending["regions"]).select("region")
        hit = known.join(damaged, "region", "left_semi").select("file").distinct()
        again = [r["file"] for r in hit.toLocalIterator() if kinds[r["file"]] == "same"]
        done["repaired_regions"] = damaged.count()
    planets = read_planet_csv(spark, exoplanet_path).drop("discovery_method") if exoplanet_path else None
    planet_mark = str(file_states(spark, exoplanet_path)) if exoplanet_path else ""
    if not any(done[k] for k in ("added", "changed", "removed", "repaired_regions")) and state and state["planets"] == planet_mark:
        return done | {"batch": committed, "regions": 0}

    # Stars: what comes in, and what stays of the base.
    fresh, gone = of_kind("added", "changed"), names(of_kind("changed", "removed"))
    incoming = _incoming(spark, work, out, batch, [listed[f][0] for f in sorted(fresh + again)], config)
    kept = _base(spark, out)
    if damaged is not None:  # of files that are as before, only what is lost
        lost = incoming.join(names(again).select(F.col("file").alias("of")), F.col("star_ord.file") == F.col("of"), "left")
        lost = lost.join(damaged.withColumn("hurt", F.lit(True)), "region", "left")
        incoming = lost.where("of is null or hurt").drop("of", "hurt")
        kept = kept.join(damaged, "region", "left_anti")
    incoming.write.mode("overwrite").parquet(f"{work}/incoming")
    incoming = spark.read.schema(BASE).parquet(f"{work}/incoming")
    kept = kept.join(gone.select(F.col("file").alias("of")), F.col("star_ord.file") == F.col("of"), "left_anti")
    if incoming.isEmpty() and kept.isEmpty():
        raise SourceError("no star passes the quality gates")

    # Planets: matches of before and of the batch, and whose planets change by it.
    regions = incoming.select("region").union(known.join(gone, "file", "left_semi").where("region is not null").select("region"))
    if damaged is not None:
        regions = regions.union(damaged)
    attached = None
    if planets is not None:
        hosts = crossmatch.group_hosts(planets)
        everything = kept.unionByName(incoming)
        _merged_matches(spark, out, state, hosts, everything, incoming, gone, config, ties).write.mode("overwrite").parquet(f"{out}/matches-{batch}")
        matches = spark.read.parquet(f"{out}/matches-{batch}").where("m is not null").select("host", F.col("m.source_id").alias("source_id"))
        crossmatch.planet_lists(planets, matches).write.mode("overwrite").parquet(f"{out}/attached-{batch}")
        attached = spark.read.parquet(f"{out}/attached-{batch}")
        changed = _changed_ids(spark, out, state, attached)
        regions = regions.union(kept.join(changed, "source_id", "left_semi").select("region"))
    axes = [F.split("region", "_")[i].cast("int").alias(c) for i, c in enumerate(sinks.REGION)]
    to_replace = f"{work}/regions-{uuid.uuid4().hex}"  # a failed batch has left one that is still read
    regions.groupBy("region").agg(F.count("*").alias("n")).select("*", *axes).write.parquet(to_replace)
    touched = spark.read.parquet(to_replace)

    # The touched regions anew, aside; then in their places.
    of_regions(kept, touched).unionByName(incoming).write.mode("overwrite").parquet(f"{work}/stars")
    rows = spark.read.schema(BASE).parquet(f"{work}/stars")
    if attached is None:
        catalog = impute.without_planets(rows, config)
    else:
        enriched = crossmatch.attach_lists(rows, attached, crossmatch.fits(attached, config.broadcast_hosts))
        catalog = impute.infer(enriched, config, impute.bin_medians(rows, config, by_selection=True))
    write_text(spark, f"{out}/pending.json", [json.dumps({"batch": batch, "regions": to_replace})])
    _replace(rows, f"{out}/base")
    sinks.write_chunks(catalog, f"{out}/chunks", config, only_its_regions=True)
    _drop_emptied(spark, out, touched, rows)
    states = sinks.write_states(of_regions(spark.read.parquet(f"{out}/chunks"), touched, sinks.REGION), out, config, only_its_regions=True)
    sinks.write_manifest(states.drop("region", *content.DIGEST), f"{out}/manifest.json", config)

    # The ledger's rows of the batch, and the commit.
    footprint = incoming.groupBy(F.col("star_ord.file").alias("file"), "region").agg(F.count("*").alias("n"))
    states = spark.createDataFrame([(f, *listed[f][1:]) for f in fresh], "file string, length bigint, modified bigint")
    absent = ["bigint", "bigint", "string", "bigint"]
    removed = names(of_kind("removed")).select("file", *[F.lit(None).cast(t).alias(c) for c, t in zip(("length", "modified", "region", "n"), absent, strict=True)])
    states.join(footprint, "file", "left").unionByName(removed).write.mode("overwrite").parquet(f"{out}/ledger/batch={batch}")
    write_text(spark, f"{out}/state.json", [json.dumps({"batch": batch, "parameters": mark, "planets": planet_mark})])
    n_regions = touched.count()
    for name in (*(f"{t}-{committed}" for t in ("matches", "attached")), "pending.json", "work"):
        delete(spark, f"{out}/{name}")
    return done | {"regions": n_regions}


def _replace(rows: DataFrame, path: str) -> None:
    """Writes the regions that ``rows`` have; the others' files stay."""
    rows.hint("rebalance", "region").sortWithinPartitions("region", *KEY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("region").parquet(path)
