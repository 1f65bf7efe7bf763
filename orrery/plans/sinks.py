"""Outputs of a run: chunk table, manifest, logs, statistics."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.config import CatalogConfig
from orrery.operators import content
from orrery.operators.chunks import KEY, manifest_totals
from orrery.schemas import MANIFEST_VERSION
from orrery.sources.csv_files import SourceError
from orrery.sources.storage import read_text, write_text

REGION = ["rx", "ry", "rz"]
STATES = (
    "ix int, iy int, iz int, star_count bigint, planet_star_count bigint, observed_count bigint, inferred_count bigint, synthetic_count bigint, "
    "min_x double, min_y double, min_z double, max_x double, max_y double, max_z double, d1 bigint, d2 bigint, file_name string, region string"
)
_COUNTS = ["star_count", "planet_star_count", "observed_count", "inferred_count", "synthetic_count"]


def with_regions(rows: DataFrame, config: CatalogConfig) -> DataFrame:
    """Adds the cube of chunks that shares an output folder; one folder a chunk would be millions of them."""
    return rows.withColumns({r: F.floor(F.col(i) / config.chunks_per_partition_axis).cast("int") for r, i in zip(REGION, KEY, strict=True)})


_LAYOUT = "_layout.json"  # Spark's readers pass by names that begin so


def write_chunks(catalog: DataFrame, path: str, config: CatalogConfig, only_its_regions: bool = False) -> None:
    """Parquet by region, every chunk's stars together and ordered, so that a chunk reads a few row groups.

    Large regions are split over tasks by Spark's rebalancing rather than meeting in one. The layout is stored beside.
    With ``only_its_regions`` the files of regions that ``catalog`` has no star of stay.
    """
    rows = with_regions(catalog, config).hint("rebalance", *REGION).sortWithinPartitions(*REGION, *KEY, "source_id")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only_its_regions else "static").partitionBy(*REGION).parquet(path)
    write_text(catalog.sparkSession, f"{path}/{_LAYOUT}", [json.dumps({"chunk_size_parsecs": config.chunk_size, "chunks_per_partition_axis": config.chunks_per_partition_axis})])


def layout(spark: SparkSession, path: str) -> dict:
    """How a chunk table was laid out: size of a chunk, chunks along a region."""
    text = read_text(spark, f"{path}/{_LAYOUT}")
    if text is None:
        raise SourceError(f"{path} has no {_LAYOUT}")
    return json.loads(text)


def read_chunks(spark: SparkSession, path: str, chunk: tuple[int, int, int] | None = None) -> DataFrame:
    """The catalog, or one chunk of it: folder pruning by region as it was written, row-group pruning by chunk."""
    rows = spark.read.parquet(path)
    if chunk is not None:
        axis = layout(spark, path)["chunks_per_partition_axis"]
        for r, i, at in zip(REGION, KEY, chunk, strict=True):
            rows = rows.where((F.col(r) == at // axis) & (F.col(i) == at))
    return rows.drop(*REGION)


def manifest_json(manifest: DataFrame, totals: dict, config: CatalogConfig) -> Iterator[str]:
    """The manifest document in parts; chunks come in order, one at a time."""
    head = {"version": MANIFEST_VERSION, "chunk_size_parsecs": config.chunk_size, "chunks_per_partition_axis": config.chunks_per_partition_axis, "total_stars": totals["total_stars"], "total_planets": totals["total_planets"]}
    yield "{\n" + "".join(f"  {json.dumps(k)}: {json.dumps(v)},\n" for k, v in head.items()) + '  "chunks": ['
    separator = "\n"
    for r in manifest.orderBy(*KEY).toLocalIterator():
        chunk = {"id": [r[k] for k in KEY]} | {c: r[c] for c in _COUNTS} | {f"aabb_{m}": [r[f"{m}_{c}"] for c in "xyz"] for m in ("min", "max")} | {"file_name": r["file_name"]}
        yield separator + "    " + json.dumps(chunk)
        separator = ",\n"
    yield "\n  ]\n}\n"


def write_manifest(manifest: DataFrame, path: str, config: CatalogConfig) -> None:
    """The manifest as a Parquet table beside the document, and the document from it, so that it is computed once."""
    spark, table = manifest.sparkSession, path.removesuffix(".json") + ".parquet"
    manifest.write.mode("overwrite").parquet(table)
    write_manifest_document(spark.read.parquet(table), path, config)


def write_manifest_document(manifest: DataFrame, path: str, config: CatalogConfig) -> None:
    """The document of a manifest that is stored already."""
    write_text(manifest.sparkSession, path, manifest_json(manifest, manifest_totals(manifest).first().asDict(), config))


def _document(spark: SparkSession, path: str) -> DataFrame:
    chunk = ", ".join(["id:array<int>", *[f"{c}:bigint" for c in _COUNTS], "aabb_min:array<double>", "aabb_max:array<double>", "file_name:string"])
    return spark.read.json(path, multiLine=True, schema=f"version bigint, chunk_size_parsecs double, chunks_per_partition_axis bigint, total_stars bigint, total_planets bigint, chunks array<struct<{chunk}>>")


def read_manifest_head(spark: SparkSession, path: str) -> dict:
    """What a manifest document says of the whole: version, chunk size, chunks along a region, totals."""
    rows = _document(spark, path).drop("chunks").collect()  # one row
    if len(rows) != 1 or rows[0]["version"] is None:
        raise SourceError(f"{path} is no manifest")
    return rows[0].asDict()


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row a chunk of a manifest document, in the columns of ``chunk_metadata``."""
    rows = _document(spark, path).select(F.explode("chunks").alias("c"))
    ids = [F.col("c.id")[i].alias(k) for i, k in enumerate(KEY)]
    boxes = [F.col(f"c.aabb_{m}")[i].alias(f"{m}_{c}") for m in ("min", "max") for i, c in enumerate("xyz")]
    return rows.select(*ids, *[f"c.{c}" for c in _COUNTS], *boxes, "c.file_name")


def region_name() -> Column:
    return F.concat_ws("_", *REGION)


def write_states(chunks: DataFrame, path: str, config: CatalogConfig, only_its_regions: bool = False) -> DataFrame:
    """The states of the chunks of a stored chunk table, by region, and from them all the content tree's nodes; gives the states."""
    spark = chunks.sparkSession
    states = with_regions(content.chunk_states(chunks), config).withColumn("region", region_name()).drop(*REGION)
    writer = states.hint("rebalance", "region").sortWithinPartitions("region", *KEY).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic" if only_its_regions else "static").partitionBy("region").parquet(f"{path}/states")
    states = read_states(spark, path)
    content.nodes(states, config.chunks_per_partition_axis).write.mode("overwrite").partitionBy("level").parquet(f"{path}/nodes")
    return states


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATES).parquet(f"{path}/states")


def write_catalog(catalog: DataFrame, path: str, config: CatalogConfig) -> None:
    """Chunk table, chunk states with their tree, manifest table and manifest document under one folder."""
    write_chunks(catalog, f"{path}/chunks", config)
    states = write_states(catalog.sparkSession.read.parquet(f"{path}/chunks"), path, config)
    write_manifest(states.drop("region", *content.DIGEST), f"{path}/manifest.json", config)


def open_chunk(spark: SparkSession, path: str, file_name: str) -> DataFrame:
    """The stars of the chunk that a manifest calls ``file_name``, of the catalog in the folder ``path``.

    Chunks share files (see ``with_regions``), so a name stands for its rows. Unknown names raise ``SourceError``.
    """
    found = spark.read.parquet(f"{path}/manifest.parquet").where(F.col("file_name") == file_name).limit(1).collect()
    if not found:
        raise SourceError(f"the manifest of {path} has no chunk {file_name}")
    return read_chunks(spark, f"{path}/chunks", tuple(found[0][k] for k in KEY))


def write_rejects(rejects: DataFrame, path: str) -> None:
    """One line of text a skipped row."""
    line = F.format_string("SKIP line=%d field=%s reason=%s", "line", "field", "reason")
    rejects.select(line.alias("value")).write.mode("overwrite").text(path)


def write_unmatched(hosts: DataFrame, path: str) -> None:
    """Host names under two header lines, in order."""

    def lines() -> Iterator[str]:
        yield "# Planet hosts without a matching star\n# one normalised name a line\n"
        for r in hosts.orderBy("host").toLocalIterator():
            yield r["host"] + "\n"

    write_text(hosts.sparkSession, path, lines())
