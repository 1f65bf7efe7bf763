"""CSV sources of stars and planets.

Headers are bound by name and file: files with the same header line are one scan, whatever their number.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.parsing import parse_real, trimmed

#: The columns of the two formats, and what they are called here.
STAR_FIELDS = {
    "source_id": "source_id", "ra": "ra", "dec": "dec_deg", "parallax": "parallax", "parallax_error": "parallax_error", "phot_g_mean_mag": "magnitude", "bp_rp": "bp_rp",
}
PLANET_FIELDS = {
    "pl_name": "planet_name", "hostname": "hostname", "ra": "ra", "dec": "dec_deg", "pl_orbsmax": "semi_major_au", "pl_orbper": "period_days", "pl_rade": "radius_earth", "pl_eqt": "eq_temp_kelvin", "discoverymethod": "discovery_method",
}


_HEADERS_AT_ONCE = 32  # files that the driver opens together


class SourceError(ValueError):
    """An input that can't be read at all."""


@dataclass(frozen=True)
class _File:
    path: str
    header: str
    ordinal: int


def collect_files(spark: SparkSession, path: str) -> list[str]:
    """A file as it is, or the ``*.csv`` files of a folder (not deeper), sorted by path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        raise SourceError(f"{path} does not exist")
    if fs.getFileStatus(hadoop).isFile():
        return [path]
    found = sorted(str(s.getPath().toString()) for s in fs.listStatus(hadoop) if s.isFile() and s.getPath().getName().endswith(".csv"))
    if not found:
        raise SourceError(f"{path} has no CSV files")
    return found


def _header(spark: SparkSession, path: str, comment: str | None) -> str:
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(hadoop)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        while line is not None and (not line.strip() or comment and line.startswith(comment)):
            line = reader.readLine()
        return line or ""
    finally:
        stream.close()


def _names(header: str) -> list[str]:
    import csv

    return [n.strip().lstrip("﻿") for n in next(csv.reader([header]), [])]


def _scan(spark: SparkSession, files: list[_File], fields: dict[str, str], fold_case: bool, multi_line: bool, **options) -> DataFrame:
    names = _names(files[0].header)
    known = [n.lower() if fold_case else n for n in names]
    missing = [f for f in fields if f not in known]
    if missing:
        raise SourceError(f"{files[0].path} lacks the columns {', '.join(missing)}")
    schema = ", ".join([f"c{i} string" for i in range(len(names))] + ["bad string"])
    rows = spark.read.option("columnPruning", False).csv([f.path for f in files], schema=schema, header=True, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord="bad", quote='"', escape='"', multiLine=multi_line, **options)
    names_ = [(encoded_name(spark, f.path), f.ordinal) for f in files]
    ordinals = F.broadcast(spark.createDataFrame(names_, "file_key string, file_ord int"))  # the files that the driver has listed
    picked = [F.col(f"c{known.index(f)}").alias(name) for f, name in fields.items()]  # the first of that name
    placed = rows.select(
        *picked,
        F.col("bad").isNotNull().alias("malformed"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_key"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("in_scan"),
    )
    return placed.join(ordinals, "file_key", "left").drop("file_key")


def encoded_name(spark: SparkSession, path: str) -> str:
    """A file's name without its folder, as Spark's file metadata has it."""
    return str(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getRawPath()).rsplit("/", 1)[-1]


def _read(spark: SparkSession, path: str | list[str], fields: dict[str, str], fold_case: bool, skip: str | None, multi_line: bool, **options) -> DataFrame:
    paths = collect_files(spark, path) if isinstance(path, str) else path
    with ThreadPoolExecutor(_HEADERS_AT_ONCE) as pool:
        headers = pool.map(lambda p: _header(spark, p, skip), paths)
        files = [_File(p, h, i) for i, (p, h) in enumerate(zip(paths, headers, strict=True))]
    out = None
    for header in dict.fromkeys(f.header for f in files):
        part = _scan(spark, [f for f in files if f.header == header], fields, fold_case, multi_line, **options)
        out = part if out is None else out.unionByName(part)
    return out


def read_star_csv(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Star rows of a file, a folder or a list of files as text with ``malformed`` and their place; column names are case-sensitive.

    ``multi_line`` admits line ends inside quotes, at the price of unsplittable files.
    """
    return _read(spark, path, STAR_FIELDS, False, None, multi_line)


def planet_rows(spark: SparkSession, path: str) -> DataFrame:
    """All planet rows, typed, with ``usable``: well-formed, with names, a position, a distance and a period.

    Lines that begin with # are comments, column names are matched in any case; ``row_ord`` is the rows' order.
    """
    rows = _read(spark, path, PLANET_FIELDS, True, "#", False, comment="#", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    real = lambda c, kind="float": parse_real(F.col(c), kind).alias(c)
    parsed = rows.select(
        F.struct("file_ord", "block", "in_scan").alias("row_ord"),
        trimmed(F.col("planet_name")).alias("planet_name"),
        trimmed(F.col("hostname")).alias("hostname"),
        real("ra", "double"),
        real("dec_deg", "double"),
        real("semi_major_au"),
        real("period_days"),
        real("radius_earth"),
        real("eq_temp_kelvin"),
        trimmed(F.col("discovery_method")).alias("discovery_method"),
        "malformed",
    )
    named = F.coalesce((F.length("planet_name") > 0) & (F.length("hostname") > 0), F.lit(False))
    complete = F.lit(True)
    for c in ("ra", "dec_deg", "semi_major_au", "period_days"):
        complete = complete & F.col(c).isNotNull()
    return parsed.withColumn("usable", ~F.col("malformed") & named & complete).drop("malformed")


def planet_counts(rows: DataFrame) -> DataFrame:
    """One row: ``planets_parsed`` and ``planets_skipped``."""
    return rows.agg(F.count_if("usable").alias("planets_parsed"), F.count_if(~F.col("usable")).alias("planets_skipped"))


def read_planet_csv(spark: SparkSession, path: str, dedupe: bool = False) -> DataFrame:
    """The usable planets. Raises ``SourceError`` if there are none. ``dedupe`` keeps the first row of a planet name."""
    kept = planet_rows(spark, path).where("usable").drop("usable")
    if kept.isEmpty():
        raise SourceError(f"{path} has no usable planets")
    if dedupe:
        row = F.struct("row_ord", *[c for c in kept.columns if c != "row_ord"])
        kept = kept.groupBy(F.col("planet_name").alias("__name")).agg(F.min_by(row, "row_ord").alias("r")).select("r.*")
    return kept
