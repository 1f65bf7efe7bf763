"""Quality gates for stars: every input row is kept, or rejected with the first check that it fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.config import CatalogConfig
from orrery.functions.astro import MAX_DISTANCE_PC, distance_pc
from orrery.functions.parsing import parse_id, parse_real
from orrery.sources.csv_files import SourceError

#: The order of the checks and their reasons.
REQUIRED = ("source_id", "ra", "dec_deg", "parallax", "parallax_error", "magnitude")
PARSE_FAILURE = "parse failure"
NON_POSITIVE = "non-positive"
LOW_SNR = "below SNR threshold"
TOO_FAR = "distance exceeds 100 kpc"


def gate(snr_min: float) -> Column:
    """``field, reason`` of the first numeric check that fails, else null. NaN fails none, as no comparison with it holds."""
    plx, err = F.col("parallax").cast("double"), F.col("parallax_error").cast("double")
    below = lambda x, y: ~F.isnan(x) & (x < y)
    distance = distance_pc(plx)
    snr = F.try_divide(plx, err)
    no = lambda field, reason: F.struct(F.lit(field).alias("field"), F.lit(reason).alias("reason"))
    return (
        F.when(~F.isnan(plx) & (plx <= 0), no("parallax", NON_POSITIVE))
        .when(~F.isnan(err) & (err <= 0) | below(snr, F.lit(float(snr_min))), no("parallax", LOW_SNR))
        .when(~F.isnan(distance) & (distance > MAX_DISTANCE_PC), no("parallax", TOO_FAR))
    )


def filter_stars(stars: DataFrame, config: CatalogConfig = CatalogConfig()) -> DataFrame:
    """Typed stars that pass all gates; narrow, so it fuses with its neighbours."""
    return stars.where(gate(config.parallax_snr).isNull())


def checked(stars: DataFrame, config: CatalogConfig = CatalogConfig()) -> DataFrame:
    """Typed stars with ``skip_field`` and ``skip_reason``, null for those that pass."""
    missing = None
    for c in REQUIRED:
        hit = F.struct(F.lit(c).alias("field"), F.lit(PARSE_FAILURE).alias("reason"))
        missing = F.when(F.col(c).isNull(), hit) if missing is None else missing.when(F.col(c).isNull(), hit)
    skip = F.coalesce(missing, gate(config.parallax_snr))
    return stars.withColumn("__skip", skip).select("*", F.col("__skip.field").alias("skip_field"), F.col("__skip.reason").alias("skip_reason")).drop("__skip")


def parse_stars(text_rows: DataFrame, config: CatalogConfig = CatalogConfig()) -> DataFrame:
    """Rows of ``read_star_csv`` as typed stars with ``skip_field`` and ``skip_reason``."""
    typed = text_rows.select(
        parse_id(F.col("source_id")).alias("source_id"),
        *[parse_real(F.col(c)).alias(c) for c in ("ra", "dec_deg", "parallax", "parallax_error")],
        *[parse_real(F.col(c), "float").alias(c) for c in ("magnitude", "bp_rp")],
        "malformed",
        "file",
        "file_ord",
        "block",
        "in_scan",
    )
    return judged(typed, config)


def judged(typed: DataFrame, config: CatalogConfig = CatalogConfig()) -> DataFrame:
    """Typed star rows with ``malformed`` and their place, as typed stars with ``skip_field`` and ``skip_reason``."""
    out = checked(typed, config)
    bad = F.col("malformed")
    return out.withColumns({"skip_field": F.when(bad, "row").otherwise(F.col("skip_field")), "skip_reason": F.when(bad, "malformed row").otherwise(F.col("skip_reason"))})


def parse_metrics() -> list[Column]:
    """Counts over the rows of ``parse_stars``."""
    kept = F.col("skip_reason").isNull()
    return [
        F.count("*").alias("total_rows"),
        F.count("skip_reason").alias("skipped_rows"),
        F.count_if(kept).alias("stars"),
        F.count_if(kept & F.col("bp_rp").isNotNull()).alias("stars_with_color"),
    ]


def rejects(parsed: DataFrame) -> DataFrame:
    """``file, line, field, reason`` of skipped rows; lines count from 2.

    Rows of a split are numbered consecutively, so a line number is the rows of the file's earlier splits plus the place in
    its own: only one row a split is put in order, not the file.
    """
    splits = parsed.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("in_scan").alias("first"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    skipped = parsed.where("skip_reason is not null").select("file", "block", "in_scan", "skip_field", "skip_reason")
    line = F.col("before") + F.col("in_scan") - F.col("first") + 2
    return skipped.join(splits, ["file", "block"]).select("file", line.cast("bigint").alias("line"), F.col("skip_field").alias("field"), F.col("skip_reason").alias("reason"))


def kept_stars(parsed: DataFrame) -> DataFrame:
    """The stars that pass, with ``star_ord``, their order over all files. Raises ``SourceError`` if there are none."""
    kept = parsed.where("skip_reason is null").select(
        "source_id", "ra", "dec_deg", "parallax", "parallax_error", "magnitude", "bp_rp", F.struct("file_ord", "block", "in_scan").alias("star_ord")
    )
    if kept.isEmpty():
        raise SourceError("no star passes the quality gates")
    return kept
