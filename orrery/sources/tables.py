"""Catalog-shaped views over general Parquet tables; the SQL is the same in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STAR_COLUMNS = """
CAST(o_orderkey AS BIGINT) AS source_id,
((o_orderkey * 7919) % 360000) / 1000.0e0 AS ra,
((o_orderkey * 104729) % 180000) / 1000.0e0 - 90e0 AS dec_deg,
(o_orderkey % 997 - 20) / 10.0e0 AS parallax,
(1 + o_custkey % 50) / 10.0e0 AS parallax_error,
3.0e0 + (o_orderkey % 170) / 10.0e0 AS magnitude,
CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE (o_custkey % 350) / 100.0e0 END AS bp_rp
"""
PLANET_COLUMNS = """
p_partkey AS row_ord,
CONCAT('P-', CAST(p_partkey AS VARCHAR(20))) AS planet_name,
CONCAT(CASE p_partkey % 3 WHEN 0 THEN 'Gliese ' WHEN 1 THEN 'GL  ' ELSE ' gj ' END, CAST(p_partkey % 500 AS VARCHAR(20))) AS hostname,
((3 * (p_partkey % 500) * 7919) % 360000) / 1000.0e0 AS ra,
((3 * (p_partkey % 500) * 104729) % 180000) / 1000.0e0 - 90e0 + 0.0001e0 * ((p_partkey % 500) % 9) AS dec_deg,
(p_partkey % 400) / 100.0e0 AS semi_major_au,
((p_partkey * 37) % 2000) * 1.0e0 AS period_days,
CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size / 5.0e0 END AS radius_earth,
CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 200.0e0 + p_partkey % 1500 END AS eq_temp_kelvin
"""


def _select(df: DataFrame, columns: str) -> DataFrame:
    return df.sparkSession.sql(f"SELECT {columns} FROM {{t}}", t=df)


def stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark.read.parquet(f"{sf_dir}/orders.parquet"), STAR_COLUMNS)


def planets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark.read.parquet(f"{sf_dir}/part.parquet"), PLANET_COLUMNS)
