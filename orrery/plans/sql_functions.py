"""The catalog in SQL alone: functions of positions, and table functions over the views of a catalog.

All are temporary functions that are defined in SQL, so Spark inlines them and plans the query as a whole.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from orrery.functions.astro import ARCSEC_PER_RADIAN, PARSEC_FROM_MAS
from orrery.plans.catalog import Catalog

_SCALARS = {
    "distance_pc(parallax DOUBLE)": ("DOUBLE", f"try_divide({PARSEC_FROM_MAS}D, parallax)"),
    "angle_between(a_ra DOUBLE, a_dec DOUBLE, b_ra DOUBLE, b_dec DOUBLE)": (
        "DOUBLE",
        f"2 * asin(sqrt(least(1D, pow(sin((radians(b_dec) - radians(a_dec)) / 2), 2) + cos(radians(a_dec)) * cos(radians(b_dec)) * pow(sin((radians(b_ra) - radians(a_ra)) / 2), 2)))) * {ARCSEC_PER_RADIAN!r}D",
    ),
    "cell_of(coordinate DOUBLE, size DOUBLE)": ("INT", "CAST(floor(coordinate / size) AS INT)"),
    "host_name(name STRING)": ("STRING", "regexp_replace(regexp_replace(lower(regexp_replace(name, '(?U)^\\\\s+|\\\\s+$', '')), '(?U)\\\\s+', ' '), '^(gliese|gl) ', 'gj ')"),
}


def _tables(prefix: str) -> dict[str, tuple[str, str]]:
    meets = " AND ".join(f"min_{a} <= c{a} + radius AND max_{a} >= c{a} - radius" for a in "xyz")
    away = "sqrt(pow(x - cx, 2) + pow(y - cy, 2) + pow(z - cz, 2))"
    within = " AND ".join(f"{a} BETWEEN c{a} - radius AND c{a} + radius" for a in "xyz")
    sphere, chunk = "cx DOUBLE, cy DOUBLE, cz DOUBLE, radius DOUBLE", "ix INT, iy INT, iz INT, star_count BIGINT"
    return {
        f"chunks_in_radius({sphere})": (chunk, f"SELECT ix, iy, iz, star_count FROM {prefix}_chunks WHERE radius >= 0 AND {meets}"),
        "chunk_by_id(cx INT, cy INT, cz INT)": (chunk, f"SELECT ix, iy, iz, star_count FROM {prefix}_chunks WHERE ix = cx AND iy = cy AND iz = cz"),
        f"stars_in_radius({sphere})": ("source_id BIGINT, distance DOUBLE", f"SELECT source_id, {away} FROM {prefix}_stars WHERE {within} AND {away} <= radius"),
        "cone_search(ra DOUBLE, dec DOUBLE, radius DOUBLE)": (
            "source_id BIGINT, angle_arcsec DOUBLE",
            f"SELECT source_id, a FROM (SELECT source_id, angle_between(ra, dec, degrees(atan2(y, x)), degrees(asin(greatest(-1D, least(1D, z / sqrt(x * x + y * y + z * z)))))) AS a FROM {prefix}_stars) WHERE a < radius",
        ),
    }


def register(catalog: Catalog, spark: SparkSession, prefix: str = "catalog") -> None:
    """Registers the catalog's views under ``prefix`` and the functions, for this session.

    ``distance_pc``, ``angle_between`` (arc seconds), ``cell_of`` and ``host_name`` are of values; ``chunks_in_radius``, ``chunk_by_id``,
    ``stars_in_radius`` (parsecs) and ``cone_search`` (degrees, and a radius in arc seconds, which is excluded) are tables.
    """
    catalog.register_views(prefix)
    for signature, (kind, body) in _SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    for signature, (columns, body) in _tables(prefix).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS TABLE ({columns}) RETURN {body}")
