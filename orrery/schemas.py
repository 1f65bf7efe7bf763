"""Schemas of the catalog's tables, as DDL."""

from __future__ import annotations

OBSERVED, INFERRED, SYNTHETIC = "Observed", "Inferred", "Synthetic"

RAW_STAR = (
    "source_id bigint, ra double, dec_deg double, parallax double, parallax_error double, magnitude float, bp_rp float"
)
RAW_PLANET = (
    "row_ord bigint, planet_name string, hostname string, ra double, dec_deg double, semi_major_au float, period_days float, "
    "radius_earth float, eq_temp_kelvin float, discovery_method string"
)
MANIFEST_VERSION = 1
