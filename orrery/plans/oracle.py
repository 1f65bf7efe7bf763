"""DuckDB SQL for the queries of :mod:`orrery.plans.queries`."""

from __future__ import annotations

from orrery.sources.tables import PLANET_COLUMNS, STAR_COLUMNS

_TEFF = "9245.0 - 2700.0 * {c} + 508.0 * {c} * {c}"


def _teff(color: str) -> str:
    return f"({_TEFF.format(c=f'greatest(0.5, least(3.0, {color}))')})"


def _eq_temp(color: str) -> str:
    return f"CASE WHEN semi_major_au > 0 AND {_teff(color)} * sqrt(0.00465 / (2 * semi_major_au)) * pow(0.7, 0.25) > 0 THEN {_teff(color)} * sqrt(0.00465 / (2 * semi_major_au)) * pow(0.7, 0.25) END"


def _sep(ra: str, dec: str) -> str:
    return f"2 * asin(sqrt(least(1.0, pow(sin((radians({dec}) - radians(dec_deg)) / 2), 2) + cos(radians(dec_deg)) * cos(radians({dec})) * pow(sin((radians({ra}) - radians(ra)) / 2), 2)))) * 3600 * 180 / pi()"


_RADIUS = "coalesce(radius_earth, CASE WHEN period_days < 10 THEN 1.5 WHEN period_days < 100 THEN 2.5 WHEN period_days < 1000 THEN 5.0 ELSE 10.0 END)"
_HOST = r"regexp_replace(trim(regexp_replace(lower(hostname), '\s+', ' ', 'g')), '^(gliese|gl) ', 'gj ')"
_COLOR_CTES = """
medians AS (SELECT ix, iy, iz, mag_bin, count(*) AS n, median(bp_rp) AS v FROM celled WHERE bp_rp IS NOT NULL GROUP BY ALL),
colored AS (
  SELECT c.*, coalesce(c.bp_rp, m0.v, m1.v, m2.v) AS filled FROM celled c
  LEFT JOIN medians m0 ON (c.ix, c.iy, c.iz, c.mag_bin) = (m0.ix, m0.iy, m0.iz, m0.mag_bin)
  LEFT JOIN medians m1 ON (c.ix, c.iy, c.iz, c.mag_bin + 1) = (m1.ix, m1.iy, m1.iz, m1.mag_bin)
  LEFT JOIN medians m2 ON (c.ix, c.iy, c.iz, c.mag_bin - 1) = (m2.ix, m2.iy, m2.iz, m2.mag_bin)
)"""
_CTES = {
    "raw_stars": f"raw_stars AS (SELECT {STAR_COLUMNS} FROM orders)",
    "raw_planets": f"raw_planets AS (SELECT *, {_HOST} AS host FROM (SELECT {PLANET_COLUMNS} FROM part))",
    "kept": "kept AS (SELECT * FROM raw_stars WHERE parallax > 0 AND parallax_error > 0 AND parallax / parallax_error >= 5 AND 1000 / parallax <= 100000)",
    "placed": "placed AS (SELECT *, 1000 / parallax * cos(radians(dec_deg)) * cos(radians(ra)) AS x, 1000 / parallax * cos(radians(dec_deg)) * sin(radians(ra)) AS y, 1000 / parallax * sin(radians(dec_deg)) AS z FROM kept)",
    "celled": "celled AS (SELECT *, CAST(floor(x / 50) AS INTEGER) AS ix, CAST(floor(y / 50) AS INTEGER) AS iy, CAST(floor(z / 50) AS INTEGER) AS iz, CAST(floor(magnitude / 0.5) AS BIGINT) AS mag_bin FROM placed)",
    "hosts": "hosts AS (SELECT host, count(*) AS n_planets, arg_min(ra, row_ord) AS h_ra, arg_min(dec_deg, row_ord) AS h_dec FROM raw_planets GROUP BY host)",
    "near": f"near AS (SELECT host, source_id, sep FROM (SELECT host, source_id, {_sep('h_ra', 'h_dec')} AS sep FROM hosts, kept WHERE abs(h_dec - dec_deg) < 0.001) WHERE sep < 2 QUALIFY row_number() OVER (PARTITION BY host ORDER BY sep, source_id) = 1)",
    "named": "named AS (SELECT host, min(source_id) AS source_id FROM hosts JOIN kept ON source_id % 10 = 0 AND host = 'gj ' || source_id GROUP BY host)",
    "two_pass": "two_pass AS (SELECT host, source_id, 1 AS match_pass FROM named UNION ALL SELECT host, source_id, 2 FROM near WHERE host NOT IN (SELECT host FROM named))",
    "colored": _COLOR_CTES.strip(),
    "attached": "attached AS (SELECT near.source_id, p.* FROM raw_planets p JOIN near USING (host))",
    "catalog": "catalog AS (SELECT c.*, c.source_id IN (SELECT source_id FROM near) AS has_planets, CASE WHEN filled IS NULL THEN 'Inferred' ELSE 'Observed' END AS quality FROM colored c)",
    "chunks": "chunks AS (SELECT ix, iy, iz, count(*) AS star_count, count(*) FILTER (has_planets) AS planet_star_count, count(*) FILTER (quality = 'Observed') AS observed_count, count(*) FILTER (quality = 'Inferred') AS inferred_count, CAST(0 AS BIGINT) AS synthetic_count, min(x) AS min_x, min(y) AS min_y, min(z) AS min_z, max(x) AS max_x, max(y) AS max_y, max(z) AS max_z FROM catalog GROUP BY ALL)",
}
_STARS = ["raw_stars", "kept"]
_CELLED = [*_STARS, "placed", "celled"]
_MATCH = ["raw_stars", "kept", "raw_planets", "hosts", "near"]
_CATALOG = ["raw_stars", "kept", "placed", "celled", "raw_planets", "hosts", "near", "colored", "catalog"]
_CHUNKS = [*_CATALOG, "chunks"]
_CTES["damaged"] = "damaged AS (SELECT ix, iy, iz, star_count + CASE WHEN ix % 3 = 0 THEN 1 ELSE 0 END AS star_count, min_x, min_y, min_z, max_x - CASE WHEN iy % 4 = 0 THEN 0.5 ELSE 0 END AS max_x, max_y, max_z FROM chunks WHERE iz <> 2)"
_OUTSIDE = "x < min_x - 0.001 OR x > max_x + 0.001 OR y < min_y - 0.001 OR y > max_y + 0.001 OR z < min_z - 0.001 OR z > max_z + 0.001"


def _with(names: list[str], select: str) -> str:
    return "WITH " + ",\n".join(_CTES[n] for n in names) + "\n" + select


_COLOR = "CASE WHEN row_ord % 11 = 0 THEN NULL ELSE (row_ord % 350) / 100.0 END"
_SKIP = "CASE WHEN parallax <= 0 THEN 'non-positive' WHEN parallax_error <= 0 OR parallax / parallax_error < 5 THEN 'below SNR threshold' WHEN 1000 / parallax > 100000 THEN 'distance exceeds 100 kpc' END"
_TAG = "CASE WHEN {0} IS NULL THEN 'Inferred' ELSE 'Observed' END"
_BOUNDS = ", ".join(f"round({m}_{c}, 6) AS {m}_{c}" for m in ("min", "max") for c in "xyz")

ORACLE_SQL: dict[str, str] = {
    "q_quality_filter": _with(_STARS, "SELECT source_id, round(parallax, 6) AS parallax, round(parallax / parallax_error, 6) AS snr FROM kept"),
    "q_skip_reasons": _with(["raw_stars"], f"SELECT CASE WHEN r IS NULL THEN 'kept' ELSE 'parallax' END AS field, coalesce(r, 'kept') AS reason, count(*) AS n FROM (SELECT {_SKIP} AS r FROM raw_stars) GROUP BY ALL"),
    "q_cartesian": _with([*_STARS, "placed"], "SELECT source_id, round(1000 / parallax, 6) AS distance_pc, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM placed"),
    "q_name_norm": _with(["raw_planets"], "SELECT planet_name, host FROM raw_planets"),
    "q_angular_sep": _with(["raw_stars"], f"SELECT source_id, round({_sep('180.0', '10.0')}, 3) AS sep_arcsec FROM raw_stars"),
    "q_host_group": _with(["raw_planets", "hosts"], "SELECT host, n_planets, round(h_ra, 6) AS ra, round(h_dec, 6) AS dec_deg FROM hosts"),
    "q_name_match": _with([*_STARS, "raw_planets", "hosts", "named"], "SELECT host, source_id FROM named"),
    "q_proximity_match": _with(_MATCH, "SELECT host, source_id, round(sep, 6) AS sep_arcsec FROM near"),
    "q_two_pass_match": _with([*_MATCH, "named", "two_pass"], "SELECT * FROM two_pass"),
    "q_unmatched_hosts": _with(_MATCH, "SELECT host FROM hosts WHERE host NOT IN (SELECT host FROM near)"),
    "q_match_stats": _with(
        [*_MATCH, "named", "two_pass"],
        "SELECT (SELECT count(*) FROM hosts) AS total_hosts, (SELECT CAST(sum(n_planets) AS BIGINT) FROM hosts) AS total_planets, count(*) FILTER (match_pass = 1) AS matched_pass1, count(*) FILTER (match_pass = 2) AS matched_pass2, "
        "(SELECT count(*) FROM hosts) - count(*) AS unmatched, round(count(*) / (SELECT count(*) FROM hosts), 6) AS match_rate FROM two_pass",
    ),
    "q_attach_planets": _with(
        [*_MATCH, "attached"],
        "SELECT k.source_id, coalesce(n, 0) AS n_planets, first_planet, n IS NOT NULL AS has_planets FROM kept k LEFT JOIN (SELECT source_id, count(*) AS n, arg_min(planet_name, (host, row_ord)) AS first_planet FROM attached GROUP BY source_id) USING (source_id)",
    ),
    "q_planet_estimates": _with(
        [*_CATALOG, "attached"],
        f"SELECT source_id, planet_name, round({_RADIUS}, 6) AS radius_earth, round(coalesce(eq_temp_kelvin, {_eq_temp('filled')}), 6) AS eq_temp_kelvin, {_TAG.format('radius_earth')} AS quality, {_TAG.format('eq_temp_kelvin')} AS eq_temp_quality "
        "FROM (SELECT a.*, c.filled FROM attached a JOIN colored c USING (source_id))",
    ).replace("round(coalesce(eq_temp_kelvin, CASE", "round(coalesce(eq_temp_kelvin, CASE WHEN filled IS NULL THEN NULL"),
    "q_stage4_counters": _with(
        [*_CATALOG, "attached"],
        "SELECT (SELECT count(*) FROM colored WHERE bp_rp IS NULL AND filled IS NOT NULL) AS bp_rp_inferred, count(*) FILTER (radius_earth IS NULL) AS radius_inferred, CAST(0 AS BIGINT) AS radius_unresolvable, "
        f"count(*) FILTER (eq_temp_kelvin IS NULL AND t IS NOT NULL) AS temp_inferred, count(*) FILTER (eq_temp_kelvin IS NULL AND t IS NULL) AS temp_unresolvable FROM (SELECT a.*, CASE WHEN filled IS NOT NULL THEN {_eq_temp('filled')} END AS t FROM attached a JOIN colored USING (source_id))",
    ),
    "q_no_planet_branch": _with(_CELLED, f"SELECT source_id, round(coalesce(bp_rp, 0.82), 6) AS color_index, {_TAG.format('bp_rp')} AS quality, false AS has_planets, ix, iy, iz FROM celled"),
    "q_stage12_stats": _with(
        ["raw_stars"],
        f"SELECT count(*) AS total_rows, count(r) AS skipped_rows, count(*) - count(r) AS stars, count(bp_rp) FILTER (r IS NULL) AS with_color, round(100.0 * count(bp_rp) FILTER (r IS NULL) / (count(*) - count(r)), 1) AS percent_with_color FROM (SELECT bp_rp, {_SKIP} AS r FROM raw_stars)",
    ),
    "q_bin_median": _with([*_CELLED, "colored"], "SELECT ix, iy, iz, mag_bin, n, round(v, 6) AS median_bp_rp FROM medians"),
    "q_color_impute": _with([*_CELLED, "colored"], f"SELECT source_id, round(coalesce(filled, 0.82), 6) AS color_index, {_TAG.format('filled')} AS quality, {_TAG.format('bp_rp')} AS color_quality FROM colored"),
    "q_radius_infer": _with(["raw_planets"], f"SELECT planet_name, round({_RADIUS}, 6) AS radius_earth, {_TAG.format('radius_earth')} AS quality FROM raw_planets"),
    "q_eq_temp": _with(
        ["raw_planets"],
        f"SELECT planet_name, CASE WHEN color IS NULL THEN NULL ELSE round({_teff('color')}, 6) END AS star_kelvin, round(coalesce(eq_temp_kelvin, CASE WHEN color IS NOT NULL THEN {_eq_temp('color')} END), 6) AS eq_temp_kelvin, {_TAG.format('eq_temp_kelvin')} AS quality FROM (SELECT *, {_COLOR} AS color FROM raw_planets)",
    ),
    "q_quality_distribution": _with(
        _CATALOG,
        "SELECT q AS quality, count(quality) AS n, round(100.0 * count(quality) / (SELECT count(*) FROM catalog), 1) AS percent FROM (VALUES ('Observed'), ('Inferred'), ('Synthetic')) t(q) LEFT JOIN catalog ON q = quality GROUP BY q",
    ),
    "q_chunk_assign": _with(_CELLED, "SELECT source_id, ix, iy, iz, 'catalog_' || ix || '_' || iy || '_' || iz || '.bin' AS file_name FROM celled"),
    "q_chunk_count": _with(_CELLED, "SELECT count(*) AS n_chunks FROM (SELECT DISTINCT ix, iy, iz FROM celled)"),
    "q_manifest": _with(_CHUNKS, f"SELECT ix, iy, iz, star_count, planet_star_count, observed_count, inferred_count, synthetic_count, {_BOUNDS}, 'catalog_' || ix || '_' || iy || '_' || iz || '.bin' AS file_name FROM chunks"),
    "q_manifest_totals": _with(_CHUNKS, "SELECT CAST(sum(star_count) AS BIGINT) AS total_stars, CAST(sum(planet_star_count) AS BIGINT) AS total_planets, count(*) AS n_chunks FROM chunks"),
    "q_chunks_in_radius": _with(_CHUNKS, "SELECT ix, iy, iz, star_count FROM chunks WHERE min_x <= 140 AND max_x >= -100 AND min_y <= 90 AND max_y >= -150 AND min_z <= 130 AND max_z >= -110"),
    "q_chunk_lookup": _with(_CHUNKS, "SELECT ix, iy, iz, star_count, planet_star_count FROM chunks WHERE ix = 0 AND iy = 0 AND iz = 0"),
    "q_verify_counts": _with([*_CHUNKS, "damaged"], "SELECT ix, iy, iz, coalesce(star_count, 0) AS star_count, count(*) AS found, coalesce(star_count, 0) = count(*) AS count_ok FROM catalog LEFT JOIN damaged USING (ix, iy, iz) GROUP BY ix, iy, iz, star_count"),
    "q_verify_aabb": _with(
        [*_CHUNKS, "damaged"],
        f"SELECT ix, iy, iz, count(*) FILTER ({_OUTSIDE}) AS outside, count(*) FILTER ({_OUTSIDE}) = 0 AS aabb_ok, coalesce(min(source_id) FILTER ({_OUTSIDE}), -1) AS stray_id, round(coalesce(arg_min(x, source_id) FILTER ({_OUTSIDE}), 0), 6) AS stray_x FROM catalog LEFT JOIN damaged USING (ix, iy, iz) GROUP BY ix, iy, iz",
    ),
    "q_verify_total": _with(
        [*_CHUNKS, "damaged"],
        "SELECT total_stars, loaded, total_stars = loaded AS total_ok FROM (SELECT CAST(sum(star_count) AS BIGINT) AS total_stars FROM chunks), (SELECT count(*) AS loaded FROM catalog JOIN damaged USING (ix, iy, iz))",
    ),
    "q_csv_stars": _with(
        ["raw_stars"],
        f"SELECT source_id, round(ra, 6) AS ra, round(parallax, 6) AS parallax, round(bp_rp, 6) AS bp_rp, CASE WHEN ra IS NULL THEN 'ra' WHEN parallax IS NULL THEN 'parallax' WHEN bad_mag THEN 'magnitude' WHEN {_SKIP} IS NOT NULL THEN 'parallax' END AS skip_field, "
        f"CASE WHEN ra IS NULL OR parallax IS NULL OR bad_mag THEN 'parse failure' ELSE {_SKIP} END AS skip_reason FROM (SELECT source_id, CASE WHEN source_id % 11 <> 0 THEN ra END AS ra, CASE WHEN source_id % 13 <> 0 THEN parallax END AS parallax, parallax_error, source_id % 17 = 0 AS bad_mag, CASE WHEN source_id % 5 <> 0 THEN bp_rp END AS bp_rp FROM raw_stars)",
    ),
    "q_csv_planets": _with(
        ["raw_planets"],
        "SELECT planet_name, CASE WHEN row_ord % 7 <> 0 THEN host END AS host, CASE WHEN row_ord % 11 <> 0 THEN round(semi_major_au, 6) END AS semi_major_au, round(radius_earth, 6) AS radius_earth, row_ord % 7 <> 0 AND row_ord % 11 <> 0 AND row_ord % 13 <> 0 AS usable FROM raw_planets",
    ),
    "q_chunk_files": _with(_CELLED, f"SELECT source_id, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, round(coalesce(bp_rp, 0.82), 6) AS color_index, {_TAG.format('bp_rp')} AS quality FROM celled WHERE ix = 0 AND iy = 0 AND iz = 0"),
    "q_sol_sample": _with([*_CATALOG, "attached"], "SELECT source_id, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, magnitude, round(coalesce(filled, 0.82), 6) AS color_index, quality, has_planets, (SELECT count(*) FROM attached a WHERE a.source_id = catalog.source_id) AS n_planets FROM catalog WHERE ix = 0 AND iy = 0 AND iz = 0 ORDER BY source_id LIMIT 3"),
}

ORACLE_SQL["q_incremental_manifest"] = ORACLE_SQL["q_manifest"]  # what one build over all files gives
ORACLE_SQL["q_bin_median_selection"] = _with([*_CELLED, "colored"], "SELECT ix, iy, iz, mag_bin, n, round(CAST(CAST(v AS FLOAT) AS DOUBLE), 6) AS median_bp_rp FROM medians")
ORACLE_SQL["q_magnitude_medians"] = _with(_CELLED, "SELECT mag_bin, count(*) AS n, round(median(parallax), 6) AS median_parallax FROM celled GROUP BY mag_bin")
_DISTANCE = "sqrt((x - 20) * (x - 20) + (y + 30) * (y + 30) + (z - 10) * (z - 10))"
ORACLE_SQL["q_content_diff"] = _with(
    _CELLED,
    "SELECT source_id, ix, iy, iz, CASE WHEN source_id % 101 = 7 THEN 'removed' ELSE 'changed' END AS kind FROM celled WHERE source_id % 101 = 7 OR source_id % 97 = 5 "
    "UNION ALL SELECT -source_id, ix, iy, iz, 'added' FROM celled WHERE source_id % 89 = 11",
)
ORACLE_SQL["q_content_damage"] = _with(_CELLED, "SELECT DISTINCT ix, iy, iz FROM celled WHERE source_id % 1009 = 3")
ORACLE_SQL["q_stars_in_radius"] = _with([*_STARS, "placed"], f"SELECT source_id, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, round({_DISTANCE}, 6) AS distance FROM placed WHERE {_DISTANCE} <= 40")
ORACLE_SQL["q_nearest_to_point"] = _with([*_STARS, "placed"], f"SELECT source_id, round({_DISTANCE}, 6) AS distance FROM placed ORDER BY {_DISTANCE}, source_id LIMIT 25")
_DENSE = """
stars AS (
  SELECT source_id, CASE WHEN source_id % 2 = 0 THEN 150 + source_id * 7919 % 100003 * 1e-8 ELSE ra END AS ra,
    CASE WHEN source_id % 2 = 0 THEN 2 + source_id * 104729 % 100003 * 1e-8 ELSE dec_deg END AS dec_deg FROM kept
), near_planets AS (
  SELECT row_ord, CASE WHEN row_ord % 5 = 0 THEN 'dense ' || row_ord ELSE host END AS host, CASE WHEN row_ord % 5 = 0 THEN 150 + row_ord * 31337 % 100003 * 1e-8 ELSE ra END AS ra,
    CASE WHEN row_ord % 5 = 0 THEN 2 + row_ord * 27644437 % 100003 * 1e-8 ELSE dec_deg END AS dec_deg FROM raw_planets WHERE row_ord % 5 IN (0, 1)
), near_hosts AS (
  SELECT host, arg_min(ra, row_ord) AS h_ra, arg_min(dec_deg, row_ord) AS h_dec FROM near_planets GROUP BY host
)"""
ORACLE_SQL["q_proximity_dense"] = (
    "WITH " + ",\n".join([_CTES[c] for c in ("raw_stars", "kept", "raw_planets")] + [_DENSE.strip()])
    + f"\nSELECT host, source_id, round(sep, 6) AS sep_arcsec FROM (SELECT host, source_id, {_sep('h_ra', 'h_dec')} AS sep FROM near_hosts, stars WHERE abs(h_dec - dec_deg) < 0.001) "
    "WHERE sep < 2 QUALIFY row_number() OVER (PARTITION BY host ORDER BY sep, source_id) = 1"
)
ORACLE_SQL["q_sql_chunks_in_radius"] = ORACLE_SQL["q_chunks_in_radius"]
ORACLE_SQL["q_sql_angular_sep"] = ORACLE_SQL["q_angular_sep"]
ORACLE_SQL["q_sql_cone_search"] = _with(_CELLED, f"SELECT source_id, round(sep, 3) AS angle_arcsec, ix, iy, iz FROM (SELECT *, {_sep('150.0', '20.0')} AS sep FROM celled) WHERE sep < 36000")
ORACLE_SQL["q_csv_rejects"] = _with(
    ["raw_stars"],
    "SELECT CASE WHEN source_id % 23 = 0 THEN 'row' WHEN r IS NULL THEN 'kept' ELSE 'parallax' END AS field, CASE WHEN source_id % 23 = 0 THEN 'malformed row' ELSE coalesce(r, 'kept') END AS reason, count(*) AS n "
    f"FROM (SELECT source_id, {_SKIP} AS r FROM (SELECT source_id, CASE WHEN source_id % 29 = 0 THEN 0.005 ELSE parallax END AS parallax, CASE WHEN source_id % 29 = 0 THEN 0.0005 ELSE parallax_error END AS parallax_error FROM raw_stars)) GROUP BY ALL",
)
ORACLE_SQL["q_fits_stars"] = ORACLE_SQL["q_csv_stars"]  # the same values are missing
