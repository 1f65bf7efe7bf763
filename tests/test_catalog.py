import json
import math
import random

import pytest
from pyspark.sql import functions as F

from orrery.config import CatalogConfig
from orrery.operators import chunks, crossmatch, impute, quality
from orrery.plans import cli, sinks
from orrery.plans.catalog import build, require_coordinates, with_coordinates
from orrery.schemas import RAW_PLANET, RAW_STAR
from orrery.sources.csv_files import SourceError, planet_counts, planet_rows, read_planet_csv, read_star_csv
from orrery.sources.storage import read_text, write_text

HEADER = "source_id,ra,dec,parallax,parallax_error,phot_g_mean_mag,bp_rp\n"
PLANETS = "pl_name,hostname,ra,dec,pl_orbsmax,pl_orbper,pl_rade,pl_eqt,discoverymethod\n"


def star_line(i, plx=747.1, err=5.0, color="0.71"):
    return f"{i},219.8996,-60.8335,{plx},{err},4.38,{color}\n"


def parsed(spark, path):
    return quality.parse_stars(read_star_csv(spark, str(path)))


def stars(spark, rows):
    return spark.createDataFrame([(i, float(ra), float(dec), float(plx), 0.1, float(mag), color) for i, ra, dec, plx, mag, color in rows], RAW_STAR)


def planets(spark, rows):
    return spark.createDataFrame([(k, f"p{k}", host, float(ra), float(dec), 1.0, 50.0, None, None, "Transit") for k, (host, ra, dec) in enumerate(rows)], RAW_PLANET)


def test_gates(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text(HEADER + star_line(1) + star_line(2, color="") + star_line(3, -0.5, 1.0) + star_line(4, 1.0, 0.4) + star_line(5, 1.0, 0.1) + star_line(6, 0.005, 0.0005) + star_line("not_a_number") + star_line(7, 0.01, 0.001) + star_line(8, 5.0, 1.0) + star_line(9, 5.0, 0) + star_line(10, "nan", 1.0) + "11,1,2\n" + star_line(12, color="1.0d"))
    rows = parsed(spark, f)
    kept = {r["source_id"]: r["bp_rp"] for r in quality.kept_stars(rows).collect()}
    assert sorted(kept) == [1, 2, 5, 7, 8, 10, 12]
    assert kept[1] == pytest.approx(0.71) and kept[2] is None and kept[12] is None
    log = {r["line"]: (r["field"], r["reason"]) for r in quality.rejects(rows).collect()}
    assert log == {4: ("parallax", quality.NON_POSITIVE), 5: ("parallax", quality.LOW_SNR), 7: ("parallax", quality.TOO_FAR), 8: ("source_id", quality.PARSE_FAILURE), 11: ("parallax", quality.LOW_SNR), 13: ("row", "malformed row")}
    assert rows.count() == len(kept) + len(log)  # each row is in exactly one of them


def test_headers_by_file(spark, tmp_path):
    (tmp_path / "b.csv").write_text("bp_rp,dec,ra,source_id,parallax_error,parallax,extra, phot_g_mean_mag ,ra\n0.5,2,1,20,1,10,x,9,77\n")
    (tmp_path / "a.csv").write_text(HEADER + star_line(10))
    (tmp_path / "ignored.txt").write_text("x")
    found = {r["source_id"]: (r["ra"], r["dec_deg"], r["parallax"]) for r in quality.kept_stars(parsed(spark, tmp_path)).collect()}
    assert found == {10: (219.8996, -60.8335, 747.1), 20: (1.0, 2.0, 10.0)}
    (tmp_path / "c.csv").write_text("source_id,ra\n1,2\n")
    with pytest.raises(SourceError, match="lacks"):
        parsed(spark, tmp_path)


def test_no_input(spark, tmp_path):
    with pytest.raises(SourceError, match="no CSV"):
        read_star_csv(spark, str(tmp_path))
    (tmp_path / "a.csv").write_text(HEADER + star_line(1, -1))
    with pytest.raises(SourceError, match="no star"):
        quality.kept_stars(parsed(spark, tmp_path))


def test_planet_csv(spark, tmp_path):
    f = tmp_path / "p.csv"
    f.write_text("# comment\n" + PLANETS.upper() + " b ,Host A,1,2,0.5,10,,400,Transit\n,Host A,1,2,0.5,10,1,400,Transit\nc,Host A,1,2,,10,1,400,Transit\nd,Host A,1,2,0.5,x,1,400,Transit\ne,Host B,1,2,0.5,10,bad,,RV\n")
    rows = {r["planet_name"]: r for r in read_planet_csv(spark, str(f)).collect()}
    assert sorted(rows) == ["b", "e"]
    assert rows["b"]["radius_earth"] is None and rows["b"]["eq_temp_kelvin"] == 400 and rows["e"]["radius_earth"] is None
    assert planet_counts(planet_rows(spark, str(f))).first().asDict() == {"planets_parsed": 2, "planets_skipped": 3}
    f.write_text(PLANETS + "e,Host,1,2,0.5,10,7,,RV\ne,Host,1,2,0.5,10,8,,RV\n")
    assert [r["radius_earth"] for r in read_planet_csv(spark, str(f), dedupe=True).collect()] == [7]
    f.write_text(PLANETS)
    with pytest.raises(SourceError):
        read_planet_csv(spark, str(f))


def brute_force(hosts, rows, limit):
    def sep(a, b):
        (r1, d1), (r2, d2) = ([math.radians(x) for x in p] for p in (a, b))
        h = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((r2 - r1) / 2) ** 2
        return math.degrees(2 * math.asin(math.sqrt(min(1, h)))) * 3600

    out = {}
    for host, ra, dec in hosts:
        near = sorted((sep((ra, dec), (r[1], r[2])), r[0]) for r in rows)
        if near and near[0][0] < limit:
            out[host] = near[0][1]
    return out


def test_nearest_star(spark):
    rows = [(1, 359.9999, 0, 10, 5, 1.0), (2, 0.0, 90, 10, 5, 1.0), (3, 200, -90, 10, 5, 1.0), (4, 50, 10, 10, 5, 1.0), (5, 50, 10, 10, 5, 1.0), (6, 80, 10.0005, 10, 5, 1.0), (7, 80, 10.0004, 10, 5, 1.0)]
    hosts = [("wrap", 0.0001, 0), ("north", 123, 89.9999), ("south", 10, -89.9999), ("tie", 50, 10), ("near", 80, 10), ("none", 150, 10), ("tie again", 50, 10)]
    s, h = stars(spark, rows), crossmatch.group_hosts(planets(spark, hosts))
    for limit in (2.0, 3600.0, 400_000.0):
        config = CatalogConfig(proximity_arcsec=limit)
        found = {r["host"]: r["source_id"] for r in crossmatch.match_nearest(h, s, config).collect()}
        assert found == brute_force(hosts, rows, limit)
    # The shuffle join, where hosts are too many for a broadcast, gives the same.
    small = CatalogConfig(broadcast_hosts=1)
    assert {r["host"] for r in crossmatch.match_nearest(h, s, small).collect()} == {"wrap", "north", "south", "tie", "near", "tie again"}


def test_dense_fields_are_split(spark):
    """Half of all stars in one cell: the same matches as by brute force, and no join key with many more stars than the bound."""
    r, bound = random.Random(11), 40
    rows = [(i, r.uniform(0, 360), r.uniform(-89, 89)) for i in range(600)] + [(600 + i, 80.0 + r.uniform(0, 1e-3), 20.0 + r.uniform(0, 1e-3)) for i in range(600)]
    rows += [(1_200, 80.0005, 20.0005), (1_201, 80.0005, 20.0005)]
    hosts = spark.createDataFrame([(f"h{k}", 80.0 + r.uniform(-2e-4, 1.2e-3), 20.0 + r.uniform(0, 1e-3)) for k in range(30)] + [("tie", 80.0005, 20.0005), ("lone", 200.0, 0.0)], "host string, ra double, dec_deg double")
    table = spark.createDataFrame(rows, "source_id long, ra double, dec_deg double").repartition(5)
    config = CatalogConfig(broadcast_hosts=0, dense_cell=bound)
    got = {x["host"]: x["source_id"] for x in crossmatch.match_nearest(hosts, table, config).collect()}
    assert got == {x["host"]: x["source_id"] for x in crossmatch.match_nearest(hosts, table).collect()} and got["tie"] == 1_200 and "lone" not in got and len(got) > 25
    placed = table.select("source_id", "ra", "dec_deg", F.floor("ra").alias("g"))
    around, split = crossmatch.split_dense(placed.select("g").distinct(), placed, ["g"], bound)
    sizes = {(x["g"], x["part"]): x["count"] for x in split.groupBy("g", "part").count().collect()}
    assert sum(sizes.values()) == len(rows) and max(sizes.values()) <= 2 * bound and len([k for k in sizes if k[0] == 80]) >= 600 // (2 * bound)
    assert set(sizes) <= {(x["g"], x["part"]) for x in around.collect()}


def rows_of(plan, node):
    """Rows that the nodes of a plan that has run put out, by the name of their kind."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return rows_of(plan.executedPlan(), node)
    if plan.nodeName().endswith("QueryStage"):
        return rows_of(plan.plan(), node)
    metric = plan.metrics().get("numOutputRows") if node in plan.nodeName() else None
    below = plan.children()
    return (metric.get().value() if metric is not None and metric.isDefined() else 0) + sum(rows_of(below.apply(i), node) for i in range(below.size()))


def test_hosts_of_a_dense_field_are_few_rows(spark):
    """A field with 4,000 stars, in groups at one place, and 500 hosts: neither hosts nor pairs grow with the number of its parts."""
    r = random.Random(12)
    at = [(80.0 + r.uniform(0, 1e-3), 20.0 + r.uniform(0, 1e-3)) for _ in range(1_000)]
    table = spark.createDataFrame([(4 * i + k, *p) for i, p in enumerate(at) for k in range(4)], "source_id long, ra double, dec_deg double")
    far = [("edge", 80.0, 20.0015), ("sparse", 80.0, 20.0019)]  # within the radius of a few stars, of none
    hosts = spark.createDataFrame([(f"h{k}", 80.0 + r.uniform(0, 1e-3), 20.0 + r.uniform(0, 1e-3)) for k in range(500)] + far, "host string, ra double, dec_deg double")
    out = crossmatch.match_nearest(hosts, table, CatalogConfig(dense_cell=20), few=False)
    got = {x["host"]: (x["source_id"], x["sep_arcsec"]) for x in out.collect()}
    assert got == {x["host"]: (x["source_id"], x["sep_arcsec"]) for x in crossmatch.match_nearest(hosts, table).collect()} and len(got) >= 501
    plan = out._jdf.queryExecution().executedPlan()
    assert rows_of(plan, "Generate") < 100 * 500 and rows_of(plan, "SortMergeJoin") < 200 * 500


def test_threshold_is_strict(spark):
    s, h = stars(spark, [(1, 0, 0, 10, 5, 1.0)]), crossmatch.group_hosts(planets(spark, [("a", 0, 1 / 3600)]))
    exact = spark.range(1).select(crossmatch.separation_arcsec(F.lit(0.0), F.lit(1 / 3600), F.lit(0.0), F.lit(0.0))).first()[0]
    assert crossmatch.match_nearest(h, s, CatalogConfig(proximity_arcsec=exact)).count() == 0
    assert crossmatch.match_nearest(h, s, CatalogConfig(proximity_arcsec=exact * 1.001)).count() == 1


def test_two_hosts_on_a_star_and_names(spark):
    s = stars(spark, [(1, 10, 10, 10, 5, 1.0), (2, 20, 20, 10, 5, 1.0)]).withColumn("designation", F.when(F.col("source_id") == 2, "Gliese 1"))
    p = planets(spark, [("B", 10, 10), ("A", 10, 10), ("GJ  1", 99, 0), ("C", 200, 0), ("A", 10, 10)])
    h = crossmatch.group_hosts(p)
    m = crossmatch.match_hosts(h, s)
    assert {tuple(r) for r in m.collect()} == {("a", 1, 2), ("b", 1, 2), ("gj 1", 2, 1)}
    assert [r["host"] for r in crossmatch.unmatched_hosts(h, m).collect()] == ["c"]
    st = crossmatch.match_statistics(h, m).first()
    assert (st["total_hosts"], st["total_planets"], st["matched_pass1"], st["matched_pass2"], st["unmatched"], st["match_rate"]) == (4, 5, 1, 2, 1, 0.75)
    got = {r["source_id"]: [x["planet_name"] for x in r["planets"]] for r in crossmatch.attach_planets(s, p, m).collect()}
    assert got == {1: ["p1", "p4", "p0"], 2: ["p2"]}
    nothing = crossmatch.match_statistics(h.limit(0), m.limit(0)).first()
    assert nothing["match_rate"] == 0


def test_color_bins(spark):
    at = lambda i, mag, color: (i, 0, 0, 1000, mag, color)  # noqa: E731  one cell
    cases = {
        "exact": ([at(1, 5.0, 0.8), at(2, 5.1, 1.0), at(3, 5.0, None), at(4, 5.6, 9.0)], 0.9),
        "above": ([at(1, 5.6, 0.7), at(3, 5.0, None)], 0.7),
        "below": ([at(1, 4.9, 0.6), at(3, 5.0, None)], 0.6),
        "both": ([at(1, 4.9, 0.6), at(2, 5.6, 0.7), at(3, 5.0, None)], 0.7),
        "neither": ([at(1, 7.0, 0.6), at(3, 5.0, None)], None),
    }
    for name, (rows, wanted) in cases.items():
        got = {r["source_id"]: r["filled_bp_rp"] for r in impute.impute_colors(with_coordinates(stars(spark, rows))).collect()}[3]
        assert got == (pytest.approx(wanted) if wanted else None), name


def test_quality_tags_and_branch_without_planets(spark):
    s = stars(spark, [(1, 0, 0, 1000, 5.0, 0.65), (2, 0, 0, 1000, 5.0, None), (3, 0, 0, 1, 5.0, None)])
    with_p = {r["source_id"]: r for r in build(s, planets(spark, [("x", 0, 0)])).stars.collect()}
    assert (with_p[2]["quality"], with_p[2]["color_quality"]) == ("Observed", "Inferred")
    assert (with_p[3]["quality"], with_p[3]["color_index"]) == ("Inferred", pytest.approx(0.82))
    assert [r["has_planets"] for _, r in sorted(with_p.items())] == [True, False, False]
    p = with_p[1]["planets"][0]
    assert (p["radius_earth"], p["quality"], p["eq_temp_quality"]) == (2.5, "Inferred", "Inferred")
    without = {r["source_id"]: r for r in build(s).stars.collect()}
    assert without[2]["quality"] == "Inferred" and without[2]["color_index"] == pytest.approx(0.82) and without[1]["quality"] == "Observed"


def test_boxes_skip_nan(spark):
    rows = spark.createDataFrame([(0, 0, 0, 1.0, math.nan, 2.0, True, "Observed"), (0, 0, 0, 3.0, 4.0, math.nan, False, "Inferred")], "ix int, iy int, iz int, x double, y double, z double, has_planets boolean, quality string")
    r = chunks.chunk_metadata(rows).first()
    assert (r["min_x"], r["max_x"], r["min_y"], r["max_y"], r["min_z"], r["max_z"]) == (1, 3, 4, 4, 2, 2)
    assert (r["star_count"], r["planet_star_count"], r["observed_count"], r["inferred_count"], r["synthetic_count"], r["file_name"]) == (2, 1, 1, 1, 0, "catalog_0_0_0.bin")


def test_radius_query(spark):
    boxes = spark.createDataFrame([(0, 0, 0, 0.0, 0.0, 0.0, 10.0, 10.0, 10.0), (1, 0, 0, 60.0, 0.0, 0.0, 70.0, 10.0, 10.0), (1, 1, 0, 60.0, 60.0, 0.0, 70.0, 70.0, 10.0)], "ix int, iy int, iz int, min_x double, min_y double, min_z double, max_x double, max_y double, max_z double")
    ids = lambda df: sorted((r["ix"], r["iy"]) for r in df.collect())
    assert ids(chunks.chunks_in_radius(boxes, (0, 0, 0), 60.0)) == [(0, 0), (1, 0), (1, 1)]  # touching counts
    assert ids(chunks.chunks_in_radius(boxes, (0, 0, 0), 59.0, 50.0)) == [(0, 0)]
    assert ids(chunks.chunks_in_radius(boxes, (0, 0, 0), 60.0, exact_sphere=True)) == [(0, 0), (1, 0)]
    assert ids(chunks.chunks_in_radius(boxes, (0, 0, 0), -1.0)) == []
    assert ids(chunks.chunk_by_id(boxes, 1, 1, 0)) == [(1, 1)] and ids(chunks.chunk_by_id(boxes, 9, 9, 9)) == []


@pytest.mark.parametrize("with_planets", [True, False])
def test_command_line(spark, tmp_path, capsys, with_planets):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "a.csv").write_text(HEADER + "".join(f"{i},{i * 7 % 360},{i % 90},{10 + i % 5},0.1,{i % 12},{'' if i % 3 else 0.5}\n" for i in range(1, 200)) + star_line("bad"))
    args = ["build", "--gaia-path", str(src), "--output-path", str(out), "--stats", "--chunk-size", "20"]
    if with_planets:
        (tmp_path / "p.csv").write_text(PLANETS + "b,H1,7,1,0.5,10,,,Transit\nc,H2,1,-80,0.5,10,,,Transit\n")
        args += ["--exoplanet-path", str(tmp_path / "p.csv")]
    assert cli.main(args, spark) == 0
    assert "total_stars: 199" in capsys.readouterr().out
    doc = json.loads((out / "manifest.json").read_text())
    assert doc["version"] == 1 and doc["total_stars"] == sum(c["star_count"] for c in doc["chunks"]) == 199
    assert doc["total_planets"] == int(with_planets)
    assert [c["id"] for c in doc["chunks"]] == sorted(c["id"] for c in doc["chunks"])
    assert not list(out.glob("*.tmp"))
    if with_planets:
        assert (out / "unmatched_hosts.txt").read_text().splitlines()[2:] == ["h2"]
    assert "SKIP line=201 field=source_id" in "".join(p.read_text() for p in (out / "rejects").glob("part-*"))
    assert cli.main(["verify", "--output-path", str(out)], spark) == 0
    # Unchanged stages are taken up; another parameter or changed input isn't.
    def made():
        return (out / "parsed.parquet" / "_SUCCESS").stat().st_mtime_ns

    before = made()
    assert cli.main([*args, "--resume"], spark) == 0 and made() == before
    assert cli.main([*args, "--resume", "--parallax-snr", "4"], spark) == 0 and made() > before
    (src / "a.csv").write_text(HEADER + star_line(1))
    assert cli.main([*args, "--resume", "--parallax-snr", "4"], spark) == 0 and json.loads((out / "manifest.json").read_text())["total_stars"] == 1


def build_catalog_folder(spark, tmp_path, n=200):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "a.csv").write_text(HEADER + "".join(f"{i},{i * 7 % 360},{i % 90},{10 + i % 5},0.1,{i % 12},0.5\n" for i in range(1, n)))
    (tmp_path / "p.csv").write_text(PLANETS + "b,H1,7,1,0.5,10,,,Transit\n")
    assert cli.main(["build", "--gaia-path", str(src), "--output-path", str(out), "--chunk-size", "20", "--exoplanet-path", str(tmp_path / "p.csv"), "--stats"], spark) == 0
    return out


def rewrite(path, change):
    doc = json.loads(path.read_text())
    change(doc)
    path.unlink()
    path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    path.write_text(json.dumps(doc))


def test_statistics_come_from_the_writing_pass(spark, tmp_path):
    """The counts of a build are observed while its tables are written: its statistics scan none of them; a resumed one has to."""
    from argparse import Namespace

    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "a.csv").write_text(HEADER + "".join(f"{i},{i * 7 % 360},{i % 90},{10 + i % 5},0.1,{i % 12},{'' if i % 3 else 0.5}\n" for i in range(1, 40)) + star_line("bad"))
    (tmp_path / "p.csv").write_text(PLANETS + "b,H1,7,1,0.5,10,,,Transit\n")
    args = cli.parser().parse_args(["build", "--gaia-path", str(src), "--output-path", str(out), "--exoplanet-path", str(tmp_path / "p.csv"), "--chunk-size", "40"])
    assert isinstance(args, Namespace)
    built = cli.build_catalog(spark, args)
    scanned = lambda df: {part for f in df.inputFiles() for part in f.split("/") if part.endswith(".parquet") and not part.startswith("part-")}
    assert not scanned(built) & {"parsed.parquet", "catalog.parquet"}
    row = built.first()
    args.resume = True
    resumed = cli.build_catalog(spark, args)
    assert scanned(resumed) >= {"parsed.parquet", "catalog.parquet"}
    assert row == resumed.first()
    assert (row["total_rows"], row["skipped_rows"], row["stars"], row["stars_with_color"], row["radius_inferred"], row["temp_inferred"] + row["temp_unresolvable"]) == (40, 1, 39, 13, 1, 1)


def test_verifier_reports_every_fault(spark, tmp_path, capsys):
    out = build_catalog_folder(spark, tmp_path)
    told = capsys.readouterr().out
    assert "stars_with_color: 199" in told and "percent_with_color: 100.0" in told and "Manifest: 199 stars" in told
    assert cli.main(["verify", "--output-path", str(out)], spark) == 0
    told = capsys.readouterr().out
    doc = json.loads((out / "manifest.json").read_text())
    assert f"{len(doc['chunks'])} chunks verified, 199 stars" in told
    assert "Sol chunk: not in" in told or "planets" in told
    rewrite(out / "manifest.json", lambda d: d.update(total_stars=999))
    assert cli.main(["verify", "--output-path", str(out)], spark) == 1
    assert "total: manifest 999, found 199" in capsys.readouterr().out

    def damage(d):
        for c in d["chunks"]:
            c["star_count"] += 1
        d["chunks"][0]["aabb_max"] = [x - 500 for x in d["chunks"][0]["aabb_max"]]
        d["chunks"].append(d["chunks"][0] | {"id": [99, 99, 99]})

    rewrite(out / "manifest.json", damage)
    assert len(doc["chunks"]) > 25
    assert cli.main(["verify", "--output-path", str(out)], spark) == 1
    told = capsys.readouterr().out.splitlines()
    assert told[-1] == f"{len(doc['chunks']) + 1} faulty chunks" and sum("manifest" in x for x in told) == len(doc["chunks"]) + 1
    assert any("outside its box, the first " in x for x in told) and any(x.startswith("chunk 99_99_99: manifest") and x.endswith("found 0") for x in told)


def test_chunks_open_by_their_name(spark, tmp_path):
    out = build_catalog_folder(spark, tmp_path)
    doc = json.loads((out / "manifest.json").read_text())
    for c in doc["chunks"][:4]:
        assert sinks.open_chunk(spark, str(out), c["file_name"]).count() == c["star_count"]
    head = sinks.read_manifest_head(spark, str(out / "manifest.json"))
    assert (head["version"], head["chunk_size_parsecs"], head["chunks_per_partition_axis"], head["total_stars"], head["total_planets"]) == (1, 20.0, 8, 199, doc["total_planets"])
    assert {r["file_name"] for r in spark.read.parquet(str(out / "manifest.parquet")).collect()} == {c["file_name"] for c in doc["chunks"]}
    with pytest.raises(SourceError):
        sinks.open_chunk(spark, str(out), "catalog_9_9_9.bin")


def test_chunk_round_trips(spark, tmp_path):
    """Fields, nested planets, negative coordinates and an empty table survive writing and reading."""
    schema = "ix int, iy int, iz int, source_id bigint, x double, y double, z double, magnitude float, color_index float, has_planets boolean, quality string, planets array<struct<planet_name:string,semi_major_au:float,period_days:float,radius_earth:float,eq_temp_kelvin:float,quality:string>>"
    planet = ("b", 1.0, 365.0, 1.0, 255.0, "Observed")
    rows = [(0, 0, 0, 42, 10.0, 5.0, -3.0, 5.5, 0.82, True, "Observed", [planet, ("c", 2.0, 3.0, None, None, "Inferred")]), (-1, -1, -1, 99, -25.3, -0.7, -12.1, 8.2, 1.1, False, "Inferred", []), (0, 0, 0, 43, 20.0, 0.0, 0.0, 5.0, 0.8, False, "Observed", [])]
    table = spark.createDataFrame(rows, schema)
    sinks.write_catalog(table, str(tmp_path / "c"), CatalogConfig())
    back = sinks.read_chunks(spark, str(tmp_path / "c" / "chunks")).select(*table.columns)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, table.collect()))
    assert [r["source_id"] for r in sinks.open_chunk(spark, str(tmp_path / "c"), "catalog_-1_-1_-1.bin").collect()] == [99]
    assert [r["source_id"] for r in sinks.open_chunk(spark, str(tmp_path / "c"), "catalog_0_0_0.bin").collect()] == [42, 43]


def test_text_is_replaced_at_once(spark, tmp_path):
    path = str(tmp_path / "t.txt")
    write_text(spark, path, ["one"])
    with pytest.raises(ZeroDivisionError):
        write_text(spark, path, (str(1 // k) for k in (1, 0)))
    assert read_text(spark, path) == "one"
    write_text(spark, path, ["two", " parts"])
    assert read_text(spark, path) == "two parts"


@pytest.mark.parametrize("name", ["a b.csv", "a%20b.csv", "a+b.csv", "ä#b.csv"])
def test_order_of_files_with_odd_names(spark, tmp_path, name):
    (tmp_path / name).write_text(HEADER + star_line(1) + star_line("bad") + star_line(2))
    (tmp_path / "z.csv").write_text(HEADER + star_line(3) + star_line("worse"))
    parsed = quality.parse_stars(read_star_csv(spark, str(tmp_path)))
    kept = quality.kept_stars(parsed).orderBy("star_ord").collect()
    assert [r["source_id"] for r in kept] == ([1, 2, 3] if name < "z" else [3, 1, 2])
    assert [r["star_ord"]["file_ord"] for r in kept] == ([0, 0, 1] if name < "z" else [0, 1, 1])
    assert sorted(r["line"] for r in quality.rejects(parsed).collect()) == [3, 3]


def test_lines_over_splits(spark, tmp_path):
    """Line numbers of rejects in a file that is read in many splits."""
    lines = [star_line(i if i % 37 else "bad") for i in range(1, 3000)]
    (tmp_path / "a.csv").write_text(HEADER + "".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        parsed = quality.parse_stars(read_star_csv(spark, str(tmp_path)))
        assert parsed.select("block").distinct().count() > 5
        assert sorted(r["line"] for r in quality.rejects(parsed).collect()) == [i + 1 for i in range(1, 3000) if i % 37 == 0]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_catalog_plan_matches_once(spark):
    """The plan of the manifest has one match and scans stars three times: for the match, the medians and the catalog."""
    from orrery.plans.queries import QUERIES

    plan = QUERIES["q_manifest"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [o_orderkey") == 3 and plan.lower().count("asin(") == 3  # the separation, twice in the filter and as a column
    plan = QUERIES["q_stage4_counters"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [o_orderkey") == 3


def test_one_chunk_read(spark, tmp_path):
    config = CatalogConfig(chunks_per_partition_axis=2)
    catalog = build(stars(spark, [(i, i * 9, (i % 18) * 10 - 85, 5 + i % 7, 5, 1.0) for i in range(300)]), None, config).stars
    sinks.write_chunks(catalog, str(tmp_path / "c"), config)
    for r in chunks.chunk_metadata(catalog).limit(5).collect():
        part = sinks.read_chunks(spark, str(tmp_path / "c"), (r["ix"], r["iy"], r["iz"]))  # the layout is read from the table
        assert part.count() == r["star_count"]


def test_stream_equals_batch(spark, tmp_path):
    from orrery.streaming.stars import running_chunk_counts, stream_catalog, stream_rejects

    rows = stars(spark, [(i, i * 9, i % 80, 5 + i % 7 - 6 * (i % 2), 5, None if i % 3 else 0.7) for i in range(120)])
    rows.repartition(4).write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(RAW_STAR).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "s"))
    for name, make, mode in (("cat", stream_catalog, "append"), ("rej", stream_rejects, "append"), ("cnt", running_chunk_counts, "complete")):
        q = make(stream).writeStream.format("memory").queryName(name).outputMode(mode).start()
        q.processAllAvailable()
        q.stop()
        assert sorted(map(repr, spark.table(name).collect())) == sorted(map(repr, make(rows).collect()))


def test_views_and_missing_coordinates(spark):
    s = stars(spark, [(1, 0, 0, 1000, 5.0, 0.65), (2, 0, 0, 1000, 5.0, None)])
    build(s, planets(spark, [("x", 0, 0)])).register_views("t")
    assert spark.sql("SELECT s.source_id FROM t_stars s JOIN t_matches USING (source_id)").count() == 1
    assert spark.sql("SELECT star_count FROM t_chunks").first()[0] == 2
    with pytest.raises(Exception, match="without coordinates"):
        require_coordinates(with_coordinates(s).withColumn("x", F.when(F.col("source_id") == 1, F.col("x")))).collect()
