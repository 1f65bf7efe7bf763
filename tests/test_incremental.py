import json
import os
import random

import pytest

from orrery.config import CatalogConfig
from orrery.operators import quality
from orrery.plans import cli, compare, incremental, sinks
from orrery.plans.catalog import build
from orrery.plans.incremental import ingest, ledger, of_regions
from orrery.plans.oracle import ORACLE_SQL
from orrery.plans.queries import QUERIES
from orrery.sources.csv_files import SourceError, read_star_csv
from tests.conftest import assert_same

HEADER = "source_id,ra,dec,parallax,parallax_error,phot_g_mean_mag,bp_rp\n"
PLANETS = "pl_name,hostname,ra,dec,pl_orbsmax,pl_orbper,pl_rade,pl_eqt,discoverymethod\n"
CONFIG = CatalogConfig(chunk_size=40.0, chunks_per_partition_axis=2)


def lines(seed, n, first=0, ra=None, plx=(8, 60)):
    r = random.Random(seed)
    return "".join(
        f"{first + i},{r.uniform(0, 360) if ra is None else ra + r.uniform(0, 1e-3)},{r.uniform(-60, 60)},{r.uniform(*plx)},0.1,{r.uniform(3, 9)},{'' if i % 3 else round(r.uniform(0, 2), 3)}\n" for i in range(n)
    )


@pytest.fixture
def inputs(tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "b.csv").write_text(HEADER + lines(1, 120) + "bad,1,2,3,4,5,6\n")
    planets = tmp_path / "p.csv"
    planets.write_text(PLANETS + "x1,Far,10.0,5.0,0.5,10,,,Transit\nx2,Near,20.0,5.0,0.5,10,,,Transit\nx3,Near,20.0,5.0,1.5,400,2,300,RV\n")
    return src, planets, tmp_path


def star(i, ra, dec=5.0, plx=20, color=0.5):
    return f"{i},{ra},{dec},{plx},0.1,5.0,{color}\n"


def rows(spark, folder):
    chunks = sinks.read_chunks(spark, f"{folder}/chunks")
    manifest = spark.read.parquet(f"{folder}/manifest.parquet").drop("region")
    return sorted(map(repr, chunks.select(sorted(chunks.columns)).collect())), sorted(map(repr, manifest.select(sorted(manifest.columns)).collect()))


def files_of(folder):
    return {(p.parent.name, p.name, p.stat().st_mtime_ns) for p in folder.rglob("*.parquet")}


def has_planets(spark, folder):
    return {r["source_id"] for r in sinks.read_chunks(spark, f"{folder}/chunks").where("has_planets").collect()}


def test_batches_equal_one_build(spark, inputs, monkeypatch, capsys):
    """Files are added, changed and removed, a batch fails after it has replaced regions, and planets change: always as if all had been built at once."""
    src, planets, tmp = inputs
    out = tmp / "out"
    run = lambda: ingest(spark, str(src), str(out), str(planets), CONFIG)
    (src / "b.csv").write_text(HEADER + lines(1, 60) + "bad,1,2,3,4,5,6\n" + star(700, 10.0004, plx=10) + star(701, 20.0))
    (src / "far.csv").write_text(HEADER + star(950, 100.0, plx=2))
    first = run()
    assert first == {"added": 2, "changed": 0, "removed": 0, "batch": 1, "repaired_regions": 0, "regions": first["regions"]}
    assert has_planets(spark, out) == {700, 701}
    before = files_of(out / "chunks")

    # A file with a star nearer to a host, in another region, and with one as near as another host's, whose file comes later by name.
    (src / "a.csv").write_text(HEADER + lines(2, 4, 500, ra=40.0, plx=(40, 60)) + star(600, 10.0001, plx=50) + star(601, 20.0))
    second = run()
    assert second["added"] == 1 and 0 < second["regions"] < first["regions"]
    assert has_planets(spark, out) == {600, 601}
    after = files_of(out / "chunks")
    assert len({r for r, _, _ in before & after}) >= 3  # folders with files of the first batch
    assert {r["file"]: r["length"] for r in ledger(spark, str(out)).collect()} == {f: (src / f).stat().st_size for f in ("a.csv", "b.csv", "far.csv")}
    assert run() == {"added": 0, "changed": 0, "removed": 0, "batch": 2, "repaired_regions": 0, "regions": 0} and files_of(out / "chunks") == after
    assert "SKIP line=62 field=source_id" in "".join(p.read_text() for p in (out / "rejects").glob("batch=1/part-*"))

    # Files change and go, one region is emptied, planets change; and the batch fails, regions half replaced.
    (src / "b.csv").write_text(HEADER + lines(9, 50) + star(701, 20.0))
    os.utime(src / "b.csv", (1, 1))
    (src / "far.csv").unlink()
    planets.write_text(PLANETS + "x1,Far,10.0,5.0,0.5,10,,,Transit\nx2,Moved,10.0,5.0,0.5,10,,,Transit\nx3,Near,20.0,5.0,1.5,400,2,300,RV\n")
    with monkeypatch.context() as m:
        m.setattr(incremental.sinks, "write_chunks", lambda *a, **k: 1 // 0)
        with pytest.raises(ZeroDivisionError):
            run()
    assert json.loads((out / "state.json").read_text())["batch"] == 2
    pending = json.loads((out / "pending.json").read_text())
    lost = {r["region"] for r in spark.read.parquet(pending["regions"]).collect()}
    for folder in (out / "base").glob("region=*"):  # as if the replacement had been cut short
        if folder.name.removeprefix("region=") in lost:
            for p in folder.iterdir():
                p.unlink()
    done = run()
    assert (done["batch"], done["changed"], done["removed"], done["repaired_regions"]) == (3, 1, 1, len(lost))
    assert not (out / "pending.json").exists() and not (out / "work").exists()
    assert sum(r["n"] for r in ledger(spark, str(out)).collect()) == 57
    plan = of_regions(incremental._base(spark, str(out)), spark.createDataFrame([("0_0_0", 1)], "region string, n bigint"))
    assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString().lower()

    # The same by a build of all files.
    args = ["--gaia-path", str(src), "--exoplanet-path", str(planets), "--chunk-size", "40"]
    monkeypatch.setattr(cli, "_config", lambda args: CONFIG)
    assert cli.main(["build", *args, "--output-path", str(tmp / "built")], spark) == 0
    assert rows(spark, tmp / "built") == rows(spark, out)
    a, b = (json.loads((d / "manifest.json").read_text()) for d in (tmp / "built", out))
    assert a == b and a["total_planets"] == 2 and a["total_stars"] == 57
    assert compare.unequal_chunks(spark, str(tmp / "built"), str(out))[0].isEmpty() and compare.damaged_nodes(spark, str(out)).isEmpty()
    capsys.readouterr()
    assert cli.main(["verify", "--output-path", str(out), "--content"], spark) == 0
    assert cli.main(["ingest", *args, "--output-path", str(out)], spark) == 0 and "regions: 0" in capsys.readouterr().out
    name = b["chunks"][0]["file_name"]
    assert sinks.open_chunk(spark, str(out), name).count() == b["chunks"][0]["star_count"]


def test_without_planets_and_refusals(spark, inputs):
    src, planets, tmp = inputs
    (src / "b.csv").write_text(HEADER + lines(1, 9))
    ingest(spark, str(src), str(tmp / "out"), None, CONFIG)
    (src / "c.csv").write_text(HEADER + lines(2, 9, 100))
    ingest(spark, str(src), str(tmp / "out"), None, CONFIG)
    stars = build(quality.kept_stars(quality.parse_stars(read_star_csv(spark, str(src)))), None, CONFIG).stars
    columns = sorted(stars.columns)
    sinks.write_chunks(stars, str(tmp / "built/chunks"), CONFIG)
    assert rows(spark, tmp / "out")[0] == sorted(map(repr, stars.select(columns).collect()))
    for other in ((str(planets), CONFIG), (None, CatalogConfig())):
        with pytest.raises(SourceError, match="other parameters"):
            ingest(spark, str(src), str(tmp / "out"), *other)
    (src / "c.csv").unlink()
    (src / "b.csv").write_text(HEADER + star(1, 1.0, plx=-1))
    with pytest.raises(SourceError, match="no star"):
        ingest(spark, str(src), str(tmp / "new"), None, CONFIG)
    with pytest.raises(SourceError, match="wasn't ingested"):
        ingest(spark, str(src), str(tmp / "built"))


def test_a_failed_stage_is_made_again(spark, tmp_path):
    """A stage whose rewrite fails isn't taken up half-written."""
    from orrery.plans.checkpoint import staged

    make = lambda n: lambda: spark.range(n)
    folder = str(tmp_path)
    assert staged(spark, folder, "s", "one", True, make(3)).count() == 3

    def broken():
        return spark.range(10).selectExpr("if(id = 7, cast(raise_error('lost') as bigint), id) id")

    with pytest.raises(Exception, match="lost"):
        staged(spark, folder, "s", "two", True, broken)
    assert staged(spark, folder, "s", "one", True, make(4)).count() == 4  # its marker went before its table
    assert staged(spark, folder, "s", "one", True, make(5)).count() == 4


def test_equally_near_stars_go_by_id(spark, tmp_path):
    """Stars at the same place, the larger ids first in the files and in the first batch or the last: the query's manifest is SQL's."""
    import duckdb

    ids = f"(SELECT 3 * k + {360_000} * j AS id FROM range(1, 500) a(k), range(4) b(j))"
    sql = duckdb.connect()
    sql.execute(f"COPY (SELECT id AS o_orderkey, CAST(0 AS BIGINT) AS o_custkey FROM {ids} ORDER BY id DESC) TO '{tmp_path}/orders.parquet'")
    sql.execute(f"COPY (SELECT k AS p_partkey, k % 50 AS p_size FROM range(1, 500) a(k)) TO '{tmp_path}/part.parquet'")
    for t in ("orders", "part"):
        sql.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    assert_same(QUERIES["q_incremental_manifest"](spark, str(tmp_path)), ORACLE_SQL["q_incremental_manifest"], sql)
