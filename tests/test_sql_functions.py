import math

import pytest
from pyspark.sql import functions as F

from orrery.config import CatalogConfig
from orrery.functions.astro import cell, distance_pc, normal_name, separation_arcsec
from orrery.operators import chunks
from orrery.plans.catalog import build
from orrery.plans.sql_functions import register
from orrery.schemas import RAW_STAR


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [(i, (i * 37) % 360 + 0.5, (i * 11) % 170 - 84.5, 10.0 + i % 40, 0.1, 5.0, 0.7) for i in range(200)]
    made = build(spark.createDataFrame(rows, RAW_STAR), None, CatalogConfig(chunk_size=20.0))
    register(made, spark, "made")
    return made


def test_values_equal_the_columns(spark, catalog):
    names = spark.createDataFrame([(" HD  209458 ",), ("Gliese 876",), ("GL 876",), ("GJ 876",), ("glad 1",), ("a \tb",), ("",), (None,)], "n string")
    assert [tuple(r) for r in names.select(F.expr("host_name(n)"), normal_name(F.col("n"))).collect() if r[0] != r[1]] == []
    numbers = spark.createDataFrame([(0.0, -7.5, 3.0), (359.9, 89.0, -0.5), (12.0, -90.0, 1e3)], "a double, b double, c double")
    pairs = [
        ("distance_pc(c)", distance_pc(F.col("c"))),
        ("distance_pc(0D)", distance_pc(F.lit(0.0))),
        ("cell_of(b, 2.5D)", cell(F.col("b"), 2.5)),
        ("round(angle_between(a, b, 10D, 20D), 6)", F.round(separation_arcsec(F.col("a"), F.col("b"), F.lit(10.0), F.lit(20.0)), 6)),
    ]
    for text, column in pairs:
        assert all(r[0] == r[1] for r in numbers.select(F.expr(text), column).collect()), text


def test_tables_equal_the_operators(spark, catalog):
    manifest, columns = catalog.manifest, ["ix", "iy", "iz", "star_count"]
    one = manifest.first()
    got = spark.sql(f"SELECT * FROM chunk_by_id({one['ix']}, {one['iy']}, {one['iz']})").collect()
    assert [tuple(r) for r in got] == [tuple(one[c] for c in columns)]
    for radius in (-1.0, 0.0, 30.0, 1e4):
        got = spark.sql(f"SELECT * FROM chunks_in_radius(5D, -6D, 7D, CAST({radius} AS DOUBLE))").collect()
        wanted = chunks.chunks_in_radius(manifest, (5.0, -6.0, 7.0), radius).select(*columns).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, wanted))
    stars = {r["source_id"]: r for r in catalog.stars.collect()}
    near = {r["source_id"]: r["distance"] for r in spark.sql("SELECT * FROM stars_in_radius(5D, -6D, 7D, 30D)").collect()}
    far = {i: math.dist((s["x"], s["y"], s["z"]), (5, -6, 7)) for i, s in stars.items()}
    assert near == pytest.approx({i: d for i, d in far.items() if d <= 30}) and near
    cone = spark.sql("SELECT source_id FROM cone_search(37.5D, -73.5D, 3600D * 40) ORDER BY angle_arcsec, source_id").collect()
    assert cone[0]["source_id"] == 1 and 1 < len(cone) < 100


def test_functions_compose_with_other_sql(spark, catalog):
    out = spark.sql("SELECT ix, count(*) n FROM stars_in_radius(0D, 0D, 0D, 50D) JOIN made_stars USING (source_id) GROUP BY ix")
    assert sum(r["n"] for r in out.collect()) == spark.sql("SELECT * FROM stars_in_radius(0D, 0D, 0D, 50D)").count() > 0
