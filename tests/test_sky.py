import math
import random

import pytest
from pyspark.sql import functions as F

from orrery.functions.morton import BITS, cube_ranges, morton_key
from orrery.plans.sky import nearest_stars, stars_in_radius, write_sky
from orrery.sources.csv_files import SourceError


def key(x, y, z, unit):
    half = 1 << (BITS - 1)
    cells = [min(max(math.floor(c / unit), -half), half - 1) + half for c in (x, y, z)]
    return sum(((c >> b) & 1) << (3 * b + i) for i, c in enumerate(cells) for b in range(BITS))


def test_keys_interleave_bits(spark):
    r = random.Random(1)
    rows = [(0.0, 0.0, 0.0), (-0.05, 0.05, 1e9), (-1e9, 12.3, -45.6), (104857.5, -104857.6, 0.1)] + [tuple(r.uniform(-1e5, 1e5) for _ in range(3)) for _ in range(300)]
    df = spark.createDataFrame(rows, "x double, y double, z double").select("x", "y", "z", morton_key(F.col("x"), F.col("y"), F.col("z"), 0.1).alias("k"))
    got = df.collect()
    assert [g["k"] for g in got] == [key(*x, 0.1) for x in rows] and all(g["k"] >= 0 for g in got)


@pytest.mark.parametrize("most", [1, 8, 64, 500])
def test_ranges_hold_the_cube_and_not_much_else(most):
    r = random.Random(most)
    for _ in range(30):
        center, radius = [r.uniform(-300, 300) for _ in range(3)], r.choice([0.0, 0.3, 10.0, 250.0])
        ranges = cube_ranges(center, radius, 0.1, most)
        assert len(ranges) <= most + 8 and all(a <= b for a, b in ranges) and all(b + 1 < c for (_, b), (c, _) in zip(ranges, ranges[1:], strict=False))
        for _ in range(40):
            p = [c + r.uniform(-radius, radius) for c in center]
            assert any(a <= key(*p, 0.1) <= b for a, b in ranges)
    assert cube_ranges((0, 0, 0), -1, 0.1) == cube_ranges((0, 0, 0), math.nan, 0.1) == []
    cells = (2 * 100 + 1) ** 3
    assert sum(b - a + 1 for a, b in cube_ranges((3.0, 4.0, 5.0), 10, 0.1, 4_000)) < 1.5 * cells


def galaxy(spark):
    """Half of all stars in one small field."""
    n = 60_000
    wide = spark.range(n).select("id", *[(F.randn(i) * 120).alias(c) for i, c in enumerate("xyz")])
    field = spark.range(n, 2 * n).select("id", (50 + F.randn(7)).alias("x"), (-20 + F.randn(8)).alias("y"), F.randn(9).alias("z"))
    return wide.unionByName(field).withColumnRenamed("id", "source_id")


@pytest.fixture(scope="module")
def sky(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sky") / "sky")
    write_sky(galaxy(spark), path, files=8, group_rows=1_000)
    return path, galaxy(spark).persist()


def scanned(df):
    """Rows that the scan gave after skipping."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        node = node.executedPlan()
    leaf = node.collectLeaves().apply(0)
    return leaf.metrics().get("numOutputRows").get().value()


@pytest.mark.parametrize(("center", "radius"), [((0, 0, 0), 15.0), ((50, -20, 0), 0.5), ((200, 100, -50), 40.0), ((-3.3, 7.7, 0.1), 0.0), ((0, 0, 0), 1e4)])
def test_equals_a_full_scan(spark, sky, center, radius):
    path, stars = sky
    far = sum(((F.col(c) - v) * (F.col(c) - v) for c, v in zip("xyz", center, strict=True)), F.lit(0.0))
    wanted = sorted(r["source_id"] for r in stars.where(F.sqrt(far) <= radius).collect())
    out = stars_in_radius(spark, path, center, radius)
    assert out.columns == ["source_id", "x", "y", "z", "distance"]
    assert sorted(r["source_id"] for r in out.collect()) == wanted


def test_few_row_groups_are_read(spark, sky):
    path, stars = sky
    # Around a corner of the largest octants, within the dense field, and away from all: in row groups of 1,000 of 120,000 stars.
    for center, radius, share in (((0, 0, 0), 15.0, 0.1), ((50, -20, 0), 0.5, 0.2), ((300, 300, 300), 20.0, 0.02)):
        assert scanned(stars_in_radius(spark, path, center, radius)) <= share * stars.count()
    plan = stars_in_radius(spark, path, (0, 0, 0), 15.0)._jdf.queryExecution().executedPlan().toString()
    assert "(And(GreaterThanOrEqual(morton," in plan  # among the pushed filters


def test_files_have_like_numbers_of_stars(spark, sky):
    path, stars = sky
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * stars.count() / 8


def test_nearest(spark, sky):
    path, stars = sky
    center = (50.2, -20.1, 0.3)
    far = F.sqrt(sum(((F.col(c) - v) * (F.col(c) - v) for c, v in zip("xyz", center, strict=True)), F.lit(0.0)))
    wanted = [r["source_id"] for r in stars.orderBy(far, "source_id").limit(20).collect()]
    assert [r["source_id"] for r in nearest_stars(spark, path, center, 20).collect()] == wanted
    assert nearest_stars(spark, path, center, 200_000).count() == 120_000


def test_odd_inputs(spark, tmp_path):
    rows = [(1, 1.0, 1.0, 1.0), (2, math.nan, 1.0, 1.0), (3, None, 1.0, 1.0), (4, 1e9, 0.0, 0.0), (5, 1.0, 1.0, 1.0)]
    write_sky(spark.createDataFrame(rows, "source_id long, x double, y double, z double"), str(tmp_path / "s"))
    near = lambda c, r: sorted(x["source_id"] for x in stars_in_radius(spark, str(tmp_path / "s"), c, r).collect())
    assert near((1, 1, 1), 0.0) == [1, 5] and near((1e9, 0, 0), 5.0) == [4] and near((0, 0, 0), -1.0) == [] and near((0, 0, 0), 1e10) == [1, 4, 5]
    write_sky(spark.createDataFrame([], "source_id long, x double, y double, z double"), str(tmp_path / "e"))
    assert stars_in_radius(spark, str(tmp_path / "e"), (0, 0, 0), 1.0).count() == 0
    with pytest.raises(SourceError):
        stars_in_radius(spark, str(tmp_path / "none"), (0, 0, 0), 1.0)
