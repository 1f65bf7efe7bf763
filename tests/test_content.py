import json
import random

import pytest
from pyspark.sql import functions as F

from orrery.config import CatalogConfig
from orrery.operators import content
from orrery.plans import cli, compare, sinks
from orrery.plans.catalog import build
from orrery.schemas import RAW_STAR

CONFIG = CatalogConfig(chunk_size=10.0, chunks_per_partition_axis=2)


def catalog(spark, n=60):
    r = random.Random(4)
    rows = [(i, r.uniform(0, 360), r.uniform(-80, 80), r.uniform(25, 80), 0.1, r.uniform(2, 9), None if i % 4 else 0.5) for i in range(n)]
    return build(spark.createDataFrame(rows, RAW_STAR), None, CONFIG).stars


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("content") / "first")
    sinks.write_catalog(catalog(spark), path, CONFIG)
    return path


def same(df, columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_one_changed_magnitude_is_found_and_other_regions_are_not_read(spark, first, tmp_path):
    second = str(tmp_path / "second")
    changed = catalog(spark).withColumn("magnitude", F.when(F.col("source_id") == 47, F.col("magnitude") + 0.001).otherwise(F.col("magnitude")).cast("float"))
    sinks.write_catalog(changed, second, CONFIG)
    (star,) = catalog(spark).where("source_id = 47").collect()
    chunks, regions = compare.unequal_chunks(spark, first, second)
    assert same(chunks, content.KEY) == [tuple(star[c] for c in content.KEY)]
    assert regions.count() == 1
    out = compare.unequal_stars(spark, first, second)
    assert same(out, ["source_id", "kind"]) == [(47, "changed")]
    # The scan of stars opens the files of the one region.
    found = compare._stars(spark, second, chunks, regions)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
    assert 0 < files_read(found, "/chunks") < len(list((tmp_path / "second/chunks").rglob("*.parquet"))) / 4


def files_read(df, path):
    df.collect()
    node, out = df._jdf.queryExecution().executedPlan(), 0
    while node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        node = node.executedPlan()
    nodes = [node]
    while nodes:
        at = nodes.pop()
        if at.getClass().getSimpleName() == "FileSourceScanExec" and at.relation().location().rootPaths().apply(0).toString().endswith(path):
            out += at.metrics().get("numFiles").get().value()
        if at.getClass().getSimpleName().endswith("QueryStageExec"):
            nodes.append(at.plan())
        nodes += [at.children().apply(i) for i in range(at.children().size())]
    return out


def test_equal_catalogs_in_another_order(spark, first, tmp_path):
    second = str(tmp_path / "second")
    sinks.write_catalog(catalog(spark).orderBy(F.hash("source_id")).repartition(7), second, CONFIG)
    roots = [spark.read.parquet(f"{p}/nodes").where(F.col("level") == content.LEVELS + 1).select("n", "d1", "d2").collect() for p in (first, second)]
    assert roots[0] == roots[1] and len(roots[0]) == 1
    chunks, regions = compare.unequal_chunks(spark, first, second)
    assert chunks.isEmpty() and regions.isEmpty() and compare.unequal_stars(spark, first, second).isEmpty()


def test_tasks_that_compare_stars_grow_in_number_not_in_size(spark, first, tmp_path):
    second = str(tmp_path / "second")
    sinks.write_catalog(catalog(spark).withColumn("magnitude", F.col("magnitude") + 1), second, CONFIG)
    out = compare.unequal_stars(spark, first, second, most=10)  # of 60 stars a side
    assert out.rdd.getNumPartitions() == 12 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert same(out, ["source_id", "kind"]) == [(i, "changed") for i in range(60)]


def test_added_removed_moved_and_repeated_stars(spark, first, tmp_path):
    second = str(tmp_path / "second")
    stars = catalog(spark).where("source_id not in (5, 6)")
    moved = stars.withColumns({"ix": F.when(F.col("source_id") == 9, F.lit(-40)).otherwise(F.col("ix"))})
    added = stars.where("source_id = 10").withColumn("source_id", F.lit(9_000).cast("bigint"))
    again = stars.where("source_id = 11")
    sinks.write_catalog(moved.unionByName(added).unionByName(again), second, CONFIG)
    out = same(compare.unequal_stars(spark, first, second), ["source_id", "kind"])
    assert out == [(5, "removed"), (6, "removed"), (9, "added"), (9, "removed"), (11, "added"), (9_000, "added")]


def test_digests_tell_repeated_rows_apart(spark):
    stars = catalog(spark, 20)
    one, two = (content.chunk_states(s).select(*content.KEY, *content.DIGEST) for s in (stars, stars.unionByName(stars)))
    assert not set(map(tuple, one.collect())) & set(map(tuple, two.collect()))


def test_sums_do_not_overflow(spark):
    big = spark.range(1).select(*[F.lit(0).alias(k) for k in content.KEY], F.explode(F.sequence(F.lit(1), F.lit(200_000))).alias("x"))
    rows = big.groupBy(*content.KEY).agg(F.count("*").alias("n"), *content._sums([F.lit(1)]))
    assert content._digest(rows, "n").count() == 1


def test_damage_on_disk_is_found(spark, first, tmp_path, capsys):
    second = str(tmp_path / "second")
    sinks.write_catalog(catalog(spark), second, CONFIG)
    assert compare.damaged_chunks(spark, second).isEmpty() and compare.damaged_nodes(spark, second).isEmpty()
    assert cli.main(["verify", "--output-path", second, "--content"], spark) == 0
    other = catalog(spark).withColumn("color_index", F.when(F.col("source_id") == 3, F.lit(0.123)).otherwise(F.col("color_index")))
    sinks.write_chunks(other, f"{second}/chunks", CONFIG)  # counts and boxes stay
    star = catalog(spark).where("source_id = 3").first()
    assert same(compare.damaged_chunks(spark, second), content.KEY) == [tuple(star[c] for c in content.KEY)]
    assert cli.main(["verify", "--output-path", second], spark) == 0
    capsys.readouterr()
    assert cli.main(["verify", "--output-path", second, "--content"], spark) == 1
    assert f"chunk {star['ix']}_{star['iy']}_{star['iz']}: other stars than were written" in capsys.readouterr().out
    assert cli.main(["diff", "--output-path", first, "--other", second], spark) == 0  # by the trees, which say what was written
    assert "no star differs" in capsys.readouterr().out
    sinks.write_states(spark.read.parquet(f"{second}/chunks"), second, CONFIG)
    assert cli.main(["diff", "--output-path", first, "--other", second], spark) == 1
    assert f"changed: star 3 of chunk {star['ix']}_{star['iy']}_{star['iz']}" in capsys.readouterr().out
    spark.read.parquet(f"{first}/nodes").withColumn("d1", F.when(F.col("level") == 1, F.col("d1") + 1).otherwise(F.col("d1"))).write.mode("overwrite").partitionBy("level").parquet(f"{second}/nodes")
    assert compare.damaged_nodes(spark, second).select("level").distinct().count() == content.LEVELS + 1  # the changed ones, and those above the changed chunk


def test_other_layouts_are_refused(spark, first, tmp_path):
    second = str(tmp_path / "second")
    sinks.write_catalog(catalog(spark), second, CatalogConfig(chunk_size=10.0))
    with pytest.raises(Exception, match="different layouts"):
        compare.unequal_chunks(spark, first, second)
    assert json.loads((tmp_path / "second/chunks/_layout.json").read_text())["chunks_per_partition_axis"] == 8
