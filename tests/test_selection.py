import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from orrery.config import CatalogConfig
from orrery.functions.bits import ordered_bits
from orrery.operators.impute import bin_medians
from orrery.operators.selection import grouped_median

ODD = [0.0, -0.0, 1.0, -1.0, 2.0, 0.5, 1e-45, -1e-45, 1.1754943508222875e-38, 3.4028234663852886e38, math.inf, -math.inf, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 0.1, 8.0, 7.999999999999999, 4.000000000000001]


def pattern(x, kind):
    size = struct.unpack(">q", b"\0" * 4 + struct.pack(">f", abs(x)))[0] if kind == "float" else struct.unpack(">q", struct.pack(">d", abs(x)))[0]
    return -size if x < 0 else size


@pytest.mark.parametrize("kind", ["float", "double"])
def test_order_is_that_of_the_bits(spark, kind):
    r = random.Random(1)
    values = [x for x in ODD if kind == "double" or abs(x) <= 3.5e38 or math.isinf(x)] + [2.0**k for k in range(-140, 128)] + [math.nextafter(2.0**k, 0) for k in range(-100, 100)]
    values += [r.uniform(-5, 5) for _ in range(500)] + [r.uniform(-1, 1) * 10.0 ** r.randint(-35, 35) for _ in range(500)]
    if kind == "float":
        values = [struct.unpack(">f", struct.pack(">f", x))[0] for x in values]
    rows = spark.createDataFrame([(x,) for x in values], f"x {kind}").select("x", ordered_bits(F.col("x"), kind).alias("b")).collect()
    assert [r["b"] for r in rows] == [pattern(x, kind) for x in values]
    none = spark.createDataFrame([(None,), (math.nan,)], f"x {kind}").select(ordered_bits(F.col("x"), kind).alias("b"))
    assert [r["b"] for r in none.collect()] == [None, None]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_equals_the_aggregate(spark, kind):
    r = random.Random(2)
    rows = [(k, r.choice([r.uniform(-1, 4), round(r.uniform(0, 1), 1), r.uniform(0, 1) * 10.0 ** r.randint(-30, 30), None, math.nan])) for k in range(60) for _ in range(k)]
    rows += [(100, x) for x in (1.5, 1.5)] + [(101, math.inf), (101, -math.inf), (101, 3.0)] + [(102, None)] + [(103, 0.1 + i * 1e-7) for i in range(1001)]
    df = spark.createDataFrame(rows, f"k long, v {kind}").repartition(5)
    real = df.where("v is not null and not isnan(v)").groupBy("k").agg(F.count("*").alias("n"), F.median("v").cast(kind).alias("median"))
    assert sorted(map(repr, grouped_median(df, ["k"], "v").collect())) == sorted(map(repr, real.collect()))


def test_empty_table(spark):
    assert grouped_median(spark.createDataFrame([], "k int, v float"), ["k"], "v").collect() == []


def test_all_stars_in_one_cell_and_bin(spark):
    """One group has all stars; no task gets more rows of it than a histogram has."""
    stars = spark.range(300_000).select(F.lit(1.0).alias("x"), F.lit(1.0).alias("y"), F.lit(1.0).alias("z"), F.lit(5.1).cast("float").alias("magnitude"), (F.rand(3) * 4 - 1).cast("float").alias("bp_rp")).persist()
    config = CatalogConfig()
    got = bin_medians(stars, config, by_selection=True)
    (row,), (wanted,) = got.collect(), bin_medians(stars, config).collect()
    assert tuple(row) == tuple(wanted) and row["n"] == 300_000
    plan = got._jdf.queryExecution().executedPlan().toString().lower()
    assert "percentile" not in plan and "median(" not in plan
    bits = ordered_bits(F.col("bp_rp"), "float")
    assert stars.groupBy(F.shiftright(bits, 16)).count().count() <= 65_536
    stars.unpersist()
