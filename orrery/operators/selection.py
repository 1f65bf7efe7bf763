"""Exact medians of groups of any size by distributed selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.bits import ordered_bits

_DIGIT = 16  # bits: a histogram has at most 65,536 rows a group


def grouped_median(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys, n, median`` of a float or double column, as Spark's ``median`` has it; null and NaN don't count, keys aren't null.

    Equal values are counted before they are shuffled, by keys and value, so a large group is spread over all tasks. Then the two
    middle ranks are narrowed down by 16 bits of the values' order at a time: a histogram by keys and digit, combined before
    its shuffle, tells in which digit each rank lies, and the next one looks only at the values there. A group's rows that meet in one task are those of
    a histogram, whatever the group's size. Two rounds for floats, four for doubles; all in one lazy plan, in which the counts are shuffled once.
    """
    kind = rows.schema[value].dataType
    name = kind.simpleString()
    rounds = {"float": 2, "double": 4}[name]
    counts = rows.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    counts = counts.withColumn("_bits", ordered_bits(F.col("_v"), name))
    targets = None
    for i in range(1, rounds + 1):
        digits = F.shiftright("_bits", _DIGIT * (rounds - i))  # with those of the rounds before
        if targets is None:
            found = counts.groupBy(*keys, digits.alias("_digits")).agg(F.sum("_c").alias("_c"), F.min("_v").alias("_v"))
            group = Window.partitionBy(*keys)
            total = F.sum("_c").over(group)
            ranks = F.array(*[F.struct(F.lit(j).alias("_which"), F.floor((total - 1 + j) / 2).alias("_k"), total.alias("_n")) for j in (0, 1)])
            found = found.withColumns({"_upto": F.sum("_c").over(group.orderBy("_digits")), "_ranks": ranks}).select("*", F.explode("_ranks").alias("_r")).select(*keys, "_digits", "_c", "_v", "_upto", "_r.*")
        else:
            inside = counts.withColumn("_prefix", F.shiftright("_bits", _DIGIT * (rounds - i + 1))).join(targets.drop("_v"), [*keys, "_prefix"])
            found = inside.groupBy(*keys, "_which", "_k", "_n", digits.alias("_digits")).agg(F.sum("_c").alias("_c"), F.min("_v").alias("_v"))
            found = found.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*keys, "_which").orderBy("_digits")))
        hit = found.where((F.col("_k") < F.col("_upto")) & (F.col("_k") >= F.col("_upto") - F.col("_c")))
        targets = hit.select(*keys, "_which", F.col("_digits").alias("_prefix"), (F.col("_k") - (F.col("_upto") - F.col("_c"))).alias("_k"), "_n", "_v")
    middle = [F.max(F.when(F.col("_which") == j, F.col("_v").cast("double"))) for j in (0, 1)]
    return targets.groupBy(*keys).agg(F.max("_n").alias("n"), (0.5 * middle[0] + 0.5 * middle[1]).cast(kind).alias("median"))
