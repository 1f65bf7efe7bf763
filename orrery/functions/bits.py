"""Floating-point numbers as integers of the same order, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the two formats: bits of the fraction, exponents of the least and the largest normal number.
FORMATS = {"float": (23, -126, 127), "double": (52, -1022, 1023)}


def ordered_bits(x: Column, kind: str) -> Column:
    """A long that orders numbers of ``kind`` (float or double) as they are, one for each: a positive number's bit pattern, a negative one's negated.

    From exponent and fraction by exact arithmetic with powers of two; both zeros are 0. Null stays null, NaN has no place and gives null.
    """
    fraction, least, largest = FORMATS[kind]
    size = F.abs(x.cast("double"))
    rough = F.floor(F.log2(size)).cast("double")  # the logarithm may be off by one next to a power of two; null for 0
    exponent = rough + F.when(F.pow(F.lit(2.0), rough) > size, -1.0).when(F.pow(F.lit(2.0), rough + 1.0) <= size, 1.0).otherwise(0.0)
    exponent = F.greatest(F.coalesce(exponent, F.lit(float(least))), F.lit(float(least)))
    scaled = size * F.pow(F.lit(2.0), -exponent) * F.lit(float(1 << fraction))
    magnitude = (exponent - float(least)).cast("bigint") * (1 << fraction) + scaled.cast("bigint")
    magnitude = F.when(F.isnan(x), None).when(size == F.lit(float("inf")), (largest - least + 2) << fraction).otherwise(magnitude)
    return F.when(x < 0, -magnitude).otherwise(magnitude)
