"""Positions, names and cells as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from orrery.functions.parsing import trimmed

#: Fixed values.
PARSEC_FROM_MAS = 1000.0  # a parallax of 1 mas is 1000 pc
MAX_DISTANCE_PC = 100_000.0
MAGNITUDE_BIN = 0.5
ARCSEC_PER_RADIAN = 3600.0 * 180.0 / math.pi

_INT_MIN, _INT_MAX = -(1 << 31), (1 << 31) - 1


def radians(degrees: Column) -> Column:
    return degrees * F.lit(math.pi) / F.lit(180.0)


def distance_pc(parallax: Column) -> Column:
    """1000 / parallax; null for a parallax of 0 instead of an error."""
    return F.try_divide(F.lit(PARSEC_FROM_MAS), parallax)


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    a, d = radians(ra), radians(dec)
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def cartesian(ra: Column, dec: Column, parallax: Column) -> tuple[Column, Column, Column]:
    """x, y, z in parsecs."""
    r = distance_pc(parallax)
    return tuple(r * u for u in unit_vector(ra, dec))


def separation_arcsec(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """The angle between two directions by the haversine formula, in arc seconds."""
    dd, da = radians(dec2) - radians(dec1), radians(ra2) - radians(ra1)
    h = F.pow(F.sin(dd / 2), 2) + F.cos(radians(dec1)) * F.cos(radians(dec2)) * F.pow(F.sin(da / 2), 2)
    return 2 * F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * F.lit(ARCSEC_PER_RADIAN)


def normal_name(name: Column) -> Column:
    """Trimmed, lower case, single blanks; the catalogue prefixes gliese and gl are written gj."""
    plain = F.regexp_replace(F.lower(trimmed(name)), r"(?U)\s+", " ")
    return F.regexp_replace(plain, "^(gliese|gl) ", "gj ")


def cell(coordinate: Column, size: float | Column) -> Column:
    """The grid cell floor(coordinate / size) as an int; beyond its range the nearest, for NaN 0."""
    size = F.lit(float(size)) if isinstance(size, (int, float)) else size
    at = F.floor(F.least(F.greatest(coordinate / size, F.lit(float(_INT_MIN))), F.lit(float(_INT_MAX))))
    return F.when(F.isnan(coordinate), 0).otherwise(at).cast("int")


def magnitude_bin(magnitude: Column) -> Column:
    return F.floor(magnitude.cast("double") / MAGNITUDE_BIN)


def chunk_file(ix: Column, iy: Column, iz: Column) -> Column:
    return F.format_string("catalog_%d_%d_%d.bin", ix, iy, iz)
