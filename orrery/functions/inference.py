"""Estimates for missing values, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orrery.schemas import INFERRED, OBSERVED

#: The colour of a star without any estimate; planet radii in Earth radii by orbital period in
#: days; the polynomial in the colour for a star's temperature and its range; a solar radius in AU and the
#: albedo factor 0.7 = 1 - 0.3 for a planet's temperature.
FALLBACK_COLOR = 0.82
RADIUS_BY_PERIOD = ((10.0, 1.5), (100.0, 2.5), (1000.0, 5.0))
RADIUS_BEYOND = 10.0
TEFF = (9245.0, -2700.0, 508.0)
TEFF_COLORS = (0.5, 3.0)
SOLAR_RADIUS_AU = 0.00465
ABSORBED = 0.7


def estimated_radius(period_days: Column) -> Column:
    """By the first period limit above; NaN and longer periods get the largest."""
    out = None
    for limit, radius in RADIUS_BY_PERIOD:
        hit = period_days < limit
        out = F.when(hit, radius) if out is None else out.when(hit, radius)
    return out.otherwise(RADIUS_BEYOND)


def radius(observed: Column, period_days: Column) -> Column:
    return F.coalesce(observed.cast("double"), estimated_radius(period_days))


def effective_temperature(color: Column) -> Column:
    """In kelvin; the colour is held within its range, null and NaN stay."""
    x = color.cast("double")
    x = F.when(x.isNull() | F.isnan(x), x).otherwise(F.greatest(F.lit(TEFF_COLORS[0]), F.least(x, F.lit(TEFF_COLORS[1]))))
    return F.lit(TEFF[0]) + x * TEFF[1] + x * x * TEFF[2]


def estimated_temperature(color: Column, semi_major_au: Column) -> Column:
    """Equilibrium temperature of a planet; null unless it is finite and positive."""
    a = semi_major_au.cast("double")
    t = F.when((a > 0) & ~F.isnan(a), effective_temperature(color) * F.sqrt(F.lit(SOLAR_RADIUS_AU) / (a * 2)) * F.lit(ABSORBED**0.25))
    return F.when(~F.isnan(t) & (t > 0) & (t < F.lit(float("inf"))), t)


def temperature(observed: Column, color: Column, semi_major_au: Column) -> Column:
    return F.coalesce(observed.cast("double"), estimated_temperature(color, semi_major_au))


def tag(observed: Column) -> Column:
    return F.when(observed.isNotNull(), OBSERVED).otherwise(INFERRED)
