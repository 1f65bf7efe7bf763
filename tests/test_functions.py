import math

import pytest
from pyspark.sql import functions as F

from orrery.functions import astro, inference, parsing


def one(spark, **columns):
    """A row of expressions, evaluated."""
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize(
    ("text", "wanted"),
    [("5.", 5.0), (".5", 0.5), ("+1e3", 1000.0), (" 2 ", 2.0), ("-inf", -math.inf), ("Infinity", math.inf), ("1.0d", None), ("0x1p3", None), ("1_0", None), ("1e", None), ("", None), ("x", None)],
)
def test_parse_real(spark, text, wanted):
    assert one(spark, v=parsing.parse_real(F.lit(text)))["v"] == wanted


def test_parse_nan_and_ids(spark):
    r = one(spark, nan=parsing.parse_real(F.lit("NaN")), ok=parsing.parse_id(F.lit("+12")), neg=parsing.parse_id(F.lit("-3")), real=parsing.parse_id(F.lit("5.0")), big=parsing.parse_id(F.lit("9" * 20)))
    assert math.isnan(r["nan"])
    assert (r["ok"], r["neg"], r["real"], r["big"]) == (12, None, None, None)


@pytest.mark.parametrize(
    ("ra", "dec", "plx", "distance", "tolerance"),
    [(219.8996, -60.8335, 747.10, 1.338, 0.05), (101.2872, -16.7161, 379.21, 2.637, 0.05), (279.2347, 38.7837, 130.23, 7.680, 0.1), (88.7929, 7.4071, 4.51, 221.7, 5), (269.4521, 4.6933, 546.98, 1.828, 0.05)],
)
def test_known_stars(spark, ra, dec, plx, distance, tolerance):
    r = one(spark, **dict(zip("xyz", astro.cartesian(F.lit(ra), F.lit(dec), F.lit(plx)), strict=True)))
    assert math.sqrt(sum(v * v for v in r)) == pytest.approx(distance, abs=tolerance)


def test_axes(spark):
    x = one(spark, **dict(zip("xyz", astro.cartesian(F.lit(0.0), F.lit(0.0), F.lit(1000.0)), strict=True)))
    pole = one(spark, **dict(zip("xyz", astro.cartesian(F.lit(0.0), F.lit(90.0), F.lit(1000.0)), strict=True)))
    assert tuple(x) == pytest.approx((1, 0, 0), abs=1e-10)
    assert tuple(pole) == pytest.approx((0, 0, 1), abs=1e-10)


@pytest.mark.parametrize(
    ("name", "wanted"),
    [("51 Peg", "51 peg"), ("Gliese 876", "gj 876"), ("GL 876", "gj 876"), ("GJ 876", "gj 876"), ("HD  209458", "hd 209458"), ("  WASP-39 ", "wasp-39"), ("Kepler-452", "kepler-452"), (" GL 581", "gj 581")],
)
def test_names(spark, name, wanted):
    once = astro.normal_name(F.lit(name))
    assert tuple(one(spark, a=once, b=astro.normal_name(once))) == (wanted, wanted)


def test_separation(spark):
    sep = lambda *p: astro.separation_arcsec(*map(F.lit, p))
    r = one(spark, same=sep(10.0, 20.0, 10.0, 20.0), second=sep(0.0, 0.0, 0.0, 1 / 3600), a=sep(10.0, 20.0, 30.0, -40.0), b=sep(30.0, -40.0, 10.0, 20.0), wrap=sep(359.9999, 0.0, 0.0001, 0.0))
    assert r["same"] < 1e-9
    assert r["second"] == pytest.approx(1, abs=1e-3)
    assert r["a"] == pytest.approx(r["b"], abs=1e-10)
    assert r["wrap"] == pytest.approx(0.72, abs=1e-6)


@pytest.mark.parametrize(("x", "wanted"), [(75.0, 1), (-25.0, -1), (50.0, 1), (0.0, 0), (-1.0, -1), (1e300, (1 << 31) - 1), (-1e300, -(1 << 31)), (math.nan, 0)])
def test_cells(spark, x, wanted):
    assert one(spark, c=astro.cell(F.lit(x), 50.0))["c"] == wanted


@pytest.mark.parametrize(("period", "wanted"), [(5.0, 1.5), (10.0, 2.5), (50.0, 2.5), (500.0, 5.0), (5000.0, 10.0), (math.nan, 10.0)])
def test_radius(spark, period, wanted):
    r = one(spark, guess=inference.radius(F.lit(None).cast("float"), F.lit(period)), seen=inference.radius(F.lit(2.5), F.lit(period)))
    assert tuple(r) == (wanted, 2.5)


def test_temperatures(spark):
    none = F.lit(None).cast("float")
    t = lambda obs, color, a: inference.temperature(obs, F.lit(color) if color is not None else none, F.lit(a))
    r = one(
        spark, solar=inference.effective_temperature(F.lit(0.82)), low=inference.effective_temperature(F.lit(-1.0)), high=inference.effective_temperature(F.lit(5.0)), unknown=inference.effective_temperature(none),
        earth=t(none, 0.82, 1.0), hot=t(none, 0.82, 0.05), seen=t(F.lit(500.0), None, 1.0), colorless=t(none, None, 1.0), zero=t(none, 0.82, 0.0), negative=t(none, 0.82, -1.0), far=t(none, 0.82, math.inf), nan=t(none, math.nan, 1.0),
    )
    assert r["solar"] == pytest.approx(7372.58, abs=0.01)
    assert (r["low"], r["high"], r["unknown"]) == (8022, 5717, None)
    assert r["earth"] == pytest.approx(325.17, abs=0.01)
    assert r["hot"] == pytest.approx(1454.19, abs=0.01)
    assert r["seen"] == 500
    assert [r[c] for c in ("colorless", "zero", "negative", "far", "nan")] == [None] * 5
