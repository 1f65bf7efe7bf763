"""Cross-match of planet hosts to stars, by name and then by nearest position."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.config import CatalogConfig
from orrery.functions.astro import ARCSEC_PER_RADIAN, normal_name, separation_arcsec, unit_vector

_PLANET = ["planet_name", "semi_major_au", "period_days", "radius_earth", "eq_temp_kelvin"]


def fits(rows: DataFrame, n: int) -> bool:
    """Whether there are at most ``n`` rows; stops counting beyond."""
    return rows.limit(n + 1).count() <= n


def group_hosts(planets: DataFrame) -> DataFrame:
    """``host, n_planets, ra, dec_deg``: one row a normalised host name, at its first planet's position."""
    first = F.min_by(F.struct("ra", "dec_deg"), "row_ord")
    return planets.groupBy(normal_name(F.col("hostname")).alias("host")).agg(F.count("*").alias("n_planets"), first.alias("p")).select("host", "n_planets", "p.ra", "p.dec_deg")


def _order(stars: DataFrame) -> str:
    return "star_ord" if "star_ord" in stars.columns else "source_id"


def match_names(hosts: DataFrame, stars: DataFrame) -> DataFrame:
    """``host, source_id`` by the optional column ``designation`` of the stars, the earliest star if several."""
    if "designation" not in stars.columns:
        return hosts.select("host", F.lit(None).cast("bigint").alias("source_id")).limit(0)
    named = stars.where("designation is not null").select(normal_name(F.col("designation")).alias("host"), F.struct(F.col(_order(stars)).alias("ord"), F.col("source_id").alias("id")).alias("s"))
    return hosts.select("host").join(named, "host").groupBy("host").agg(F.min("s")["id"].alias("source_id"))


#: The cell of a grid of unit vectors.
AXES = ["gx", "gy", "gz"]
#: In dense cells the radius of the search grows by this factor, in so many steps.
FINER, STEPS = 8, 3


def cells_of_a_host(config: CatalogConfig) -> int:
    """At most so many cells of the grid meet the cube around a host's circle."""
    chord, width = _grid(config.proximity_arcsec)
    return (int(2 * chord / width) + 2) ** 3


def _grid(radius: float, least: float = 1e-4) -> tuple[float, float]:
    """The chord of a radius in arc seconds and the width of a cell."""
    chord = 2 * math.sin(min(radius / ARCSEC_PER_RADIAN, math.pi) / 2) * 1.0001 + 1e-12
    return chord, max(chord, least)


def _in_cells(stars: DataFrame, width: float) -> DataFrame:
    return stars.withColumns({g: F.floor(u / width) for u, g in zip(unit_vector(F.col("ra"), F.col("dec_deg")), AXES, strict=True)})


def _around(hosts: DataFrame, chord: float, width: float, done: Column | None = None) -> DataFrame:
    """``hosts (h_ra, h_dec)`` in each cell that the cube around their circle meets; those ``done`` in one row without a cell."""
    for u, g in zip(unit_vector(F.col("h_ra"), F.col("h_dec")), AXES, strict=True):
        met = F.sequence(F.floor((u - chord) / width), F.floor((u + chord) / width))
        hosts = hosts.withColumn(g, F.explode(met if done is None else F.when(done, F.array(F.lit(None).cast("bigint"))).otherwise(met)))
    return hosts


def _within(radius: float) -> Column:
    return (F.col("sep") < radius) & ~F.isnan("sep")


def match_nearest(hosts: DataFrame, stars: DataFrame, config: CatalogConfig = CatalogConfig(), few: bool | None = None) -> DataFrame:
    """``host, source_id, sep_arcsec``: the nearest star within the radius (strictly), ties to the earliest."""
    return nearest(hosts, stars, config, few).select("host", F.col("m.source_id").alias("source_id"), F.col("m.sep").alias("sep_arcsec"))


#: Which of equally near stars a host takes: the earliest, or the one with the least id.
EARLIEST, LEAST_ID = ("ord", "source_id"), ("source_id", "ord")


def nearest(hosts: DataFrame, stars: DataFrame, config: CatalogConfig = CatalogConfig(), few: bool | None = None, ties: tuple[str, str] = EARLIEST) -> DataFrame:
    """``host, m``: separation, then by ``ties`` order and id of the nearest star within the radius. The least ``m`` of two sets of stars is that of both.

    Both sides are put on a grid of unit vectors whose cells are at least as wide as the radius's chord; a host goes to the
    cells that the cube around its circle meets, mostly one: an equi-join on the cell. Unit vectors have
    no wrap at 0 degrees and no special poles. Hosts are broadcast if their cells are ``config.broadcast_hosts`` at most;
    ``few`` says whether that holds if the caller knows it already (see ``cells_of_a_host``). Beyond it both sides shuffle, and
    cells with more than ``config.dense_cell`` stars, such as a cluster that is narrower than a cell, are searched by growing radii, see ``_nearest_of_many``.
    """
    chord, width = _grid(config.proximity_arcsec)
    around = _around(hosts.select("host", F.col("ra").alias("h_ra"), F.col("dec_deg").alias("h_dec")), chord, width)
    placed = _in_cells(stars.select("source_id", F.col(_order(stars)).alias("ord"), "ra", "dec_deg"), width)
    sep = separation_arcsec(F.col("h_ra"), F.col("h_dec"), F.col("ra"), F.col("dec_deg"))
    best = lambda pairs: pairs.withColumn("sep", sep).where(_within(config.proximity_arcsec)).groupBy("host").agg(F.min(F.struct("sep", *ties)).alias("m"))
    if fits(around, config.broadcast_hosts) if few is None else few:
        return best(placed.join(F.broadcast(around), AXES))
    dense = F.broadcast(_dense(placed, AXES, config.dense_cell).select(*AXES))
    near = best(placed.join(dense, AXES, "left_anti").join(around.hint("merge"), AXES))
    left = around.join(dense, AXES, "left_semi").select("host", "h_ra", "h_dec").distinct().withColumn("m", F.lit(None).cast(near.schema["m"].dataType))
    of_many = _nearest_of_many(left, placed.join(dense, AXES, "left_semi"), config, ties).where("m is not null")
    return near.unionByName(of_many.select("host", "m")).groupBy("host").agg(F.min("m").alias("m"))


def _nearest_of_many(hosts: DataFrame, stars: DataFrame, config: CatalogConfig, ties: tuple[str, str]) -> DataFrame:
    """``host, m`` over the stars of dense cells.

    Of stars at one position only the first by ``ties`` can be the nearest. A small radius is searched first, on a grid as fine;
    who has a star within it has its nearest one, and only the others are searched with the next larger radius. So what a host is compared with doesn't
    grow with the density of its field. What is denser than the finest grid is dealt to parts.
    """
    stars = stars.groupBy("ra", "dec_deg").agg(F.min(F.struct(*ties)).alias("star")).select("ra", "dec_deg", "star.*")
    for step in range(STEPS, -1, -1):
        radius, found = config.proximity_arcsec / FINER**step, F.col("m").isNotNull()
        chord, _ = _grid(radius)
        around, placed = split_dense(_around(hosts, chord, 2 * chord, found), _in_cells(stars, 2 * chord), AXES, config.dense_cell)
        around = around.withColumn("part", F.when(found, -1 - F.pmod(F.xxhash64("host"), F.lit(1 << 31))).otherwise(F.col("part")))  # spread, as they meet no star
        pairs = around.join(placed.hint("merge"), [*AXES, "part"], "left")
        pairs = pairs.withColumn("sep", separation_arcsec(F.col("h_ra"), F.col("h_dec"), F.col("ra"), F.col("dec_deg")))
        hosts = pairs.groupBy("host", "h_ra", "h_dec").agg(F.min(F.coalesce("m", F.when(_within(radius), F.struct("sep", *ties)))).alias("m"))
    return hosts


def _dense(placed: DataFrame, axes: list[str], most: int) -> DataFrame:
    """``n``, the stars of the cells that have more than ``most``: at most one cell for ``most`` stars."""
    return placed.groupBy(*axes).agg(F.count("*").alias("n")).where(F.col("n") > most)


def split_dense(around: DataFrame, placed: DataFrame, axes: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``part``: the stars of a cell that has more than ``most`` are dealt to parts of about so many, and each host goes to all parts of its cells.

    The nearest star of a cell is the nearest of its parts' nearest. Dense cells are at most one for ``most`` stars, which bounds what is broadcast.
    """
    dense = _dense(placed, axes, most).select(*axes, F.ceil(F.col("n") / most).alias("parts"))
    dealt = F.pmod(F.xxhash64("source_id", "ra", "dec_deg"), F.col("parts"))
    placed = placed.join(F.broadcast(dense), axes, "left").withColumn("part", F.coalesce(dealt, F.lit(0))).drop("parts")
    around = around.join(F.broadcast(dense), axes, "left")
    return around.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)) - 1))).drop("parts"), placed


def match_hosts(hosts: DataFrame, stars: DataFrame, config: CatalogConfig = CatalogConfig(), few: bool | None = None) -> DataFrame:
    """``host, source_id, match_pass`` (1 name, 2 position) of all matched hosts."""
    if "designation" not in stars.columns:
        return match_nearest(hosts, stars, config, few).select("host", "source_id", F.lit(2).alias("match_pass"))
    named = match_names(hosts, stars)
    left = hosts.join(named, "host", "left_anti")
    near = match_nearest(left, stars, config, few)
    return named.select("host", "source_id", F.lit(1).alias("match_pass")).unionByName(near.select("host", "source_id", F.lit(2).alias("match_pass")))


def unmatched_hosts(hosts: DataFrame, matches: DataFrame) -> DataFrame:
    return hosts.join(matches, "host", "left_anti").select("host")


def match_statistics(hosts: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: hosts, planets, matches by pass, unmatched hosts and the matched share (0 without hosts)."""
    all_hosts = hosts.agg(F.count("*").alias("total_hosts"), F.coalesce(F.sum("n_planets"), F.lit(0)).alias("total_planets"))
    by_pass = matches.agg(F.count_if(F.col("match_pass") == 1).alias("matched_pass1"), F.count_if(F.col("match_pass") == 2).alias("matched_pass2"))
    matched = F.col("matched_pass1") + F.col("matched_pass2")
    joined = all_hosts.join(F.broadcast(by_pass), F.lit(True))  # one row each
    return joined.select("*", (F.col("total_hosts") - matched).alias("unmatched"), F.coalesce(F.try_divide(matched, F.col("total_hosts")), F.lit(0.0)).alias("match_rate"))


def attach_planets(stars: DataFrame, planets: DataFrame, matches: DataFrame, config: CatalogConfig = CatalogConfig(), few: bool | None = None) -> DataFrame:
    """Stars with ``planets``, ordered by host and row; an empty array without any. A star may have several hosts.

    Up to ``config.broadcast_hosts`` planets are broadcast, so that the stars don't shuffle; beyond it both sides do.
    """
    return attach_lists(stars, planet_lists(planets, matches), fits(planets, config.broadcast_hosts) if few is None else few)


def planet_lists(planets: DataFrame, matches: DataFrame) -> DataFrame:
    """``source_id, planets`` of the matched stars, planets ordered by host and row."""
    rows = planets.withColumn("host", normal_name(F.col("hostname"))).join(matches.select("host", "source_id"), "host")
    lists = rows.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("host", "row_ord", *_PLANET))).alias("p"))
    return lists.select("source_id", F.transform("p", lambda x: F.struct(*[x[c].alias(c) for c in _PLANET])).alias("planets"))


def attach_lists(stars: DataFrame, lists: DataFrame, few: bool) -> DataFrame:
    """Stars with the ``planets`` of ``lists``, which are broadcast if they are ``few``."""
    planet_type = lists.schema["planets"].dataType
    out = stars.join(F.broadcast(lists) if few else lists, "source_id", "left")
    return out.withColumn("planets", F.coalesce("planets", F.array().cast(planet_type)))
