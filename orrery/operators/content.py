"""What chunks hold, as digests in a tree over regions, and what two catalogs differ in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.operators.chunks import KEY, metadata_aggregates, with_file_names

DIGEST = ["d1", "d2"]
#: Levels of inner nodes above regions, but for the root.
LEVELS = 3
_LOW = 0xFFFFFFFF
_PLACE = ["rx", "ry", "rz", "region"]  # follow from the chunk


def content_columns(catalog: DataFrame) -> list[str]:
    """Everything that a star's row says, in an order of its own."""
    return sorted(c for c in catalog.columns if c not in _PLACE)


def _sums(hashed: list[Column]) -> list[Column]:
    """Sums of two hashes by halves: the same for any order of rows, told apart by repeated rows, and never too large for a long."""
    out = []
    for i, salt in enumerate(("", "second")):
        h = F.xxhash64(F.lit(salt), *hashed)
        out += [F.sum(F.shiftrightunsigned(h, 32)).alias(f"_h{i}"), F.sum(h.bitwiseAND(F.lit(_LOW))).alias(f"_l{i}")]
    return out


def _digest(rows: DataFrame, count: str) -> DataFrame:
    """The sums as two hashes, with the count."""
    sums = [f"_{half}{i}" for i in (0, 1) for half in "hl"]
    return rows.withColumns({d: F.xxhash64(F.lit(d), count, *sums) for d in DIGEST}).drop(*sums)


def chunk_states(catalog: DataFrame) -> DataFrame:
    """The columns of ``chunk_metadata`` with ``d1, d2``, a digest of the chunk's stars whatever their order; one aggregation."""
    rows = catalog.groupBy(*KEY).agg(*metadata_aggregates(), *_sums([F.col(c) for c in content_columns(catalog)]))
    return with_file_names(_digest(rows, "star_count"))


def nodes(leaves: DataFrame, axis: int) -> DataFrame:
    """``level, ix, iy, iz, n, d1, d2`` over ``leaves (ix, iy, iz, d1, d2)``: level 1 are regions, each further one has cubes of ``axis`` nodes, the last is the root."""
    out, below = None, leaves
    for level in range(1, LEVELS + 2):
        up = [(F.lit(0) if level > LEVELS else F.floor(F.col(i) / axis)).cast("int").alias(i) for i in KEY]
        rows = below.select(*up, *[F.col(i).alias(f"c{i}") for i in KEY], *DIGEST)
        below = _digest(rows.groupBy(*KEY).agg(F.count("*").alias("n"), *_sums([F.col(f"c{i}") for i in KEY] + [F.col(d) for d in DIGEST])), "n")
        level_rows = below.select(F.lit(level).alias("level"), *KEY, "n", *DIGEST)
        out = level_rows if out is None else out.unionByName(level_rows)
    return out


def unequal(a: DataFrame, b: DataFrame) -> DataFrame:
    """``ix, iy, iz`` of what only one side has or whose digests differ."""
    other = b.select(*KEY, *[F.col(d).alias(f"o{d}") for d in DIGEST])
    both = a.select(*KEY, *DIGEST).join(other, KEY, "full_outer")
    same = F.lit(True)
    for d in DIGEST:
        same = same & F.col(d).eqNullSafe(F.col(f"o{d}"))
    return both.where(~same).select(*KEY)


def below(rows: DataFrame, parents: DataFrame, axis: int, root: bool = False) -> DataFrame:
    """The rows whose parent is one of ``parents``."""
    if root:
        return rows if not parents.isEmpty() else rows.limit(0)
    up = [F.floor(F.col(i) / axis).cast("int") for i in KEY]
    keyed = rows.withColumns({f"p{i}": u for i, u in zip(KEY, up, strict=True)})
    wanted = parents.select(*[F.col(i).alias(f"p{i}") for i in KEY])
    return keyed.join(wanted, [f"p{i}" for i in KEY], "left_semi").drop(*[f"p{i}" for i in KEY])


def star_changes(a: DataFrame, b: DataFrame, parts: int | None = None) -> DataFrame:
    """``source_id, ix, iy, iz, kind``: stars by chunk that are ``added``, ``removed`` or ``changed`` in ``b``. Repeated rows count.

    With ``parts`` both sides are dealt to so many tasks, by star, so that the memory of one doesn't grow with the catalogs.
    """
    columns = content_columns(a)
    sided = a.select(*columns, F.lit(-1).alias("side")).unionByName(b.select(*columns, F.lit(1).alias("side")))
    if parts is not None:
        sided = sided.repartition(parts, "source_id", *KEY)
    left = sided.groupBy(*columns).agg(F.sum("side").alias("side")).where("side <> 0")
    kind = F.when(F.max("side") < 0, "removed").when(F.min("side") > 0, "added").otherwise("changed")
    return left.groupBy("source_id", *KEY).agg(kind.alias("kind"))
