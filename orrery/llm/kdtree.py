"""Exact top-k by inner product with KD-trees per shard (operator 3).

Vectors are made integral. Median splits along the widest dimension of a sample of ``sample_rows`` vectors, those with the
smallest hash of their id, part space into at most ``cells`` cells; every vector goes to its cell, and a cell with many
vectors (or many equal ones) is dealt into shards by a hash of the id. Every shard becomes a KD-tree: median splits by
rank along the widest dimension (so repeated vectors split evenly too), with the tight bounding box of every node.

The cells' tight boxes are sent first: they bound the score of each query with each cell. A query visits cells in the order
of that bound, in rounds of 1, 3, 12, ... cells; the k-th score found so far is propagated to the next round,
and a cell whose bound is below it is passed by before any vector moves. Queries of one cell travel together as blocks. A
search in a shard goes best-first: nodes by the largest inner product that their box admits, until that is below the k-th score.

Defined results: a vector that is null or holds a null or non-finite component takes no part, nor do empty
vectors and rows without id. Rows with one id count once, with the smallest vector. Only vectors of the
query's dimension are compared. Ties go to the smaller id. Components or scores that don't fit a long raise an error.
An empty table gives an empty one; columns besides id, vector and those of ``is_query`` aren't read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import collected, drop_scratch, ship, written


@dataclass(frozen=True)
class Settings:
    k: int = 5
    shard_rows: int = 4_096
    block_rows: int = 1_024
    leaf_rows: int = 128
    cells: int = 1_024
    cell_numbers: int = 1 << 20  # cells times dimensions, so that the boxes of all cells stay small
    sample_rows: int = 16_384
    first_rounds: int = 4  # a round covers so many times the cells of all before


def integral(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null if the vector is to take no part. Raises an error beyond a long."""
    usable = (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    fits = lambda x: F.abs(x) < F.lit(float(1 << 63))
    whole = lambda x: F.when(fits(x), F.floor(x)).otherwise(F.raise_error(F.lit("a component does not fit a long")).cast("bigint"))
    return F.when(usable, F.transform(vector, lambda x: whole(x.cast("double") * scale)))


def cell_borders(points: np.ndarray, cells: int, least: int = 8) -> np.ndarray:
    """Splits ``axis, at, left, right`` of space into up to ``cells`` cells: a leaf has axis -1 and its cell in left.

    The cell with most points is split next, at the median of its widest dimension; smaller values go left.
    """
    nodes: list[list] = [[-1, 0, 0, -1]]
    heap = [(-len(points), 0, np.arange(len(points)))]
    leaves = 1
    while heap and leaves < cells:
        size, at, inside = heapq.heappop(heap)
        if -size < 2 * least:
            break
        held = points[inside]
        lo, hi = held.min(axis=0), held.max(axis=0)
        axis = int(np.argmax(hi.astype(float) - lo))
        if lo[axis] == hi[axis]:
            continue  # all equal: shards by id divide them
        values = np.sort(held[:, axis])
        border = values[len(values) // 2]
        if border == lo[axis]:
            border = values[np.searchsorted(values, border, side="right")]
        left = held[:, axis] < border
        for part in (inside[left], inside[~left]):
            heapq.heappush(heap, (-len(part), len(nodes), part))
            nodes.append([-1, 0, 0, -1])
        nodes[at] = [axis, int(border), len(nodes) - 2, len(nodes) - 1]
        leaves += 1
    for cell, node in enumerate(n for n in nodes if n[0] < 0):
        node[2] = cell
    return np.array(nodes, np.int64)


def cell_of(points: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """The cell of each point."""
    node = np.zeros(len(points), np.int64)
    while len(todo := np.flatnonzero(borders[node, 0] >= 0)):
        axis, border, left, right = borders[node[todo]].T
        node[todo] = np.where(points[todo, axis] < border, left, right)
    return borders[node, 2]


_NODE = np.dtype([("start", np.int32), ("end", np.int32), ("left", np.int32), ("right", np.int32)])


def build_tree(points: np.ndarray, leaf_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the points, nodes, boxes as lo and hi by node)."""
    order = np.arange(len(points))
    nodes, boxes, todo = [[0, len(points), -1, -1]], [], [0]
    while todo:
        at = todo.pop()
        start, end, *_ = nodes[at]
        inside = points[order[start:end]]
        lo, hi = inside.min(axis=0), inside.max(axis=0)
        boxes.append((at, lo, hi))
        if end - start > leaf_rows:
            half = (end - start) // 2
            order[start:end] = order[start:end][np.argpartition(inside[:, np.argmax(hi.astype(float) - lo)], half)]
            for child, (a, b) in enumerate(((start, start + half), (start + half, end))):
                nodes[at][2 + child] = len(nodes)
                todo.append(len(nodes))
                nodes.append([a, b, -1, -1])
    boxes.sort(key=lambda x: x[0])
    return order, np.array([tuple(n) for n in nodes], _NODE), np.array([(lo, hi) for _, lo, hi in boxes])


def search(ids: np.ndarray, points: np.ndarray, nodes: np.ndarray, boxes: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """For each query up to ``k`` best ``(-score, id)``, ascending, with scores of at least ``least``."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(boxes).max(initial=0)) * points.shape[1]
    kind = np.float64 if top < 2**53 else object  # sums of integers are exact in doubles up to there
    points, boxes, queries = points.astype(kind), boxes.astype(kind), queries.astype(kind)
    bounds = np.maximum(queries, 0) @ boxes[:, 1].T + np.minimum(queries, 0) @ boxes[:, 0].T
    spans = nodes.tolist()
    out = []
    for q in range(len(queries)):
        best: list[tuple] = []  # a heap with the worst of the best on top: (score, -id)
        floor, bound, query = least[q], bounds[q].tolist(), queries[q]
        heap = [(-bound[0], 0)]
        while heap:
            reach, at = heapq.heappop(heap)
            if -reach < floor:
                break
            start, end, left, right = spans[at]
            if left >= 0:
                for child in (left, right):
                    if bound[child] >= floor:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            scores = points[start:end] @ query
            for i in np.flatnonzero(scores >= floor).tolist():
                if ids[start + i] == query_ids[q]:
                    continue
                entry = (int(scores[i]), -int(ids[start + i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                else:
                    heapq.heappushpop(best, entry)
            if len(best) == k:
                floor = max(floor, best[0][0])
        out.append(sorted((-s, -i) for s, i in best))
    return out


def _pack(values: np.ndarray) -> bytes:
    """As 4-byte integers if they fit, else as 8-byte ones; the first byte tells."""
    values = np.ascontiguousarray(values, np.int64)
    small = not values.size or -(1 << 31) <= values.min() and values.max() < 1 << 31
    return b"4" + values.astype(np.int32).tobytes() if small else b"8" + values.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.int32 if packed[:1] == b"4" else np.int64, offset=1).astype(np.int64)


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().astype(np.int64).reshape(n, -1)


def _placed(rows: DataFrame, borders: dict[int, np.ndarray]) -> DataFrame:
    """``rows (id, v, q, dim)`` with their cell."""
    shared = rows.sparkSession.sparkContext.broadcast(borders)  # of a bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                cells = cell_of(_matrix(part.column(1), part.num_rows), shared.value.get(dim, np.array([[-1, 0, 0, -1]])))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells, pa.int64())], [*part.schema.names, "cell"])

    return rows.select("id", "v", "q", "dim").mapInArrow(run, "id bigint, v array<bigint>, q boolean, dim int, cell bigint")


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """Rows with ``part``, so that a cell's parts have about ``size`` rows each."""
    parts = rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / size).alias("parts"))  # settings.cells rows at most for each dimension
    return rows.join(F.broadcast(parts), ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), F.col("parts"))).drop("parts")


def _shards(vectors: DataFrame, s: Settings) -> DataFrame:
    """One row a shard: its tree, packed, and its box."""

    def build(table: pa.Table) -> pa.Table:
        points = _matrix(table["v"], table.num_rows)
        ids = table["id"].to_numpy()
        first = np.argsort(ids, kind="stable")  # the same tree in every attempt
        order, nodes, boxes = build_tree(points[first], s.leaf_rows)
        order = first[order]
        row = {"dim": points.shape[1], "cell": table["cell"][0].as_py(), "ids": _pack(ids[order]), "points": _pack(points[order]), "nodes": nodes.tobytes(), "boxes": _pack(boxes), "lo": boxes[0, 0].tolist(), "hi": boxes[0, 1].tolist()}
        return pa.Table.from_pylist([row], schema=pa.schema([("dim", pa.int32()), ("cell", pa.int64()), *[(c, pa.binary()) for c in ("ids", "points", "nodes", "boxes")], ("lo", pa.list_(pa.int64())), ("hi", pa.list_(pa.int64()))]))

    return _dealt(vectors, s.shard_rows).groupBy("dim", "cell", "part").applyInArrow(build, "dim int, cell bigint, ids binary, points binary, nodes binary, boxes binary, lo array<bigint>, hi array<bigint>")


def _cell_boxes(shards: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By dimension the cells with vectors, and their boxes as lo and hi."""
    sides = shards.select("dim", "cell", F.posexplode(F.arrays_zip("lo", "hi")).alias("at", "x")).groupBy("dim", "cell", "at").agg(F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi"))
    rows = collected(sides.orderBy("dim", "cell", "at"))  # settings.cell_numbers rows at most for each dimension
    out = {}
    for dim in np.unique(rows["dim"]).tolist():
        here = rows["dim"] == dim
        out[dim] = rows["cell"][here][::dim], *(rows[c][here].reshape(-1, dim) for c in ("lo", "hi"))
    return out


def _blocks(queries: DataFrame, s: Settings) -> DataFrame:
    """One row a block of queries of one cell, packed."""

    def pack(table: pa.Table) -> pa.Table:
        points = _matrix(table["v"], table.num_rows)
        ids = table["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        row = {"dim": points.shape[1], "home": table["cell"][0].as_py(), "part": table["part"][0].as_py(), "query_ids": _pack(ids[order]), "queries": _pack(points[order])}
        return pa.Table.from_pylist([row], schema=pa.schema([("dim", pa.int32()), ("home", pa.int64()), ("part", pa.int64()), ("query_ids", pa.binary()), ("queries", pa.binary())]))

    return _dealt(queries, s.block_rows).groupBy("dim", "cell", "part").applyInArrow(pack, "dim int, home bigint, part bigint, query_ids binary, queries binary")


def _bounds(queries: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The largest inner product of each query with a point of each box; exact, as objects where doubles aren't."""
    top = float(np.abs(queries).max(initial=0)) * float(max(np.abs(lo).max(initial=0), np.abs(hi).max(initial=0))) * queries.shape[1]
    kind = np.float64 if top < 2**53 else object  # sums of integers are exact in doubles up to there
    queries, lo, hi = (x.astype(kind) for x in (queries, lo, hi))
    return np.maximum(queries, 0) @ hi.T + np.minimum(queries, 0) @ lo.T


_NAMES = ["dim", "home", "part", "query_ids", "queries", "least", "cell"]
_LEAST = np.iinfo(np.int64).min


def _visits(blocks: DataFrame, boxes: dict, kth: DataFrame | None, first: int, last: int) -> DataFrame:
    """The queries that visit a cell, those whose ``first`` to ``last`` best-bounded cells it is among, unless its bound is below their k-th score."""
    shared = blocks.sparkSession.sparkContext.broadcast(boxes)
    rows = blocks.join(kth, ["dim", "home", "part"], "left") if kth is not None else blocks.withColumn("kth", F.lit(None).cast("map<bigint,bigint>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (r,) = batch.slice(i, 1).to_pylist()
                cells, lo, hi = shared.value[r["dim"]]
                ids = _unpack(r["query_ids"])
                queries = _unpack(r["queries"]).reshape(len(ids), -1)
                known = dict(r["kth"] or [])
                least = np.array([_LEAST if (x := known.get(q)) is None else x for q in ids.tolist()], np.int64)
                bounds = _bounds(queries, lo, hi)
                order = np.argsort(-bounds, axis=1, kind="stable")[:, first:last]
                wanted = np.zeros(bounds.shape, bool)
                np.put_along_axis(wanted, order, True, axis=1)
                wanted &= bounds >= least[:, None]
                for c in np.flatnonzero(wanted.any(axis=0)).tolist():
                    some = np.flatnonzero(wanted[:, c])
                    row = [r["dim"], r["home"], r["part"], _pack(ids[some]), _pack(queries[some]), _pack(least[some]), int(cells[c])]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 3, pa.int64()], strict=True)], _NAMES)

    return rows.mapInArrow(run, "dim int, home bigint, part bigint, query_ids binary, queries binary, least binary, cell bigint")


_FOUND = ["dim", "home", "part", "query_id", "vec_id", "score"]


def _searched(visits: DataFrame, shards: DataFrame, k: int) -> DataFrame:
    """``dim, home, part, query_id, vec_id, score`` of the searches in all shards of the visited cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (r,) = batch.slice(i, 1).to_pylist()
                ints = {c: _unpack(r[c]) for c in ("ids", "points", "boxes", "query_ids", "queries", "least")}
                d = r["dim"]
                found = search(ints["ids"], ints["points"].reshape(-1, d), np.frombuffer(r["nodes"], _NODE), ints["boxes"].reshape(-1, 2, d), ints["query_ids"], ints["queries"].reshape(-1, d), ints["least"].tolist(), k)
                rows = [(d, r["home"], r["part"], int(q), i, -s) for q, best in zip(ints["query_ids"], found, strict=True) for s, i in best]
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32(), *[pa.int64()] * 5], strict=True)], _FOUND)

    return visits.join(shards.drop("lo", "hi"), ["dim", "cell"]).mapInArrow(run, "dim int, home bigint, part bigint, query_id bigint, vec_id bigint, score bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    """``dim, home, part, query_id, best``: the ``k`` best ``(s, vec_id)`` of each query, in two steps, as every shard sends k."""
    best = lambda c: F.slice(F.array_sort(c), 1, k)
    block = ["dim", "home", "part", "query_id"]
    rows = found.select(*block, F.struct((-F.col("score")).alias("s"), "vec_id").alias("x"), F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("of"))
    rows = rows.groupBy(*block, "of").agg(best(F.collect_list("x")).alias("best"))
    return rows.groupBy(*block).agg(best(F.flatten(F.collect_list("best"))).alias("best"))


def top_k(vectors: DataFrame, is_query: Column, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding", visited: list[int] | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of all other rows for every row where ``is_query``.

    ``visited``, if given, gets the number of visits of blocks to cells in each round.
    """
    ship(vectors.sparkSession)
    s = settings
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), integral(F.col(vector_col)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where("id is not null and v is not null")
    rows = written(rows.groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q")).withColumn("dim", F.size("v")), "vectors", wide=True)
    sizes = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("q").alias("queries")).where("queries > 0").collect()}  # a row a dimension
    rows = rows.where(F.col("dim").isin([int(d) for d in sizes]))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(s.sample_rows).select("dim", "v").toArrow()
    borders = {}
    for dim, n in sizes.items():
        held = sample.filter(pc.equal(sample["dim"], dim))
        points = _matrix(held["v"], held.num_rows) if held.num_rows else np.zeros((0, dim), np.int64)
        borders[dim] = cell_borders(points, max(1, min(s.cells, s.cell_numbers // dim, n // s.shard_rows)))
    placed = written(_placed(rows, borders), "placed", wide=True)
    shards = written(_shards(placed.select("id", "v", "dim", "cell"), s), "shards", wide=True)
    blocks = written(_blocks(placed.where("q").select("id", "v", "dim", "cell"), s), "blocks", wide=True)
    boxes = _cell_boxes(shards)
    most = max((len(cells) for cells, _, _ in boxes.values()), default=0)
    best, first, last = None, 0, 1
    while first < most or best is None:
        kth = None
        if best is not None:
            known = best.where(F.size("best") >= s.k).select("dim", "home", "part", F.struct("query_id", (-F.col("best")[s.k - 1]["s"]).alias("least")).alias("x"))
            kth = known.groupBy("dim", "home", "part").agg(F.map_from_entries(F.collect_list("x")).alias("kth"))  # block_rows or so
        visits = written(_visits(blocks, boxes, kth, first, last), "visits", wide=True)
        if visited is not None:
            visited.append(visits.count())
        found = _searched(visits, shards, s.k)
        if best is not None:
            found = found.unionByName(best.select("dim", "home", "part", "query_id", F.explode("best").alias("x")).select("dim", "home", "part", "query_id", "x.vec_id", (-F.col("x.s")).alias("score")))
        before, best = best, written(_top(found, s.k), "best", wide=True)
        for done in (visits, before):
            if done is not None:
                drop_scratch(done)
        first, last = last, last * s.first_rounds
    for done in (rows, placed, shards, blocks):
        drop_scratch(done)
    ranked = best.select("query_id", F.posexplode("best").alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))
