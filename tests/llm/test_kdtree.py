import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm.kdtree import Settings, build_tree, cell_borders, cell_of, search, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            q = [int(np.floor(256 * float(np.float32(x)))) for x in v]
            usable[i] = min(usable.get(i, q), q)
    out = {}
    for i, q in usable.items():
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in usable.items() if j != i and len(v) == len(q))
            out[i] = [(r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return {i: x for i, x in out.items() if x}


@pytest.mark.parametrize("settings", [Settings(), Settings(shard_rows=40, block_rows=3, leaf_rows=4), Settings(k=3, shard_rows=7, block_rows=1, leaf_rows=1)])
def test_equals_brute_force(spark, settings):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in range(-60, 300)]
    rows += [(400 + i, [0.5] * 6) for i in range(60)]  # one very common vector: ties
    rows += [(500, None), (501, [None] * 6), (502, [float("nan")] + [1.0] * 5), (503, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (504, []), (550, [1.0, 2.0]), (551, [3.0, -1.0]), (50, rows[5][1]), (50, rows[5][1]), (600, [1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = {}
    for r in top_k(df, F.col("vec_id") % 50 == 0, settings).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {i: sorted(x) for i, x in got.items()} == brute(rows, settings.k)


def test_large_values_are_exact(spark):
    rows = [(50, [3e5, 1e5]), (1, [3e5, 1.0]), (2, [3e5, 1.0078125]), (3, [1.0, 1.0])]
    got = top_k(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA), F.col("vec_id") == 50).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(j, s) for _, j, s in brute(rows, 5)[50]]


def test_search_prunes():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(0, 10, (500, 3)), rng.integers(1000, 1010, (12, 3))])
    order, nodes, boxes = build_tree(points, 8)
    seen = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                seen.append(key)
            return super().__getitem__(key)

    found = search(order, points[order].astype(np.float64).view(Watched), nodes, boxes, np.array([-1]), np.array([[1, 1, 1]]), [-(2**63)], 5)
    assert len(found[0]) == 5 and all(i >= 500 for _, i in found[0])
    assert len(nodes) > 60


def test_cells_and_their_borders():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.integers(-50, 50, (300, 3)), np.zeros((200, 3), np.int64), np.full((100, 3), 7)])
    borders = cell_borders(points, 16)
    cells = cell_of(points, borders)
    assert set(cells.tolist()) <= set(range(16)) and len(set(cells.tolist())) > 8
    assert len(set(cells[300:500].tolist())) == 1
    assert set(cell_of(np.ones((5, 3), np.int64), cell_borders(np.ones((400, 3), np.int64), 8)).tolist()) == {0}


def test_cells_are_passed_by(spark):
    """Clustered vectors: blocks visit far fewer cells than there are, and the result is that of brute force."""
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(24, 6)) * 4
    rows = [(int(i), [float(x) for x in centers[i % 24] + rng.normal(size=6) * 0.05]) for i in range(2400)]
    visited = []
    settings = Settings(shard_rows=50, block_rows=8, leaf_rows=8)
    got = {}
    for r in top_k(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA), F.col("vec_id") % 50 == 0, settings, visited=visited).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {i: sorted(x) for i, x in got.items()} == brute(rows, settings.k)
    blocks, cells = visited[0], 2400 // 50
    assert len(visited) > 2 and sum(visited) < blocks * cells / 4


def test_too_large_components_raise(spark):
    df = spark.createDataFrame([(50, [3e38], 0), (1, [1.0], 0)], SCHEMA)
    with pytest.raises(Exception, match="does not fit a long"):
        top_k(df, F.col("vec_id") == 50).count()


def test_clashing_columns_and_long_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.normal(size=3000)]) for i in range(0, 120)]
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, dim int, cell int")
    got = {}
    for r in top_k(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {i: sorted(x) for i, x in got.items()} == brute(rows, 5)


def test_no_rows(spark):
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    assert top_k(spark.createDataFrame([(1, [1.0], 0)], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    assert top_k(spark.createDataFrame([(50, [1.0], 0)], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
