import random
import re

import pytest
from pyspark.sql import functions as F

from orrery.llm.components import connected_components
from orrery.llm.minhash import Settings, _level, level, near_duplicates


def brute(rows, n, percent):
    """Sizes and components by comparing all pairs of full sets."""
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])

    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def corpus(seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    base = [word() for _ in range(160)]
    texts = [" ".join(word() for _ in range(r.randint(3, 90))) for _ in range(60)]
    for _ in range(90):  # a group of near copies at all distances
        w = list(base)
        for _ in range(r.randint(0, 16)):
            w[r.randrange(len(w))] = word()
        texts.append(" ".join(w))
    chain = list(base[:100])  # each a copy of the one before, far from the first
    for _ in range(12):
        chain = chain[2:] + [word(), word()]
        texts.append("\t".join(chain))
    passage = " ".join(base[20:80])
    texts += [f"{' '.join(word() for _ in range(40))} {passage}" for _ in range(40)]  # share a passage, no near copies
    texts += [texts[0]] * 30 + [texts[1].upper() + "  \n"] * 3 + ["one", "ONE ", "one two", "one", "", None, " \n ", "a b c", "A B C d", " ", "long " * 30_000, " ".join(base) * 2]
    many = [f"w{k}" for k in range(4200)]  # sets in two and in four pieces
    texts += [" ".join(many), " ".join(many[:4000]), " ".join([*many[:3700], "x", "y", "z"]), " ".join(many[:2100]), " ".join(many[:1900])]
    ids = r.sample(range(-500, 5000), len(texts))
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("settings", [Settings(3, 85), Settings(5, 80), Settings(1, 50, half=2)])
def test_equals_brute_force(spark, documents, settings):
    rows = corpus()
    docs = documents([(i, t, "en") for i, t in rows], extra="component_id")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs, settings).collect()}
    assert got == brute(rows, settings.shingle, settings.percent)


def test_null_and_repeated_ids(documents):
    rows = [(None, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, None)]
    got = sorted((repr(r["doc_id"]), r["component_id"], r["kept"]) for r in near_duplicates(documents([(i, t, "en") for i, t in rows])).collect())
    assert got == [("1", 1, True), ("2", 1, False), ("2", 1, False), ("3", 3, True), ("None", None, False)]


def test_texts_of_one_id_are_separate(documents):
    """Each text of a repeated id keeps the links of its own, also where the id is the smallest of several classes."""
    x, y, z = (" ".join(f"{c}{k}" for k in range(200)) for c in "xyz")
    rows = [(5, x), (5, y), (5, y), (9, x + " end"), (1, y + " end"), (7, z), (5, z + " end"), (8, x + " END"), (2, z + " fin")]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(documents([(i, t, "en") for i, t in rows])).collect())
    assert got == sorted([(5, 196, 5, True), (5, 196, 1, False), (5, 196, 1, False), (9, 197, 5, False), (1, 197, 1, True), (7, 196, 2, False), (5, 197, 2, False), (8, 197, 5, False), (2, 197, 2, True)])


def test_levels(spark):
    sizes = [0, 1, 2, 2047, 2048, 2049, 4095, 4096, 4097, 8192, 8193, 10**9]
    assert [r[0] for r in spark.createDataFrame([(n,) for n in sizes], "n bigint").select(_level(F.col("n"))).collect()] == [level(n) for n in sizes]


def test_empty(documents):
    assert near_duplicates(documents([])).count() == 0


def test_misses_are_rare():
    for s in (Settings(3, 85), Settings(5, 80)):
        assert 2 * (1 - (s.percent / 100) ** s.half) ** s.m <= s.miss


def test_components(spark):
    r = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 60)] + [(1000 + r.randrange(80), 1000 + r.randrange(80)) for _ in range(60)] + [(2000, 2000 - k) for k in range(1, 300)] + [(5, 5), (None, 1), (7, 6)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {n["node"]: n["component"] for n in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
