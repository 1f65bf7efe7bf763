import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tests.conftest import DATA

from orrery.llm import periodic
from orrery.llm.periodic import Settings, digests, find, periodic_runs
from orrery.llm.queries import QUERIES, with_planted_runs


def brute(words, least=6, exponent=4):
    """All runs by trying every period at every place."""
    n, out = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                out.setdefault((i, j + q), q)  # smallest period first
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    first = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *first, sha("".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))), sha(collapsed(words, runs)))


def random_words(r):
    n = r.randint(0, 60)
    words = [r.choice(r.choice(("ab", "abcdefghijkl"))) for _ in range(n)]
    if r.random() < 0.6 and n > 4:
        a, p = r.randrange(n), r.randint(1, n // 2)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def pieces(docs, s):
    rows, firsts, upto = find(pa.array([" ".join(d) for d in docs], pa.string()), s)
    return [[(int(a - firsts[i]), int(b - a), int(q)) for a, b, q in rows[upto[i] : upto[i + 1]]] for i in range(len(docs))]


@pytest.mark.parametrize("s", [Settings(), Settings(4, 2), Settings(2, 2), Settings(8, 3)])
def test_equals_all_periods_at_all_places(s):
    r = random.Random(1)
    for _ in range(150):
        docs = [random_words(r) for _ in range(r.randint(1, 6))]
        assert pieces(docs, s) == [brute(d, s.min_length, s.exponent) for d in docs]


def test_small_pieces_of_pairs_change_nothing(monkeypatch):
    r, s = random.Random(2), Settings()
    docs = [random_words(r) for _ in range(200)]
    whole = pieces(docs, s)
    monkeypatch.setattr(periodic, "PAIRS", 7)
    assert pieces(docs, s) == whole


def test_colliding_hashes_are_found_out(monkeypatch):
    """With a base whose powers vanish, prefixes compare equal that aren't."""
    monkeypatch.setattr(periodic, "_BASE", 1 << 16)
    r, s = random.Random(3), Settings(4, 2)
    docs = [random_words(r) for _ in range(150)]
    assert pieces(docs, s) == [brute(d, 4, 2) for d in docs]


def test_overlap_of_the_default_is_five_words():
    assert Settings().overlap == 5 and Settings(2, 2).overlap == 1


def test_masking_leaves_only_stretches_with_repetitions():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 1 << 60, 100_000).astype(np.uint64)
    words[500:540] = np.tile(words[500:504], 10)
    starts, ends = periodic.repeated_stretches(words, np.array([0, len(words)]), Settings())
    assert list(zip(starts, ends, strict=True)) == [(500, 540)]


def test_a_gram_repeated_in_another_document_masks_nothing_here():
    docs = [[*"abcdefgh"], [*"abcdefgh"]]
    rows, firsts, _ = find(pa.array([" ".join(d) for d in docs]))
    assert len(rows) == 0


def test_long_repetitive_text():
    n = 50_000
    assert pieces([["a"] * n, ["x", *"yz" * (n // 2)]], Settings()) == [[(0, n, 1)], [(1, n // 2 * 2, 2)]]


def test_edge_cases(spark, documents):
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " \n\t", None), (4, "a a a a a", "en"), (5, "a a a a a a", "en"), (5, "a a a a a a", "en"), (None, "b b b b b b b", "en"),
        (6, "x\x0by x\x0cy x\ty  x\ny z", "en"), (7, "é日 é日 é日 é日 é日 é日", "de"), (8, "A a A a A a A a", "en"), (9, "q " * 30_000 + "r " * 20_000, "en"),
    ]
    out = [tuple(r) for r in digests(periodic_runs(documents(rows, extra="start"))).collect()]
    plain = []
    for i, t, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = [(0, 30_000, 1), (30_000, 20_000, 1)] if i == 9 else brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        plain.append((i, len(runs), *((None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])), sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs))))
    assert sorted(map(repr, out)) == sorted(map(repr, plain))


def test_columns_with_clashing_names_keep_their_values(spark):
    docs = spark.createDataFrame([(1, "a a a a a a b", "s", 2, "old")], "doc_id long, text string, words string, length int, runs string")
    out = periodic_runs(docs)
    assert sorted(out.columns) == ["collapsed", "doc_id", "length", "runs", "text", "words"]
    row = out.first()
    assert (row["words"], row["length"], row["collapsed"]) == ("s", 2, "a b") and [tuple(x) for x in row["runs"]] == [(0, 6, 1)]


def test_empty_table(documents):
    assert digests(periodic_runs(documents([]))).collect() == []


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    small = [(i, t) for i, t in docs if len(t or "") < 6_000]
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, DATA).collect()}
    assert len(got) == len(docs)
    for i, t in small:
        assert got[i] == expected(i, t)
    assert sum(r[1] > 0 for r in got.values()) >= len(docs) // 20  # planted ones among them


def test_planting_of_odd_documents(spark):
    rows = [(i, t) for i in range(400) for t in (None, "", "one", "a b", "a b c d e f g h i j")]
    out = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(repr, [tuple(r) for r in digests(periodic_runs(with_planted_runs(out))).collect()]))
    assert got == sorted(repr(expected(i, t)) for i, t in rows)
