import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from orrery.llm.quality import _TAIL, Settings, Split, _Index, _key, _packed, _unpacked, classify, discounts, even_split, tokens


def split(text):
    return re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff\s]+", text)


def grams(text):
    w = ["<s>", "<s>", *split(text), "</s>"]
    return [tuple(w[i - 2 : i + 1]) for i in range(2, len(w))]


def brute_model(texts):
    tables = {3: Counter(g for t in texts if split(t) for g in grams(t))}
    for n in (2, 1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])
    d = {n: discounts(Counter(t.values())) for n, t in tables.items()}
    contexts = defaultdict(list)
    for n, t in tables.items():
        for g, c in t.items():
            contexts[n, g[:-1]].append(c)
    cut = lambda n, c: d[n][min(c, 3) - 1]

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / (len(tables[1]) + 1)
        seen = contexts.get((n, g[:-1]))
        if seen is None:
            return p(g[1:])
        c = tables[n].get(g, 0)
        return ((c - cut(n, c)) / sum(seen) if c else 0) + sum(cut(n, x) for x in seen) / sum(seen) * p(g[1:])

    return p


def perplexity(p, text):
    return math.exp(-sum(math.log(p(g)) for g in grams(text)) / len(grams(text)))


def corpus():
    """Sentences of one order, and the same words in another."""
    r = random.Random(3)
    sentence = lambda: " ".join(r.choice(x) for x in (["The", "A"], ["cat", "dog", "über"], ["sat", "ran"], ["on", "by"], ["the"], ["mat.", "hill.", "road,"]))
    good = [(i, "\n".join(sentence() for _ in range(r.randint(2, 12))), "en" if i % 2 else "de") for i in range(400)]
    mixed = []
    for i in range(10):
        w = " ".join(sentence() for _ in range(10)).split(" ")
        r.shuffle(w)
        mixed.append((1000 + i, " ".join(w), "en"))
    return good, mixed


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize("settings", [Settings(bits=20), Settings(head=7, bits=5, broadcast_ids=3)])
def test_equals_brute_force(spark, documents, settings):
    good, mixed = corpus()
    odd = [(2000, None, "en"), (2001, "", "en"), (2002, " \n\t ", "en"), (2003, "The cat", None), (2004, "The cat sat", "fr"), (None, "The cat sat on", "en"), (2005, "a dog", "en"), (2005, "THE CAT!!", "en"), (2006, "the mat. " * 10_000, "de")]
    trusted = [i for i, *_ in good if i % 4] + [9999]
    rows = good + mixed + odd
    p = brute_model([t for i, t, _ in good if i in trusted and not held_out(i)])
    ids = spark.createDataFrame([(i,) for i in trusted] * 2 + [(None,)], "doc_id long")
    got = defaultdict(list)
    for r in classify(documents(rows, extra="perplexity"), ids, settings).collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for i in {i for i, *_ in rows}:
        theirs = sorted(perplexity(p, t) for j, t, _ in rows if j == i and t and split(t))
        assert np.allclose(sorted(r["perplexity"] for r in got[i] if r["perplexity"] is not None), theirs, rtol=1e-9), i
    by_lang = {x: sorted(perplexity(p, t) for i, t, y in good if i in trusted and y == x and held_out(i)) for x in ("en", "de")}
    for i, _, lang in good[:6]:
        assert got[i][0]["threshold"] == pytest.approx(by_lang[lang][math.ceil(settings.quantile * len(by_lang[lang])) - 1])
    assert got[2003][0]["threshold"] == got[2004][0]["threshold"]  # of all held-out trusted documents
    assert not any(got[i][0]["kept"] for i in (2000, 2001, 2002))
    assert not any(got[i][0]["kept"] for i, *_ in mixed)  # right words in a wrong order
    rest = [got[i][0]["kept"] for i, *_ in good if i not in trusted]
    assert sum(rest) >= 0.85 * len(rest)


def test_few_or_no_trusted_documents(spark, documents):
    docs = documents([(1, "some text", "en"), (2, "other text", "en")])
    for i in (1, 2, 5):  # one document is both learnt from and the threshold
        ids = spark.createDataFrame([(i,)], "doc_id long")
        assert {r["doc_id"] for r in classify(docs, ids, Settings(bits=10)).where("kept").collect()} >= ({i} if i < 3 else set())
    assert [tuple(r)[1:] for r in classify(docs, ids, Settings(bits=10)).collect()] == [(None, None, False)] * 2
    assert classify(documents([]), ids).count() == 0


def test_keys_are_those_of_spark(spark):
    rng = np.random.default_rng(1)
    rows = [(int(a), int(b)) for a, b in rng.integers(-(1 << 63), 1 << 63, (50, 2))] + [(0, 0), (-1, 1)]
    hi, lo = (np.array(x, np.int64).view(np.uint64) for x in zip(*rows, strict=True))
    got = spark.createDataFrame(rows, "hi long, lo long").selectExpr("xxhash64(3L, hi, lo) k").collect()
    assert [r["k"] for r in got] == _key(3, hi, lo).view(np.int64).tolist()


def test_discounts():
    assert discounts({}) == (0.5, 0.5, 0.5)
    n = {1: 100, 2: 40, 3: 20, 4: 12}
    y = 100 / 180
    assert discounts(n) == pytest.approx((1 - 2 * y * 0.4, 2 - 3 * y * 0.5, 3 - 4 * y * 0.6))


def test_rounds_equal_brute_force(spark, documents):
    """A part of the middle words at a time, of which some have a round of their own; few words are in the head."""
    test_equals_brute_force(spark, documents, Settings(head=7, shards=5, shard_bytes=1000))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"  # as before


def test_even_split():
    words = np.arange(1, 2001, dtype=np.uint64) << np.uint64(20) ^ np.arange(7, 2007, dtype=np.uint64) * np.uint64(0x9E3779B1)
    counts = np.r_[1000, 700, np.ones(1998, np.int64)]
    split = even_split(words, counts, 8)
    shares = np.bincount(split.of(words), counts, 8)
    assert split.own == tuple(words[:2].tolist()) and shares[-2:].tolist() == [1000, 700] and shares[:-2].max() < 500
    assert not Split().of(words).any()


def test_codes_of_tokens_of_any_length_and_place():
    rng = random.Random(5)
    words = [("x" * n + rng.choice("abcé")) * k for n in range(40) for k in (1, 2)]
    texts = [" ".join(rng.sample(words, len(words))) for _ in range(5)]
    raw = [t.encode() for t in texts]
    offsets = np.r_[0, np.cumsum([len(t) for t in raw])]
    codes, firsts = tokens(np.frombuffer(b"".join(raw), np.uint8), offsets)
    said = [w for t in texts for w in split(t)]
    assert len(codes) == firsts[-1] == len(said)
    assert len(set(zip(said, codes.tolist(), strict=True))) == len(set(said)) == len(set(codes.tolist()))


def _shuffled(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return {(x.stageId(), x.attemptId()): x.shuffleWriteBytes() for x in (stages.apply(i) for i in range(stages.size()))}


def test_tokens_are_shuffled_once_in_few_bytes(spark, documents):
    """Of two rounds over 400,000 tokens; when trigrams went through two exchanges of whole codes it was 37 bytes a token."""
    rng = np.random.default_rng(2)
    words = (rng.pareto(0.7, 400_000) * 10).astype(np.int64) % 20_000
    docs = documents([(i, " ".join(f"w{x}" for x in words[i * 1000 : i * 1000 + 1000]), "en") for i in range(400)])
    ids = spark.createDataFrame([(i,) for i in range(0, 400, 4)], "doc_id long")
    before = _shuffled(spark)
    assert classify(docs, ids, Settings(shards=2, shard_bytes=1 << 20)).where("perplexity is not null").count() == 400
    assert sum(v for k, v in _shuffled(spark).items() if k not in before) < 20 * len(words)


def test_lists_of_a_message():
    rng = np.random.default_rng(4)
    ids = np.where(rng.random(5000) < 0.9, rng.integers(0, 1 << 18, 5000).astype(np.uint64), rng.integers(0, 1 << 42, 5000).astype(np.uint64) | _TAIL)
    ids[:3] = 0, _TAIL, _TAIL | np.uint64((1 << 42) - 1)
    for n in (0, 1, 5000):
        sent = {"a": ids[:n], "c": ids[::-1][:n], "n": rng.integers(0, 1 << 40, n), "e": rng.random(n), "rows": rng.integers(-(1 << 63), 1 << 63, n), "runs": np.ones(n, np.int32)}
        got = _unpacked(_packed(sent))
        assert all(np.array_equal(got[k], v) for k, v in sent.items()) and not any(len(v) for k, v in got.items() if k not in sent)


def test_places_among_hashes():
    rng = np.random.default_rng(6)
    for n in (0, 1, 1000):
        keys = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        asked = np.r_[keys, rng.integers(0, 1 << 64, 1000, dtype=np.uint64), np.array([0, (1 << 64) - 1], np.uint64)]
        place = {int(k): i for i, k in enumerate(keys)}
        assert _Index(keys).find(asked).tolist() == [place.get(int(x), n) for x in asked]
