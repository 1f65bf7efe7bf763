import random
import re

import numpy as np
import pytest

from orrery.llm.decontaminate import GAP, MATCH, MISMATCH, Settings, admits, align, contaminated, enough, smith_waterman


def brute_sw(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (MATCH if a[i - 1] == b[j - 1] else MISMATCH), h[i - 1, j] + GAP, h[i, j - 1] + GAP)
    best = int(h.max())
    return best, int(min(np.argwhere(h == best)[:, 1])) if best else 0


def test_alignment_equals_dynamic_programming():
    r = np.random.default_rng(1)
    for _ in range(300):
        a, b = r.integers(0, 5, r.integers(0, 15)), r.integers(0, 5, r.integers(0, 30))
        assert smith_waterman(a, b) == brute_sw(a.tolist(), b.tolist())
    score, start, end = align(np.array([1, 2, 3, 4]), np.array([9, 9, 1, 2, 7, 3, 4, 9]))
    assert (score, start, end) == (7, 2, 7)


def words(r, n):
    return ["".join(r.choice("abcdefghijklm") for _ in range(r.randint(2, 8))) for _ in range(n)]


def corpus():
    """(documents, items, the pairs that are copies)"""
    r = random.Random(4)
    items = {k: words(r, r.randint(15, 50)) for k in range(30)}
    docs, wanted, i = [], set(), 0
    for k, w in items.items():
        for edit in (0, 0.05, 0.1, 0.15):
            copy = [x if r.random() >= edit else r.choice([None, r.choice(words(r, 1)), x + " " + r.choice(words(r, 1))]) for x in w]
            text = " ".join([*words(r, r.randint(0, 200)), *(x for x in copy if x), *words(r, 50)])
            docs.append((i, r.choice([text, text.upper(), text.replace(" ", ",\n")])))
            wanted.add((i, k))
            i += 1
    for _ in range(200):
        docs.append((i, " ".join(words(r, 120))))
        i += 1
    for k in range(300):  # one very common passage
        docs.append((i, " ".join([*words(r, 5), *items[7]])))
        wanted.add((i, 7))
        i += 1
    r.shuffle(docs)
    return docs, items, wanted


def test_finds_copies_and_nothing_else(spark, documents):
    docs, items, wanted = corpus()
    odd = [(-1, None), (-2, ""), (-3, "one two"), (None, " ".join(items[3])), (-4, " ".join(items[3])), (-4, " ".join(items[3])), (-5, "filler " * 20_000 + " ".join(items[5]))]
    wanted |= {(-4, 3), (-5, 5)}
    tests = spark.createDataFrame([(k, " ".join(w), 1) for k, w in items.items()] + [(100, None, 1), (101, "", 1), (102, "two words", 1), (None, " ".join(items[3]), 1), (8, " ".join(items[8]), 1)], "item_id long, text string, doc_id long")
    out = contaminated(documents([(i, t, "en") for i, t in docs + odd], extra="item_id"), tests).collect()
    found = {(r["doc_id"], r["item_id"]) for r in out}
    assert len(found) == len(out)
    assert found == wanted
    best = {(r["doc_id"], r["item_id"]): r for r in out}
    assert best[-4, 3]["similarity"] == 1 and best[-4, 3]["start_word"] == 0 and best[-4, 3]["end_word"] == len(items[3])
    assert best[-5, 5]["start_word"] == 20_000


@pytest.mark.parametrize("which", ["documents", "items", "both"])
def test_empty(spark, documents, which):
    docs = documents([] if which != "items" else [(1, "a b c d e f g h", "en")])
    items = spark.createDataFrame([] if which != "documents" else [(1, "a b c d e f g h")], "item_id long, text string")
    assert contaminated(docs, items).count() == 0


def test_short_items_need_all_words(spark, documents):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = documents([(1, "x alpha beta gamma delta y", "en"), (2, "x alpha beta gamma y", "en")])
    assert [r["doc_id"] for r in contaminated(docs, items, Settings()).collect()] == [1]


@pytest.mark.parametrize("offset", range(4))
def test_edited_copy_beside_an_exact_one(spark, documents, offset):
    """The exact copy makes the n-grams that the edited copies kept the more frequent ones."""
    r = random.Random(offset)
    items = {k: words(r, 24) for k in range(20)}
    docs = [(k, " ".join(w), "en") for k, w in items.items()]
    for k, w in items.items():
        docs.append((100 + k, " ".join("other" if i % 4 == offset else x for i, x in enumerate(w)), "en"))
    tests = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in contaminated(documents(docs), tests).collect()}
    assert found == {(k, k) for k in items} | {(100 + k, k) for k in items}


def edited(r, w, share):
    """A copy with that share of its words replaced, left out, or with a word put in after them."""
    out = []
    for x in w:
        if r.random() >= share:
            out.append(x)
        else:
            out += r.choice([words(r, 1), [], [x, *words(r, 1)]])
    return out


def recall_by_share(spark, documents, items, shares, seed):
    """For each share (pairs found, pairs that aligning every document with every item finds)."""
    r = random.Random(seed)
    docs = [(1000 * k + i, " ".join([*words(r, 20), *edited(r, w, share), *words(r, 20)]), "en") for k, share in enumerate(shares) for i, w in enumerate(items.values())]
    tests = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    found = {(x["doc_id"], x["item_id"]) for x in contaminated(documents(docs), tests).collect()}
    code, s, wanted = {}, Settings(), set()
    number = lambda w: np.array([code.setdefault(x, len(code)) for x in w])
    coded = {k: number(w) for k, w in items.items()}
    for i, text, _ in docs:
        passage = number(text.split())
        wanted |= {(i, k) for k, w in coded.items() if enough(smith_waterman(w, passage)[0], len(w), s)}
    assert found <= wanted
    return [(len({x for x in found if x[0] // 1000 == k}), len({x for x in wanted if x[0] // 1000 == k})) for k in range(len(shares))]


def test_recall_against_all_pairs(spark, documents):
    """Over all pairs aligned in full, by the share of edited words up to where copies stop being finds."""
    r = random.Random(12)
    items = {k: words(r, r.randint(12, 60)) for k in range(60)}
    got = recall_by_share(spark, documents, items, (0.0, 0.1, 0.2, 0.3), 5)
    assert got[0] == (60, 60) and all(a >= 0.9 * b and b > 20 for a, b in got)


def test_texts_of_one_item_id(spark, documents):
    """Each text of a repeated item id is looked for, and each text of a repeated document id is searched."""
    r = random.Random(21)
    a, b, c = (words(r, 20) for _ in range(3))
    tests = spark.createDataFrame([(1, " ".join(a)), (1, " ".join([*b, *words(r, 9)])), (1, " ".join(b)), (2, " ".join(c))], "item_id long, text string")
    docs = documents([(1, " ".join(a), "en"), (2, " ".join(b), "en"), (3, " ".join(words(r, 30)), "en"), (4, " ".join(words(r, 30)), "en"), (4, " ".join(c), "en"), (5, " ".join([*a, *b]), "en")])
    got = {(x["doc_id"], x["item_id"]): x["similarity"] for x in contaminated(docs, tests).collect()}
    assert got == {(1, 1): 1.0, (2, 1): 1.0, (4, 2): 1.0, (5, 1): 1.0}


def test_common_ngrams_are_no_seeds_but_items_of_them_are_found(spark, documents):
    r = random.Random(22)
    phrase = ["one", "of", "the", "most"]
    item, plain = [*words(r, 10), *phrase, *words(r, 10)], [*phrase, "of", *phrase, "and", *phrase]
    docs = [(i, " ".join([*words(r, 10), *phrase, *words(r, 10)]), "en") for i in range(300)] + [(1000, " ".join(item), "en"), (1001, " ".join(plain), "en")]
    tests = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(plain))], "item_id long, text string")
    assert {(x["doc_id"], x["item_id"]) for x in contaminated(documents(docs), tests).collect()} == {(1000, 1), (1001, 2)}


def test_bound_is_exact():
    """The bound never rules out a passage that makes a find."""
    rng = np.random.default_rng(2)
    s, ruled = Settings(), 0
    for _ in range(3000):
        item, passage = rng.integers(0, 12, rng.integers(3, 14)), rng.integers(0, 30, rng.integers(0, 60))
        if not admits(item, passage, s):
            ruled += 1
            assert not enough(smith_waterman(item, passage)[0], len(item), s)
    assert ruled > 100


def test_query_against_all_pairs(spark):
    """The registered query over its whole tables, and every document aligned with every item in full."""
    from orrery.llm.queries import op6_decontaminate

    folder, code, s = "/root/testdata/sf0.001", {}, Settings()
    split = lambda t: np.array([code.setdefault(w, len(code)) for w in re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))])
    items = {r["item_id"]: split(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    wanted = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        text = split(r["text"])
        for k, w in items.items():
            if len(w) >= s.n and enough(MATCH * int(np.isin(text, w).sum()), len(w), s) and enough(score := smith_waterman(w, text)[0], len(w), s):
                wanted[r["doc_id"], k] = score
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in op6_decontaminate(spark, folder).collect()}
    assert got.items() <= wanted.items() and len(got) >= 0.9 * len(wanted) > 2


def test_scripts_without_blanks(spark, documents):
    """Items of ideographs, kana and Thai inside other text of their script, whole and with one code point changed."""
    chinese = "床前明月光疑是地上霜举头望明月低头思故乡"
    kana = "いろはにほへとちりぬるをわかよたれそつねならむ"
    thai = "ภาษาไทยเป็นภาษาที่มีระดับเสียง"
    tests = spark.createDataFrame([(1, chinese), (2, kana), (3, thai), (4, "𠀀𠀁𠀂𠀃𠀄𠀅𠀆")], "item_id long, text string")
    docs = [
        (1, "他说道" + chinese + "然后离开了"), (2, "彼は" + kana + "と言った"), (3, "เขาพูดว่า" + thai + "แล้วไป"), (4, "今天天气很好我们去公园"), (5, "é" * 30),
        (6, "abc" + chinese.replace("霜", "雪") + "xyz"), (7, "x𠀀𠀁𠀂𠀃𠀄𠀅𠀆y"), (8, "床前"),
    ]
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in contaminated(documents([(i, t, "zh") for i, t in docs]), tests).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 3), (6, 1), (7, 4)}
    assert got[1, 1] == got[2, 2] == got[3, 3] == 1 and 0.9 < got[6, 1] < 1


def test_units_of_mixed_texts():
    """Bounds against a plain split of each text into code points of scripts without blanks and runs of other words."""
    from orrery.llm.words import NOT_ALNUM, unit_bounds

    r = random.Random(3)
    alphabet = ["a", "Z", "7", " ", "\n", "-", "é", "ß", "한", "月", "い", "ท", "က", "ក", "𠀀", "😀", "\uf900"]
    alone = set("月いทကក𠀀\uf900")
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(300)]
    wanted = []
    for t in texts:
        parts = re.findall("[" + "".join(alone) + "]|[^" + "".join(alone) + r" \n\-]+", t)
        wanted.append([p.encode() for p in parts])
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    starts, ends, firsts = unit_bounds(raw, offsets, NOT_ALNUM)
    got = [[raw[a:b].tobytes() for a, b in zip(starts[x:y], ends[x:y], strict=True)] for x, y in zip(firsts[:-1], firsts[1:], strict=True)]
    assert got == wanted


def test_short_items_are_found_as_whole_texts(spark, documents):
    """An item of one or two words is found where a text consists of just these words, not where it is part of a longer one."""
    tests = spark.createDataFrame([(1, "Yes."), (2, "not sure"), (3, "one two three")], "item_id long, text string")
    docs = [(1, "yes"), (2, "Not sure!"), (3, "yes it is"), (4, "I am not sure"), (5, "sure not"), (6, "so one two three go"), (7, "not"), (8, "!!"), (9, "YES\n")]
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in contaminated(documents([(i, t, "en") for i, t in docs]), tests).collect()}
    assert got == {(1, 1): 2, (9, 1): 2, (2, 2): 4, (6, 3): 6}


def test_a_long_item_changes_no_other_passage(spark, documents):
    """Items of 12 and of 10,000 words: the passages of the short one are as without the long one, and both are found."""
    from pyspark.sql import functions as F

    from orrery.llm import decontaminate as d

    r = random.Random(31)
    short, long, filler = words(r, 12), words(r, 10_000), words(r, 30_000)
    docs = documents([(1, " ".join([*filler[:20_000], *short, *filler[20_000:]]), "en"), (2, " ".join([*filler[:100], *edited(r, long, 0.1), *filler[:100]]), "en"), (3, " ".join(long[:4000]), "en")])
    seen = []
    plain = d._passages

    def record(*args):
        out = plain(*args)
        seen.append({(x["key"], x["class"], x["n"]) for x in out.select("key", "class", F.size("words").alias("n")).collect()})
        return out

    d._passages = record
    try:
        for items in ([(1, " ".join(short))], [(1, " ".join(short)), (2, " ".join(long))]):
            got = contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    finally:
        d._passages = plain
    assert {(x["doc_id"], x["item_id"]) for x in got} == {(1, 1), (2, 2)}
    assert seen[0] == {x for x in seen[1] if x[1] == 4} and max(n for *_, n in seen[0]) < 60  # class 4: up to 16 words
    assert not [x for x in seen[1] if x[0] == 3]  # too short for the long item
