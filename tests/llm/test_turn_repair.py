import hashlib
import itertools
import random
import re
import zlib

import pytest
from tests.conftest import DATA

from orrery.llm.queries import QUERIES, with_damage
from orrery.llm.turn_repair import Settings, Walker, digests, repair

GRAMMAR = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """``blank``, ``duplicate``, ``truncated`` or None of each row."""
    out = []
    for i, (role, text) in enumerate(rows):
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in rows[:i] else "truncated" if bare[-1] not in ".!?" else None)
    return out


def all_ways(rows, most):
    """Every sequence of edits with up to ``most`` insertions: cost, letters, repaired turns."""
    marks = faults(rows)
    for n in range(most + 1):
        for places in itertools.combinations_with_replacement(range(len(rows) + 1), n):
            inserted = [places.count(i) for i in range(len(rows) + 1)]
            for roles in itertools.product(("user", "assistant"), repeat=n):
                for edits in itertools.product("DKua", repeat=len(rows)):
                    fresh, cost, letters, out = iter(roles), 2 * n, "", []
                    for i in range(len(rows) + 1):
                        for _ in range(inserted[i]):
                            letters += "I"
                            out.append((next(fresh), ""))
                        if i == len(rows):
                            break
                        e = edits[i]
                        if e == "D":
                            cost, letters = cost + 3, letters + "D"
                            continue
                        if marks[i] in ("blank", "duplicate"):
                            break
                        cost += (marks[i] == "truncated") + (2 if e in "ua" else 0)
                        letters += "K" if e == "K" else "R"
                        out.append(({"u": "user", "a": "assistant"}.get(e, rows[i][0]), rows[i][1]))
                    else:
                        continue
                    if i == len(rows) and all(r for r, _ in out) and GRAMMAR.fullmatch("".join(r[0] for r, _ in out)):
                        yield cost, letters, out


def plain(turns):
    """Counts, cost, audit and digest of one conversation by a table over all turns and states, without steps remembered or blocks."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    rows = [(r, x) for _, r, x in turns]
    marks, n, far = faults(rows), len(rows), 10**9
    go = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]

    def ways(i, q):
        letter = "a" if q == 2 else "u"
        yield "I", 2, i, go[q][letter], letter
        if i < n:
            yield "D", 3, i + 1, q, None
            if marks[i] not in ("blank", "duplicate"):
                more = marks[i] == "truncated"
                if rows[i][0][:1] in go[q]:
                    yield "K", more, i + 1, go[q][rows[i][0][:1]], ""
                yield "R", 2 + more, i + 1, go[q][letter], letter

    cost = [[far] * 4 for _ in range(n)] + [[0, far, far, 0]]
    for i in range(n, -1, -1):
        for _ in range(5):
            for q in range(4):
                cost[i][q] = min([cost[i][q], *(c + cost[j][to] for _, c, j, to, _ in ways(i, q))])
    i = q = 0
    audit, said = "", []
    while i < n or q not in (0, 3):
        e, _, j, to, letter = min((w for w in ways(i, q) if w[1] + cost[w[2]][w[3]] == cost[i][q]), key=lambda w: w[0])
        if e != "D":
            said.append(f"{rows[i][0] if e == 'K' else {'u': 'user', 'a': 'assistant'}[letter]}:{'' if e == 'I' else rows[i][1]}")
        audit, i, q = audit + e, j, to
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, *(marks.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost[0][0], audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def random_turns(r, most, numbers):
    texts = ["Yes.", "No", "Why?", "", " \t", "ok!", "é日.", "x  "]
    return [(r.choice(numbers), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "s", "User"]), r.choice(texts)) for _ in range(r.randint(0, most))]


def results(spark, conversations, s=Settings()):
    rows = [(k, *t) for k, turns in conversations.items() for t in turns]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    ids = spark.createDataFrame([(k,) for k in conversations], "conv_id long")
    out = digests(repair(turns, s), ids)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r[0]: tuple(r)[1:] for r in out.collect()}


def test_the_plain_version_equals_all_sequences_of_edits():
    r = random.Random(0)
    for _ in range(120):
        turns = random_turns(r, 3, range(4))
        turns.sort(key=lambda t: (t[0], t[1], t[2]))
        rows = [(a, b) for _, a, b in turns]
        cost, letters, out = min(all_ways(rows, 3), key=lambda w: w[:2])
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest()
        assert plain(turns)[5:] == (cost, letters, digest)


def test_equals_the_plain_version(spark):
    r = random.Random(1)
    conversations = {k: random_turns(r, 12, [*range(8), None]) for k in range(400)}
    assert results(spark, conversations) == {k: plain(t) for k, t in conversations.items()}


@pytest.mark.parametrize("block", [1, 3, 64])
def test_blocks_change_nothing(spark, block):
    """Conversations over many blocks, with turns that repeat one of an earlier block."""
    r = random.Random(block)
    conversations = {k: random_turns(r, 40, [*range(30), None]) for k in range(40)}
    conversations |= {1000: [(i, "user", "same.") for i in range(200)], 1001: [(i, "ua"[i % 2] and ("user", "assistant")[i % 2], f"{i}.") for i in range(300)], 1002: [(1 << 40, "user", "late."), (-5, "system", "early.")]}
    assert results(spark, conversations, Settings(block)) == {k: plain(t) for k, t in conversations.items()}


def test_few_sets_of_costs_occur():
    walker, r = Walker(), random.Random(2)
    for _ in range(300):
        walker.through(bytes(r.randrange(9) for _ in range(60)), 0, walker.end)
    assert len(walker.vectors) < 100


def test_a_clean_conversation_is_left_alone(spark):
    turns = [(0, "system", "Be brief."), (1, "user", "Hi!"), (2, "assistant", "Hello.")]
    (row,) = repair(spark.createDataFrame([(1, *t, 9) for t in turns], "conv_id long, turn long, role string, text string, block int")).collect()
    assert row["audit"] == "KKK" and row["cost"] == 0 and [tuple(t) for t in row["turns"]] == [t[1:] for t in turns]


def test_edge_cases(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (2, None, "user", "x" * 300_000 + "."), (2, None, "user", "x" * 300_000 + "."), (3, 5, None, "a?"), (4, 1, "assistant", "only.")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r[0]: tuple(r)[1:] for r in digests(repair(turns), turns.unionByName(spark.createDataFrame([(7, 1, "user", "gone")], turns.schema))).collect()}
    full = {}
    for i, t, role, text in rows:
        full.setdefault(i, []).append((t, " " if role is None else role, " " if text is None else text))
    assert got == {i: plain(t) for i, t in full.items()} | {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert digests(repair(turns), turns).collect() == []


def damaged(rows):
    for conv, turn, role, text in rows:
        conv_, turn_ = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for _ in range(0 if kind == 0 else 2 if kind == 3 else 1):
            yield conv, turn, role, text


def test_damage(spark):
    rows = [(c, t, r, x) for c in (*range(30), None) for t in (*range(9), None) for r, x in (("assistant", "a. b! c?"), (None, None))]
    out = with_damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, damaged(rows)))


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    full = {r[0]: [] for r in rows}
    for conv, *turn in damaged(rows):
        full[conv].append(tuple(turn))
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_turn_repair"](spark, DATA).collect()}
    assert got == {k: plain(t) for k, t in full.items()}
