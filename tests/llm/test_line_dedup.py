import re

import pytest

from orrery.llm.line_dedup import LineRuns, _in_order, dedup_lines


def brute(rows, least_chars, least_docs):
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < least_docs or max(holders[key(x)]) == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(map(repr, out))


A, B, C = "This line is shared by many", "another line with ÄÖÜ in it", "x" * 20
ROWS = [
    (1, f"{A}\nown line of the first document\n{A}"),
    (2, f"  {A.upper()}\t\nshort\n{B}"),
    (3, f"{A}\r\n\n{B}\n{C}\n"),
    (4, B + "\x0b"),
    (5, None),
    (6, ""),
    (7, "\n\n"),
    (8, f"{C}\n" * 400 + "end"),
    (9, C),
    (9, C),  # a repeated row is one holder
    (9, f"{A}\nother text of the same id"),
    (None, f"{A}\n{B}"),
    (-3, f"{B} \nÄÖÜ" + "y" * 30),
    (10, "z" * 50_000),
]


@pytest.mark.parametrize(("batches", "fanout", "least_docs"), [(4, 2, 3), (1, 2, 3), (7, 3, 2)])
def test_equals_brute_force(spark, documents, batches, fanout, least_docs):
    docs = documents([(i, t, "en") for i, t in ROWS], extra="n_lines")
    out = dedup_lines(docs, batches=batches, fanout=fanout, least_docs=least_docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept_text", "n_lines", "n_dropped"]
    assert sorted(repr((r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"])) for r in out.collect()) == brute(ROWS, 20, least_docs)


def test_levels(spark):
    store = LineRuns(spark, fanout=2)
    for b in range(5):
        store.add(spark.createDataFrame([(k, k, 100 - 10 * b + d) for k in range(b, 3 + b) for d in range(k + 1)] * 2, "h1 long, h2 long, id long"))
    assert [len(x) for x in store.levels] == [1, 0, 1]
    got = sorted((r["h1"], r["n_docs"], r["top"]) for r in LineRuns.merged(store.tables()).collect())
    first = {k: max(0, k - 2) for k in range(7)}  # the batch that brings a key, with the largest id
    assert got == [(k, (k + 1) * len([b for b in range(5) if b <= k < 3 + b]), 100 - 10 * first[k] + k) for k in range(7)]
    store.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("orrery_run_")]


def test_runs_are_neither_shuffled_nor_sorted(spark):
    """In the join of a batch and in a merge the runs come as they are; only the batch itself is shuffled and sorted."""
    store = LineRuns(spark, fanout=3)
    batch = lambda b: spark.createDataFrame([(k, k, 100 - b) for k in range(50)], "h1 long, h2 long, id long")
    store.add(batch(0))
    store.add(batch(1))
    with _in_order(spark):
        merge = LineRuns.merged(store.tables())
        plan = merge._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and "Exchange" not in plan and not re.search(r"\bSort\b", plan)
        join = store.joined(batch(2))
        join.collect()
        plan = join._jdf.queryExecution().executedPlan().toString()
        plan = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
        runs = [x for x in plan.split("\n") if "orrery_run_" in x and "Scan" in x]
        assert len(runs) == 2 and plan.count("SortMergeJoin") == 2
        at = [i for i, x in enumerate(plan.split("\n")) if "orrery_run_" in x and "Scan" in x]
        lines = plan.split("\n")
        depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
        for i in at:  # from the scan up to its join
            above, level = [], depth(lines[i])
            for x in reversed(lines[:i]):
                if depth(x) < level:
                    above.append(x)
                    level = depth(x)
                    if "SortMergeJoin" in x:
                        break
            assert not any(re.search(r"\bSort \[|Exchange", x) for x in above)
    store.close()


def test_feed_keeps_the_first(spark):
    store, seen = LineRuns(spark, fanout=2), set()
    for b in range(5):
        keys = [k % (7 + 3 * b) for k in range(5 * b, 5 * b + 12)]
        fresh = store.admit(spark.createDataFrame([(k, k, 100 * b + j) for j, k in enumerate(keys)], "h1 long, h2 long, id long"))
        assert sorted((r["h1"], r["id"]) for r in fresh.collect()) == sorted((k, 100 * b + j) for j, k in enumerate(keys) if k not in seen)
        seen |= set(keys)


def test_empty(documents):
    assert dedup_lines(documents([])).count() == 0


def test_no_python_on_the_main_path(spark, documents):
    out = dedup_lines(documents([(1, "a", "en")]))
    plan = out._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
