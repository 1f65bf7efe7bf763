import hashlib

import pytest
from pyspark.sql import functions as F

from orrery.llm.chat import Settings, digests, escape, escape_role, format_windows, read_back, unescape, unescape_role

SCHEMA = "conv_id long, turn long, role string, text string"


def hexed(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("text", ["", "plain", "<s></s>[INST] ok [/INST]", "<\\s>", "<\\\\/s>", "[\\INST]", "<", "</", "a<</s>", "\\", "\\n\n", "<s\n>", "[/INST", "é\U0001f600</s>"])
def test_escapes_are_reversible(spark, text):
    r = spark.range(1).select(escape(F.lit(text)).alias("e"), unescape(escape(F.lit(text))).alias("t"), escape_role(F.lit(text)).alias("re"), unescape_role(escape_role(F.lit(text))).alias("r")).first()
    assert r["t"] == r["r"] == text
    assert not any(m in r["e"] + r["re"] for m in ("<s>", "</s>", "[INST]", "[/INST]"))
    assert "\n" not in r["re"]


def test_windows(spark):
    rows = [(1, 0, "system", "be brief")]
    for k in range(40):
        rows += [(1, 2 * k + 1, "user", f"question {k} " * 3), (1, 2 * k + 2, "assistant", f"answer {k} </s> " * (k % 7))]
    rows += [(2, 0, "user", "x" * 5000), (2, 1, "assistant", "long " * 3000), (3, 0, None, None), (3, 0, None, None), (4, None, "assistant", ""), (None, 0, "user", "no id"), (5, 0, "system", "s" * 3000), (5, 1, "user", "u"), (5, 2, "assistant", "a")]
    rows += [(6, None, r, t) for r in ("user", "assistant", None) for t in ("b", "é1", "é2", "", "a" * 400, "ab", None)] + [(6, 0, "user", "numbered"), (7, 0, "assistant", "y" * 200_000)]
    s = Settings(budget=300, history_tokens=60, history_turns=2, block=8)
    windows = format_windows(spark.createDataFrame(rows, SCHEMA), s)
    got = {}
    for w in windows.collect():
        got.setdefault(w["conv_id"], []).append(w)
    assert len(got[1]) > 3
    cost = lambda t: (len(t.encode()) + 3) // 4 + 4
    for c, ws in got.items():
        turns = sorted(((r[1] is not None, r[1], r[2] or "", r[3] or "") for r in rows if r[0] == c))
        fresh = [t for w in sorted(ws, key=lambda w: w["span"]) for t in read_back(windows.where(F.col("conv_id").eqNullSafe(c) & (F.col("span") == w["span"]))).first()["turns"]]
        assert [(t["role"], t["text"]) for t in fresh] == [t[2:] for t in turns]  # each turn is new in exactly one window
        if c == 1:
            for w in ws:
                assert "[system]" in w["formatted"]
                assert w["n_context"] <= 3
                assert sum(cost(t.split("]\n", 1)[1]) for t in w["formatted"].split("</s>")[:-1]) <= s.budget
    d = {r["conv_id"]: r for r in digests(windows).collect()}
    for c in got:
        turns = sorted(((r[1] is not None, r[1], r[2] or "", r[3] or "") for r in rows if r[0] == c))
        lost = "".join(t[3] for t in turns if t[2] == "assistant")
        assert d[c]["n_turns"] == len(turns)
        assert d[c]["turns_sha256"] == hexed("".join(f"{t[2]}\n{t[3]}\n" for t in turns))
        assert (d[c]["loss_chars"], d[c]["loss_sha256"]) == (len(lost), hexed(lost))


def test_blocks_do_not_matter(spark):
    rows = [(1, k, "assistant" if k % 3 else "user", "w" * (k * 7 % 50)) for k in range(100)] + [(1, 5, "user", "tie"), (1, 5, "user", "tie")]
    turns = spark.createDataFrame(rows, SCHEMA)
    one, many = (sorted(map(repr, format_windows(turns, Settings(budget=120, history_tokens=30, block=b)).collect())) for b in (1024, 5))
    assert one == many


def test_tokens_from_a_column(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"text {k}", 100 if k != 3 else None) for k in range(12)]
    turns = spark.createDataFrame(rows, SCHEMA + ", n_tokens int")
    s = Settings(budget=400, history_tokens=0, history_turns=1, tokens="n_tokens")
    sizes = sorted((w["span"], w["n_turns"]) for w in format_windows(turns, s).collect())
    # Turns of 100 tokens (turn 3: 6, from its bytes) in spans of 400; one across a limit is a span of its own.
    assert sum(n for _, n in sizes) == 12 and max(n for _, n in sizes) == 4 and len(sizes) >= 3
    assert format_windows(turns, Settings(budget=400, history_tokens=0, history_turns=1)).count() == 1


def test_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert digests(format_windows(empty)).count() == 0
    extra = spark.createDataFrame([(1, 0, "assistant", "hi", "x", 3)], SCHEMA + ", formatted string, span int")
    assert digests(format_windows(extra)).first()["loss_chars"] == 2
