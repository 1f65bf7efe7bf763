import re

import public_tokenizers
import pytest
import sentencepiece
from tests.conftest import DATA

import corpus_pipeline
from orrery.llm.common import table
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_minhash import brute as brute_near

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The result of every stage over its predecessor's, as pandas frames."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), table(spark, DATA, "documents"), []
    out.append(("input", docs.toPandas()))
    for name, f in corpus_pipeline.STAGES:
        f(spark, docs, DATA).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append((name, docs.toPandas()))
    return out


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "sentencepiece"]


def test_columns(stages):
    for name, frame in stages[:-1]:
        assert list(frame.columns) == COLUMNS, name
    assert list(stages[-1][1].columns) == [*COLUMNS, "ids", "decoded"]


def test_toxicity_drops_what_it_scores(spark, stages):
    from orrery.llm.queries import op9_toxicity

    rejected = {r["doc_id"] for r in op9_toxicity(spark, DATA).where("predicted = 1").collect()}
    before, after = set(stages[0][1]["doc_id"]), set(stages[1][1]["doc_id"])
    assert before - after == rejected


def test_line_dedup(stages):
    before, after = stages[1][1], stages[2][1]
    wanted = sorted(x.rsplit(", ", 2)[0] for x in brute_lines(list(zip(before["doc_id"], before["text"], strict=True)), 20, 3))
    assert sorted(repr((i, t)) for i, t in zip(after["doc_id"], after["text"], strict=True)) == [x + ")" for x in wanted]
    assert (after["n_chars"] == after["text"].str.len()).all()


def test_near_duplicates(stages):
    before, after = stages[2][1], stages[3][1]
    groups = brute_near(list(zip(before["doc_id"], before["text"], strict=True)), 5, 80)
    assert sorted(after["doc_id"]) == sorted(i for i, (_, _, kept) in groups.items() if kept)


def test_decontamination(spark, stages):
    """Every pair of a text and an item aligned in full."""
    import numpy as np

    from orrery.llm.decontaminate import MATCH, Settings, smith_waterman

    before, after = stages[3][1], stages[4][1]
    s, code = Settings(), {}
    words = lambda t: np.array([code.setdefault(w, len(code)) for w in re.findall(rb"[0-9a-z\x80-\xff]+", t.encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))])
    items = [x for r in table(spark, DATA, "benchmark").collect() if len(x := words(r["text"])) >= s.n]
    wanted = set()
    for i, t in zip(before["doc_id"], before["text"], strict=True):
        text = words(t)
        for x in items:
            t_ = max(2 * s.similarity * len(x), MATCH * min(s.least_words, len(x)))
            if MATCH * np.isin(text, x).sum() >= t_ and smith_waterman(x, text)[0] >= t_:
                wanted.add(i)
    gone = set(before["doc_id"]) - set(after["doc_id"])
    assert gone <= wanted and len(wanted - gone) <= 0.1 * len(wanted) and len(wanted) > 2


def test_encoding(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before, after = stages[4][1], stages[5][1]
    assert sorted(before["doc_id"]) == sorted(after["doc_id"])
    for t, ids, decoded in zip(after["text"], after["ids"], after["decoded"], strict=True):
        assert list(ids) == library.encode(t) and decoded == t


def run_on(spark, tmp_path, docs, items=("some words that nobody uses in any text at all",), toxic=0):
    docs.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, toxic), (None, 0, 1)], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.mode("overwrite").parquet(str(tmp_path / "benchmark.parquet"))
    return corpus_pipeline.run(spark, str(tmp_path)).toPandas()


def test_run_and_odd_documents(spark, documents, tmp_path):
    rows = [(1, None, None), (2, "", "en"), (None, "a text without id", "en"), (None, "a text without id", "en"), (3, "same text here for all " * 5, "en"), (4, "same text here for all " * 5, "en"), (4, "same text here for all " * 5, "en"), (5, "w " * 60_000, "en")]
    out = run_on(spark, tmp_path, documents(rows, extra="score"), toxic=1)
    assert sorted(out["doc_id"].dropna()) == [1, 2, 3, 5] and len(out) == 5
    assert len(run_on(spark, tmp_path, documents([], extra="score"))) == 0


def test_rows_that_share_an_id(spark, documents, tmp_path):
    """Each row is judged by its own text: a copy of another document goes, a text of its own stays; of repeated rows one stays."""
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    item = " ".join(f"item{k}" for k in range(20))
    rows = [(1, a, "en"), (5, a, "en"), (5, b, "en"), (9, c, "en"), (9, c, "en"), (7, f"{item} {d}", "en"), (7, d, "en"), (None, f"x y z {item}", "en")]
    out = run_on(spark, tmp_path, documents(rows, extra="score"), [item])
    assert sorted((int(i), t) for i, t in zip(out["doc_id"], out["text"], strict=True)) == sorted([(1, a), (5, b), (9, c), (7, d)])


def test_columns_with_names_of_our_own(spark, tmp_path):
    names = ["n_lines", "kept_text", "n_dropped", "ids", "decoded", "score", "toxicity", "row", "key", "h1", "gone", "place", "component_id", "kept", "id", "t", "__text", "__0"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    line = "a line of some length that three documents hold"
    rows = [(k, f"{line}\nown words number {k}\n" + " ".join(f"w{k}x{j}" for j in range(30)), "en", "s", 1, *[f"mine {n}" for n in names]) for k in range(4)]
    out = run_on(spark, tmp_path, spark.createDataFrame(rows, schema))
    assert list(out.columns) == ["doc_id", "text", "lang", "source", "n_chars", *names, "ids_", "decoded_"]
    assert sorted(out["doc_id"]) == [0, 1, 2, 3] and all((out[n] == f"mine {n}").all() for n in names)
    assert [line in t for t in out.sort_values("doc_id")["text"]] == [False, False, False, True]
    assert (out["decoded_"] == out["text"]).all() and (out["n_chars"] == out["text"].str.len()).all()
