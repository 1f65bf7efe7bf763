import random

import public_tokenizers
import pytest
import sentencepiece
from tests.conftest import DATA

from orrery.llm import token_counts
from orrery.llm.queries import QUERIES
from orrery.llm.token_counts import Settings, Tokenizer, count_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.load(PATH)


def random_texts(seed, each):
    r = random.Random(seed)
    for alphabet in ("aab  bcdehlort\n\t ▁éß日\U0001f600.,0123", " \nx", "the and ", "a", "ab", "-=", "日本語", "\U0001f600\U0001f601", " ", "estion", "\x80é߀"):
        for _ in range(each):
            yield "".join(r.choice(alphabet) * r.choice((1, 1, 1, r.randint(1, 40))) for _ in range(r.randint(0, 200)))


@pytest.mark.parametrize("s", [Settings(64, 16), Settings(40, 6, 2)])
def test_spliced_counts_equal_the_library(spark, library, tokenizer, s):
    """Short chunks, so that many documents don't align at once, and some only as one chunk."""
    texts = list(random_texts(3, 25))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(df, tokenizer, s, keep=["doc_id"]).collect()}
    assert got == {i: len(library.encode(t)) for i, t in enumerate(texts)}


def test_overlaps_widen_only_where_chunks_do_not_align(spark, library, tokenizer, monkeypatch):
    cuts = []
    plain = token_counts._cut

    def counted(texts, chunk, overlap):
        cuts.append((chunk, overlap, texts.count()))
        return plain(texts, chunk, overlap)

    monkeypatch.setattr(token_counts, "_cut", counted)
    r = random.Random(8)
    texts = ["".join(r.choice(("tion ", "an ", "erer", "the ", "x")) for _ in range(4_000)), "e" * 9_001 + "n" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {x["doc_id"]: x["n_tokens"] for x in count_tokens(df, tokenizer, Settings(1_000, 10, 4)).collect()}
    assert out == {i: len(library.encode(t)) for i, t in enumerate(texts)}
    assert cuts[0] == (1_000, 10, 2) and all(n == 1 for _, _, n in cuts[1:]) and [c[:2] for c in cuts] == [(1_000 * 4**i, 10 * 4**i) for i in range(len(cuts))]


def test_a_document_is_encoded_by_many_rows(spark, tokenizer):
    texts = spark.createDataFrame([(5, "word " * 10_000)], "doc long, text string")
    chunks = token_counts._cut(texts, 1_000, 100).collect()
    assert len(chunks) == 56 and [c["start"] for c in chunks] == [900 * i for i in range(56)] and [c["final"] for c in chunks] == [False] * 55 + [True]


def test_neighbours_without_a_shared_token_are_not_counted(spark):
    rows = [(1, 0, False, 10, [], [5, 6], 0, 8), (1, 1, True, 4, [6, 7], [], 1, 4), (2, 0, False, 10, [], [5], 0, 9), (2, 1, True, 3, [8], [], 0, 3), (3, 0, True, 7, [], [], 0, 7)]
    encoded = spark.createDataFrame(rows, "doc long, no long, final boolean, n long, head array<long>, tail array<long>, head_from long, tail_from long")
    assert sorted(tuple(r) for r in token_counts.splice(encoded).collect()) == [(1, 12), (2, None), (3, 7)]


def test_settings_are_checked():
    for bad in ((100, 26), (100, 0), (100, 10, 1)):
        with pytest.raises(ValueError, match="overlap"):
            Settings(*bad)


def test_edge_cases(spark, library, tokenizer):
    texts = [None, "", " ", "<s> </s> [INST]", "\x00", "a" * 3_000, "日本" * 900, "\U0001f600" * 1_100, "▁ ▁", "word " * 5_000]
    rows = [(i if i else None, t, "kept", i) for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, doc string, `n.tokens` long")
    out = count_tokens(df, tokenizer, Settings(500, 50))
    assert out.columns == ["doc_id", "text", "doc", "n.tokens", "n_bytes", "n_tokens", "over_limit"]
    wanted = [(*r, len((r[1] or "").encode()), n, n > 4_096) for r in rows for n in [len(library.encode(r[1] or ""))]]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, wanted))


def test_results_replace_columns_of_their_name(spark, tokenizer):
    out = count_tokens(spark.createDataFrame([(1, "a b", 9.5)], "doc_id long, text string, N_Tokens double"), tokenizer)
    assert out.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"] and out.first()["n_tokens"] == 2


def test_empty_table(documents, tokenizer):
    assert count_tokens(documents([]), tokenizer).collect() == []


def test_query_equals_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_token_counts"](spark, DATA).collect()}
    counts = {i: len(library.encode(t)) for i, t in docs.items()}
    assert got == {i: (len(t.encode()), counts[i], counts[i] > 4_096) for i, t in docs.items()}
