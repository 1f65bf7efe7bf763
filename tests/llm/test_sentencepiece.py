import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from orrery.llm.sentencepiece_bpe import Merger, Vocabulary, digests, encode_decode

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def merger():
    return Merger(Vocabulary.load(PATH))


def same(library, merger, texts):
    ids, offsets = merger.encode(texts)
    decoded = merger.decode(ids, offsets)
    for k, t in enumerate(texts):
        wanted = library.encode(t)
        assert ids[offsets[k] : offsets[k + 1]].tolist() == wanted
        assert decoded[k] == library.decode(wanted)


def test_odd_texts(library, merger):
    same(library, merger, ["", " ", "  ", "a  b ", " " * 100, "\n", "\n \n", " \n  x", "a" * 3000, "the" * 500, "<s> </s> <0x41> <unk>", "▁", "▁▁x ▁", "\x00\x01", "日本語 \U0001f600​", "éé", "\r\n\t", "ﬁＡⅫ"])


def test_random_texts(library, merger):
    r = random.Random(5)
    for alphabet in ("aab  bcdehlort\n\t ▁éß日\U0001f600.,0123", " \nx", "the and "):
        same(library, merger, ["".join(r.choice(alphabet) for _ in range(r.randint(0, 80))) for _ in range(1500)])


def test_long_runs_go_through_the_rounds(library, merger):
    """Long runs of equal characters and short cycles, without a space: merges that make pairs which go first."""
    runs = [c * 10_000 for c in " aeo-=_.*#/\\0é日▁\n\t"] + [c * 3_001 for c in ("ab", "aab", "the", "  a", "-=", "an", "na", "erer", "1212", "=-=", "oo0", "|-", "éa", "ss s")]
    same(library, merger, runs)
    r = random.Random(9)
    for alphabet in ("a", "ab", "-=", " ", "aA", "es", "0", "=_", "oO", "in", "er", "ton"):
        same(library, merger, ["".join(r.choice(alphabet) * r.randint(1, 300) for _ in range(12)) for _ in range(40)])
        same(library, merger, ["".join(r.choice(alphabet) for _ in range(600)) for _ in range(20)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    library, merger = sentencepiece.SentencePieceProcessor(model_file=PATH), _shared()
    same(library, merger, texts)


_kept: list = []


def _shared():
    if not _kept:
        _kept.append(Merger(Vocabulary.load(PATH)))
    return _kept[0]


def test_cache_starts_anew(library, merger, monkeypatch):
    monkeypatch.setattr("orrery.llm.sentencepiece_bpe.CACHE_SEGMENTS", 10)
    for k in range(5):
        same(library, merger, [f"word{k}{j} and more" for j in range(20)])
    monkeypatch.setattr("orrery.llm.sentencepiece_bpe.CACHE_SEGMENTS", 1 << 20)
    monkeypatch.setattr("orrery.llm.sentencepiece_bpe.CACHE_CHARS", 5_000)
    for k in range(6):
        same(library, merger, [f"{k}x" * 2_000, "short"])
        assert merger.chars < 20_000


def test_documents(spark, documents, library):
    rows = [(1, "the cat\nsat", "en"), (2, None, None), (3, "", "en"), (None, "x", "en"), (1, "the cat\nsat", "en"), (4, "long text " * 40_000, "en")]
    docs = documents(rows, extra="ids")
    out = encode_decode(docs, Vocabulary.load(PATH))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "decoded"]
    for r in out.collect():
        assert list(r["ids"]) == library.encode(r["text"] or "") and r["decoded"] == (r["text"] or "")
    for r in digests(out).where("doc_id = 1").collect():
        ids = library.encode("the cat\nsat")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(b"the cat\nsat").hexdigest()
    assert encode_decode(documents([]), Vocabulary.load(PATH)).count() == 0


def test_decodes_byte_pieces(library, merger):
    ids = library.encode("日\U0001f600͸")
    assert merger.decode(np.array(ids, np.int32), np.array([0, len(ids)])) == [library.decode(ids)]
