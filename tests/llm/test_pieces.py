import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from limnos.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")
MODEL = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
ODD = ["", " ", "  ", " a", "a ", "a  b", "\n", "a\n\nb  c\t d", "▁", "a▁b ▁▁ c", "日本語テキスト 😀😀 x", "x" * 3000, "ab" * 300 + " " * 50 + "end", "\x00a", "<s> </s> <unk> <0x0A>", "ﬁ é", "�", " " * 70, "né" * 100]


@pytest.fixture(scope="module")
def both():
    return pieces.Pieces(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def agree(both, text):
    own, lib = both
    ids = lib.encode(text)
    assert own.encode(text) == ids
    assert own.batch([text])[0][1] == own.decode(ids) == lib.decode(ids)
    if text:
        assert own.encode_long(pieces.MARK + text.replace(" ", pieces.MARK)) == ids


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_equal_the_library(both, text):
    agree(both, text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abet n\n▁éñ日<>s0xA", max_size=60))
def test_texts_equal_the_library(both, text):
    agree(both, text)


def test_bytes_that_are_no_text(both):
    own, lib = both
    for ids in ([3 + 0xC3], [3 + 0xC3, 3 + 0xA9], [3 + 0xFF, 300, 3 + 0xE6], [1, 300, 2]):
        assert own.decode(ids) == lib.decode(ids)


def test_the_table_of_segments_is_bounded(both, monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_SIZE", 10)
    own = pieces.Pieces(MODEL)
    for i in range(30):
        assert own.encode(f"number {i} of some") == both[1].encode(f"number {i} of some")
    assert len(own.table) <= 20


def test_whole_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert pieces.differences(docs, MODEL).count() == 0
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {}
    for r in docs.collect():
        ids = lib.encode(r["text"])
        want[r["doc_id"]] = (len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)), ids)
    assert {r["doc_id"]: tuple(r)[1:] for r in pieces.op9(spark, sf).collect()} == {k: v[:3] for k, v in want.items()}
    assert {r["doc_id"]: r["ids"] for r in pieces.encode(docs, MODEL).collect()} == {k: v[3] for k, v in want.items()}
