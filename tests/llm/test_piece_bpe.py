import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from roadpulse.llm.piece_bpe import PieceBpe, code

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair():
    return PieceBpe(PATH), SentencePieceProcessor(model_file=PATH)


def _same(pair, texts):
    bpe, model = pair
    for text, got in zip(texts, bpe.encode_batch(texts), strict=True):
        want = [model.bos_id(), *model.encode(text), model.eos_id()]
        assert got.tolist() == want, text
        assert bpe.decode(got) == model.decode(want)


def test_chosen_texts(pair):
    _same(pair, ["", " ", "  a b ", "a\nb\n\n\nc", "\t x", "▁a", "ﬁ ﬂ", "a\0b", " x", "<s> hi </s>", "é é", " " * 333, "a" * 500, "ab" * 700,
                 "日本語のテキスト", "\U0001f600\U0001f9d1‍\U0001f680", "aaaa▁▁ ▁b", "the the the", "⁇", "x" + " " * 17 + "y"])


def test_documents(pair, documents, odd):
    _same(pair, [r.text or "" for r in documents.union(odd.select(documents.columns[:2]).selectExpr("doc_id", "text", "'' lang", "'' source", "0L n_chars")).collect()])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text(alphabet="abtheindo ▁\n.é", max_size=80)), min_size=1, max_size=6))
def test_any_text(texts):
    _same(_any_pair(), texts)


_made = []


def _any_pair():
    if not _made:
        _made.append((PieceBpe(PATH), SentencePieceProcessor(model_file=PATH)))
    return _made[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31_999), max_size=30))
def test_decoding_any_ids(ids):
    bpe, model = _any_pair()
    assert bpe.decode(np.array(ids, np.int64)) == model.decode(ids)


def test_query_rows(spark, odd, empty, pair):
    bpe, model = pair
    rows = code(odd, PATH).collect()
    assert len(rows) == odd.count() and code(empty, PATH).count() == 0
    want = {}
    for r in odd.collect():
        ids = [1, *model.encode(r.text or ""), 2]
        want.setdefault(r.doc_id, set()).add((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                              hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) in want[r.doc_id]
