"""Token counts against the library that the vocabulary file belongs to."""

import helpers as H
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lapwise.llm import token_count

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def wanted(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


ODD = ["", " ", "  ", "a  b", "a \n b", "\n\n  x", "it's 're we'll  don't", "<|endoftext|>", "a<|endoftext|> b <|endoftext|>",
       "a" * 500, "日本語テキスト です", "a\x1cb \x1c c", "\x85y \x85 z", "🙂🙂 👍🏽", "１２３ ½ Ⅳ ²", "\t\tx\r\n y ", "a b  c   d    "]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert token_count.merger(PATH).count(text) == wanted(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t'sabtrevmdl.!é日1² \x1c<|endoftext>")) | st.characters(codec="utf-8"), max_size=40))
def test_any_text(text):
    assert token_count.merger(PATH).count(text) == wanted(text)


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(token_count, "CACHE_PIECES", 3)
    small = token_count.PairMerger(PATH)
    text = "the quick brown fox jumps over the lazy dog again and again " * 5
    assert small.count(text) == small.count(text) == wanted(text)


def test_rows(spark):
    rows = H.odd_rows()
    out = token_count.count_tokens(H.docs(spark, rows), PATH).collect()
    H.same(
        [tuple(r) for r in out],
        [(i, len((t or "").encode()), wanted(t or ""), wanted(t or "") > 1024) for i, t, _ in rows],
    )
    assert token_count.count_tokens(H.docs(spark, []), PATH).count() == 0
