"""Ids by pieces equal ids of whole texts."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import tokens

PIECES = st.sampled_from(["word", " word", "don't", " I'll", ",", ".", "...", "'s", "'", " ", "  ", "\n", "\n\n", "\t",
                          " 12", "é", "ÉCLAIR", " naïve,", "中文", "\xa0", "\x1c", "<|endoftext|>", "a1b2", "&&&", "$$$",
                          "😀", " ", "´", "ª", "x.'s", "!?", "\r\n"])


@pytest.fixture(scope="module")
def enc():
    return tokens.Encoder(tokens.tokenizer_path())


@pytest.fixture(scope="module")
def plain():
    """The library's own object, as a user loads it."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokens.tokenizer_path())


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=25))
def test_pieces_equal_whole(enc, plain, parts):
    text = "".join(parts)
    assert enc.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_long_text_segments_and_cache_reset(enc, plain, monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT", 50)
    monkeypatch.setattr(tokens, "CACHE_PIECES", 7)
    text = " ".join(f"word{i}, again" for i in range(200)) + "\n\n  end"
    assert enc.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_special_strings_are_the_librarys(enc, plain):
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n", "<|endoftext", "it's <|endoftext|>. end"):
        assert enc.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert enc.encode("a <|endoftext|> b").tolist().count(50256) == 1


def test_null_and_empty(enc):
    assert enc.encode(None).tolist() == enc.encode("").tolist() == []
    assert enc.encode("").dtype == np.dtype("<u2")


def test_other_tokenizer_encodes_whole_texts():
    e = tokens.Encoder(tokens.tokenizer_path("word_bpe_49k.json"))
    assert not e.by_pieces
    assert e.encode("Some  TEXT here").tolist() == e.tok.encode("Some  TEXT here", add_special_tokens=False).ids


# White space of every width beside words, quotes beside letters, digits and marks, letters that are no Latin ones, odd
# characters and an added token.
EDGES = st.sampled_from([*" \t\n\r\x0b'.,-_aZ09éÉ×÷ªµßÿ²½", "'s", "'LL", "s'", ".'s", "1's", " '", "\x85", "\xa0", "\u1680",
                         "\u2003", "\u2028", "\u205f", "\u3000", "\u200b", "\x1d", "\x00", "\x7f", "e\u0301", "ж", "中",
                         "。", "’", "٣", "😀", " the", " and", "<|endoftext|>", "<|endo", "ftext|>"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(EDGES, max_size=12).map("".join)), max_size=8), st.integers(0, 3))
def test_many_texts_at_once_equal_whole(enc, plain, texts, skip):
    got = enc.encode_all(pa.array([None] * skip + texts, pa.string()).slice(skip))
    assert [x.tolist() for x in got] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_batches_in_small_segments(plain, monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT", 40)
    monkeypatch.setattr(tokens, "CACHE_PIECES", 9)
    enc = tokens.Encoder(tokens.tokenizer_path())
    texts = ["", "one two", None, " ".join(f"long{i}, text\u3000 {i}" for i in range(60)), "", "a <|endoftext|> b", "x \xa0 y" * 20,
             "no\u200bspace " * 9, "", "中文 字 " * 15, "end  "] * 2
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    got = list(enc.batches(iter([rows.slice(0, 0), rows.slice(0, 3), rows.slice(3, 1), rows.slice(4)]), 1))
    assert [b.num_rows for b, _ in got] == [0, 3, 1, len(texts) - 4]
    assert [x.tolist() for _, ids in got for x in ids] == [
        plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_each_distinct_piece_of_many_texts_is_looked_up_once(plain):
    enc = tokens.Encoder(tokens.tokenizer_path())
    asked, look_up = [], enc._look_up
    enc._look_up = lambda pieces: asked.append(pieces) or look_up(pieces)
    texts = ["the cat, the dog; the cat's 12 dogs.\n"] * 500
    got = enc.encode_all(pa.array(texts))
    assert got[0].tolist() == got[-1].tolist() == plain.encode(texts[0], add_special_tokens=False).ids
    assert len(asked) == 1 and len(asked[0]) == len(set(asked[0])) == 11
