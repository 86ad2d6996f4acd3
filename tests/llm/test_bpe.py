import tempfile
import unicodedata
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer as Library

from meterflow.llm import bpe, common
from meterflow.llm.transducer import Transducer, compile_words

from .conftest import AWKWARD, LONG

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Library.from_file(PATH)
TOKENIZER = bpe.Tokenizer(PATH)
TEXTS = ["", " ", "<|endoftext|> hi", "a<|startoftext|>b <|endoftext|>", "<|endoftext|><|endoftext|",
         "ΣΑΣ ΟΔΟΣ", "İstanbul ǅ", "x\x1cy\x85z\xa0w 've", "it's we'll 'street I'Ve", "é café",
         "12345 ½²", "A" * 3000 + "b" * 2000, "a\x1cB C\x1fd", "ab" * 500 + " x y", LONG]


def same(encoder, text):
    wanted = LIBRARY.encode(text, add_special_tokens=False).ids
    ids = encoder.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == wanted
    assert encoder.decode(ids) == LIBRARY.decode(wanted, skip_special_tokens=False)


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_same_as_the_library(text):
    same(bpe.Encoder(TOKENIZER, None), text)


LETTERS = st.characters(codec="utf-8", max_codepoint=0x24F).filter(
    lambda c: unicodedata.category(c) != "Cn")


@settings(max_examples=300, deadline=None)
@given(st.text(LETTERS, max_size=60))
def test_same_as_the_library_for_any_text(text):
    same(bpe.Encoder(TOKENIZER, None, kept=5), text)


def test_transducer():
    words = {b"": [], b"a": [1], b"ab": [2, 3], b"xab": [2, 3], b"xb": [9], "é".encode(): [7] * 40}
    with tempfile.TemporaryDirectory() as folder:
        compile_words(words, f"{folder}/t")
        found = Transducer(f"{folder}/t")
        assert len(found) == len(words)
        for word, numbers in words.items():
            assert found.get(word) == numbers
        for word in (b"b", b"abc", b"x", b"xa"):
            assert found.get(word) is None
        compile_words({}, f"{folder}/e")
        assert Transducer(f"{folder}/e").get(b"a") is None


def test_suffixes_are_shared():
    endings = [b"ing", b"ed", b"er", b"tion"]
    words = {bytes([97 + i, 98 + i]) + e: [i] for i in range(20) for e in endings}
    with tempfile.TemporaryDirectory() as folder:
        compile_words(words, f"{folder}/t")
        found = Transducer(f"{folder}/t")
        assert len(found.targets) < 60
        assert all(found.get(w) == n for w, n in words.items())


def digests(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return (len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_documents(make_docs, awkward, empty):
    for most in (0, 2, 1000):
        found = bpe.encode_digests(awkward, PATH, most).collect()
        wanted = sorted((r[0] or 0, *digests(r[1])) for r in AWKWARD)
        assert sorted((r.doc_id or 0, *r[1:]) for r in found) == wanted
    assert bpe.encode_digests(empty, PATH).count() == 0


def test_long_words_are_encoded_without_the_lexicon(make_docs, monkeypatch):
    monkeypatch.setattr(common, "LONGEST_WORD", 6)
    texts = ["short words and extraordinarily long ones", "extraordinarily " * 50, "ééé éééé"]
    docs = make_docs([(i, text) for i, text in enumerate(texts)])
    name = bpe.ship(docs.sparkSession, PATH)
    hot = common.frequent(bpe.word_counts(docs, name), 1000)
    assert {r.word for r in hot.collect()} and all(len(r.word.encode()) <= 6 for r in hot.collect())
    found = {r.doc_id: tuple(r[1:]) for r in bpe.encode_digests(docs, PATH).collect()}
    assert found == {i: digests(text) for i, text in enumerate(texts)}


def test_round_trip_column(make_docs):
    docs = make_docs([(1, "hello world"), (2, None)])
    rows = {r.doc_id: r.encoded for r in bpe.encode(docs, PATH).collect()}
    assert bpe.Encoder(TOKENIZER, None).decode(bytes(rows[1].ids)) == rows[1].decoded
    assert rows[1].decoded == "hello</w> world</w>" and bytes(rows[2].ids) == b""
