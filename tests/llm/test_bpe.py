from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer as Library

from tidemark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


@pytest.fixture(scope="module")
def encoder(tmp_path_factory):
    tokenizer = bpe.Tokenizer(PATH)
    words = ["the", "then", "hen", "tions", "it", "a", "été"]
    path = str(tmp_path_factory.mktemp("lexicon") / "arrays")
    bpe.write_arrays(bpe.compiled({w: tokenizer.merged(w) for w in words}), path)
    return bpe.Encoder(tokenizer, bpe.Lexicon(path))


HARD = [
    "", " ", "a", "Hello  World's", "<|endoftext|>", "x<|startoftext|>y <|endoftext|", "''ll 'LL 're's", "ΑΣ ΣΑΣ", "İI", "é é",
    "12 345", "日本語 テスト", "a\x1cb", "  x", "!!!???", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ﬁ Ⅷ ²", "\U0001f600 ok‍x",
]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(encoder, library, text):
    assert next(encoder.encode_batch([text])) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text(text):
    if not hasattr(test_any_text, "pair"):
        tokenizer = bpe.Tokenizer(PATH)
        lexicon = bpe.Lexicon.__new__(bpe.Lexicon)
        lexicon.read = {}
        for name, array in bpe.compiled({}).items():
            setattr(lexicon, name, array)
        test_any_text.pair = bpe.Encoder(tokenizer, lexicon), Library.from_file(PATH)
    own, library = test_any_text.pair
    assert next(own.encode_batch([text])) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("shape", ["{}", "a{}b", "'{}s", "e{}\u0301", "e{}\u0327"])
def test_every_code_point(encoder, library, shape):
    """Alone, within a word, after an apostrophe and between a letter and a mark; unassigned ones apart from others."""
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    odd = encoder.tokenizer.is_odd
    for points, size in (([c for c in every if not odd(c)], 2000), ([c for c in every if odd(c)], 20_000)):
        texts = ["\n".join(shape.format(c) for c in points[n : n + size]) for n in range(0, len(points), size)]
        wrong = [n for n, (text, ids) in enumerate(zip(texts, encoder.encode_batch(texts), strict=True)) if ids != library.encode(text, add_special_tokens=False).ids]
        assert not wrong, [hex(ord(c)) for c in points[wrong[0] * size :][:size] if next(encoder.encode_batch([shape.format(c)])) != library.encode(shape.format(c), add_special_tokens=False).ids]


def test_odd_texts_among_others(encoder, library):
    texts = ["plain a\u0558b \u1c89x <|endoftext|> \u0558", "plain", "x\U0001fae9y plain", "e\U00010efc\u0301", "e\u07fd\u0301"]
    assert list(encoder.encode_batch(texts)) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_automaton_is_minimal_and_numbers_words(encoder, tmp_path):
    words = sorted({f"{a}{b}tions" for a in "abc" for b in "xyz"} | {"ab", "b"})
    arrays = bpe.compiled({w: [i] for i, w in enumerate(words)})
    assert len(arrays["final"]) < sum(map(len, words)) // 3  # the endings are shared
    path = str(tmp_path / "words")
    bpe.write_arrays(arrays, path)
    lexicon = bpe.Lexicon(path)
    assert lexicon.numbers([w.encode() for w in words]).tolist() == list(range(len(words)))
    assert (lexicon.numbers([b"", b"a", b"axtion", b"axtionss", b"zz", "é".encode()]) == -1).all()
    assert [lexicon.entry(i) for i in range(len(words))] == [(i,) for i in range(len(words))]


def test_kept_chunks_are_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    texts = ["one two three four", "two five", "one six seven", ""]
    assert list(encoder.encode_batch(texts)) == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("words", [0, 500])
def test_round_trip(make, odd_rows, library, words):
    rows = [*odd_rows, (50, HARD[3]), (51, HARD[5])]
    found = sorted(map(tuple, bpe.round_trip_digests(make(rows), PATH, words=words).collect()), key=str)
    expected = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert found == sorted(expected, key=str)


def test_encode_then_decode(make, library):
    encoded = bpe.encode(make([(1, "The World"), (2, None)]), PATH)
    assert {r.doc_id: r.text for r in bpe.decode(encoded, PATH).collect()} == {1: "the</w> world</w>", 2: ""}


def test_empty_table(make):
    assert bpe.round_trip_digests(make([]), PATH).collect() == []


def test_frequent_words(make):
    docs = make([(i, "ones twos twos") for i in range(20)] + [(99, None)])
    shared = docs.sparkSession.sparkContext.broadcast(bpe.Tokenizer(PATH))
    assert bpe.frequent_words(docs.coalesce(1), "text", shared, 5) == ["twos", "ones"]
    assert np.all([len(w) for w in bpe.frequent_words(docs, "text", shared, 0)] == [])
