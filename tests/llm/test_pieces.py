from __future__ import annotations

import hashlib
import random
from itertools import chain

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
HARD = [
    "", " ", "   ", "a", " a", "a ", "  a  b  ", "▁", "a▁b", "▁▁ x", "\n\n x", "a\x00b", "<s> </s> <unk> <0x41>", "é漢字😀", "﻿x",
    "=" * 700, "-=" * 900, "aaaaaaaaaaaaaaaaaaaaaaa", "ingtioningtion", " " * 600 + "x", "漢" * 1200, "日本語テスト" * 200,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.Model(PATH)


def encoded(model, texts):
    return [list(chain.from_iterable(words)) for words in pieces.Encoder(model).each(texts)]


@pytest.mark.parametrize("long", [4, 512])
def test_hard_texts(model, library, monkeypatch, long):
    monkeypatch.setattr(pieces, "LONG", long)
    assert encoded(model, HARD) == library.encode(HARD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("ab =-▁ething\n", max_size=60)), max_size=5))
def test_any_texts(texts):
    if not hasattr(test_any_texts, "pair"):
        test_any_texts.pair = pieces.Model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    model, library = test_any_texts.pair
    own = encoded(model, texts)
    assert own == library.encode(texts)
    assert [model.decode(ids) for ids in own] == [library.decode(ids) for ids in own]


@pytest.mark.parametrize("shape", ["{}", "a{}b"])
def test_every_code_point(model, library, shape):
    texts = [shape.format(chr(i)) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    own = encoded(model, texts)
    assert own == library.encode(texts)
    assert [model.decode(ids) for ids in own] == library.decode(own)


def test_any_ids_are_decoded_as_by_the_library(model, library):
    rng = random.Random(3)
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(300)]) for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids), ids


def test_a_merge_that_makes_a_pair_of_lower_rank_goes_first(model):
    """Ranks that fall when a piece grows, which the file at hand hardly has."""
    own = pieces.Model(PATH)
    names = ["a", "b", "ab", "aba", "abab"]
    ids = {n: i for i, n in enumerate(names)}
    rank = {"ab": 5, "aba": 2, "abab": 9}
    table = {(ids[p[:c]], ids[p[c:]]): (rank[p], ids[p]) for p in rank for c in range(1, len(p)) if p[:c] in ids and p[c:] in ids}
    keys = sorted(a << pieces.BITS | b for a, b in table)
    own.keys = pieces.np.array(keys)
    own.values = pieces.np.array([table[k >> pieces.BITS, k & (1 << pieces.BITS) - 1] for k in keys]) @ pieces.np.array([1 << pieces.BITS, 1])

    def one_by_one(word):
        s = [ids[c] for c in word]
        while found := [(table[p][0], i) for i, p in enumerate(zip(s, s[1:], strict=False)) if p in table]:
            i = min(found)[1]
            s[i : i + 2] = [table[s[i], s[i + 1]][1]]
        return s

    words = ["ab" * n + tail for n in range(1, 9) for tail in ("", "a", "b", "aab")]
    symbols = pieces.np.array([ids[c] for w in words for c in w])
    segment = pieces.np.repeat(pieces.np.arange(len(words)), [len(w) for w in words])
    got, of = own.merged(symbols, segment, (pieces.np.bincount(segment),))
    assert [got[of == i].tolist() for i in range(len(words))] == [one_by_one(w) for w in words]
    assert [own.merged_long(pieces.np.array([ids[c] for c in w])).tolist() for w in words] == [one_by_one(w) for w in words]


def test_kept_words_are_bounded(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 3)
    monkeypatch.setattr(pieces, "BLOCK", 8)
    texts = ["one two three four", "two five", "one six seven", "", "two one"]
    encoder = pieces.Encoder(model)
    assert [list(chain.from_iterable(w)) for w in encoder.each(texts)] == library.encode(texts)
    assert len(encoder.kept) <= 4 and len(encoder.older) <= 4


def test_round_trip(make, odd_rows, library):
    rows = [*odd_rows, *((50 + i, t) for i, t in enumerate(HARD))]
    found = sorted(map(tuple, pieces.round_trip_digests(make(rows), PATH).collect()), key=str)
    expected = []
    for i, text in rows:
        ids = library.encode(text or "")
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        expected.append((i, len(ids), *sums))
    assert found == sorted(expected, key=str)


def test_encode_then_decode(make, library):
    rows = [(1, " The  World\n"), (2, None), (3, "▁x"), (4, "é漢")]
    encoded_rows = pieces.encode(make(rows), PATH)
    assert {r.doc_id: list(r.ids) for r in encoded_rows.collect()} == {i: library.encode(t or "") for i, t in rows}
    assert {r.doc_id: r.text for r in pieces.decode(encoded_rows, PATH).collect()} == {1: " The  World\n", 2: "", 3: " x", 4: "é漢"}


def test_empty_table(make):
    assert pieces.round_trip_digests(make([]), PATH).collect() == []


def test_other_models_are_refused(tmp_path):
    with open(PATH, "rb") as f:
        data = f.read()
    changed = tmp_path / "changed.model"
    changed.write_bytes(data.replace(b"\x18\x02 \x80\xfa\x01", b"\x18\x01 \x80\xfa\x01"))  # not BPE
    with pytest.raises(ValueError):
        pieces.Model(str(changed))
