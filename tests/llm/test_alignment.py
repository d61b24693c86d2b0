"""Alignment against a plain version that walks over each document token by token."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, normalizers

from tidemark.llm import alignment
from tidemark.llm.bpe import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
HARD = [
    " ", "  a  b  ", "a▁b c", "\n\n x\n y", "tab\t x", "é漢字😀 ok", "<|endoftext|> a <s>", "don't 'S x's", "=" * 300, "a  b c", "\x1c x", "a\x00b",
    "日本語テスト " * 30, "x" * 200 + " y",
]


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte = {c: i for i, c in enumerate(byte_letters())}
    a_bytes = {i: bytes(byte[c] for c in t) for t, i in a.get_vocab().items() if i < 50256}
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(len(b))]

    def groups(text):
        if not text:
            return []
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        spelled = [[a_bytes[i] for i in ids[0]], [b_bytes[i] for i in ids[1]]]
        if any(b"".join(s) != (" " + text).encode() for s in spelled):
            return []
        ends = []
        for s in spelled:
            at, own = 0, []
            for x in s:
                at += len(x)
                own.append(at)
            ends.append(own)
        out, i, j = [], 0, 0
        for end in sorted({*ends[0]} & {*ends[1]}):
            p, q = ends[0].index(end) + 1, ends[1].index(end) + 1
            out.append((ids[0][i:p], ids[1][j:q]))
            i, j = p, q
        return out

    def run(rows):
        found = [(i, groups(text)) for i, text in rows]
        links = [[(x, y) for p, q in g for x in p for y in q] for _, g in found]
        count = Counter(pair for own in links for pair in set(own))
        most = defaultdict(int)
        for (x, _), n in count.items():
            most[x] = max(most[x], n)
        out = []
        for (i, g), own in zip(found, links, strict=True):
            text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)
            out.append((
                i, sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g), len(own), hashlib.sha256(text.encode()).hexdigest() if g else "",
                sum(count[x] == most[x[0]] for x in own), sum(count[x] for x in own),
            ))
        return sorted(out, key=str), {(x, y): (n, n == most[x]) for (x, y), n in count.items()}, found

    return run


def found(df):
    order = "doc_id n_a n_b n_groups n_links groups_sha256 n_best count_sum".split()
    return sorted(map(tuple, df.select(*order).collect()), key=str)


@pytest.fixture(scope="module")
def rows(odd_rows):
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "the", "ing", "é", "=", "漢", "'s", "1", " ", "x"]
    mixed = ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(120)]
    return [*odd_rows, *((50 + i, t) for i, t in enumerate(HARD)), *((200 + i, t) for i, t in enumerate(mixed))]


@pytest.mark.parametrize(("chunk", "wide"), [(1 << 21, 256), (3000, 256), (8000, 1)])
def test_equals_the_plain_version(make, rows, plain, monkeypatch, chunk, wide):
    """Chunks that hold few documents, and parts of documents; wide groups with few and many links."""
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    monkeypatch.setattr(alignment, "PART", chunk // 4)
    monkeypatch.setattr(alignment, "BLOCK", 500)
    monkeypatch.setattr(alignment, "WIDE", wide)
    some = rows if chunk > 3000 else [r for r in rows if len(r[1] or "") < 5000]
    pair = alignment.Pair(A, B)
    expected = plain(some)[0]
    own, pairs = [], []
    for first, end in alignment.chunks_of([t for _, t in some]):
        columns, links = alignment.chunk_rows(pair, [t for _, t in some[first:end]])
        pairs += [(first + d, x, y, n) for d, x, y, n in zip(*(links[c].to_pylist() for c in ("doc", "a", "b", "n")), strict=True)]
        own += zip([i for i, _ in some[first:end]], *(columns[k].tolist() for k in ("n_a", "n_b", "n_groups")), columns["groups_sha256"], strict=True)
    assert sorted(own, key=str) == sorted(((e[0], *e[1:4], e[5]) for e in expected), key=str)
    per_doc = Counter()
    for d, _, _, n in pairs:
        per_doc[d] += n
    assert sorted((i, per_doc[d]) for d, (i, _) in enumerate(some) if i is not None) == sorted((e[0], e[4]) for e in expected if e[0] is not None)
    assert len({p[:3] for p in pairs}) == len(pairs)


def test_the_query_equals_the_plain_version(make, rows, plain):
    assert found(alignment.alignment_digests(make(rows).repartition(5), A, B)) == plain(rows)[0]


def test_pair_counts(make, rows, plain):
    got = {(r.a, r.b): (r.n, r.best) for r in alignment.pair_counts(make(rows), A, B).collect()}
    assert got == plain(rows)[1]


def test_align_gives_the_groups(make, plain):
    rows = [(i, t) for i, t in enumerate([*HARD, None, "", "the quick brown fox, jumped."])]
    got = {}
    for r in alignment.align(make(rows).coalesce(1), A, B).collect():
        groups = [([], []) for _ in range(max(r.a_group) + 1)]
        for ids, of, side in ((r.a, r.a_group, 0), (r.b, r.b_group, 1)):
            for i, g in zip(ids, of, strict=True):
                groups[g][side].append(i)
        got[r.doc_id] = groups
    assert got == {i: g for i, g in plain(rows)[2] if g}


def test_a_tokenizer_that_loses_bytes():
    """Sizes that do not add up are noticed, and the document has no tokens."""
    pair = alignment.Pair(A, B)
    pair.library.normalizer = normalizers.Lowercase()
    rows = ["all lower case", "Not All \n x", "İ"]
    columns, links = alignment.chunk_rows(pair, rows)
    assert [n > 0 for n in columns["n_a"].tolist()] == [True, False, False]
    assert set(links["doc"].to_pylist()) == {0}


@pytest.mark.parametrize("kept", [0, 2000, 16 << 20])
def test_cuts_kept_between_parts(rows, plain, monkeypatch, kept):
    """Part by part, with cuts given up and encoded again, documents have the same columns and links."""
    monkeypatch.setattr(alignment, "KEPT", kept)
    monkeypatch.setattr(alignment, "PART", 400)
    some = [r for r in rows if len(r[1] or "") < 5000]
    pair = alignment.Pair(A, B)
    expected = sorted((e[:6] for e in plain(some)[0]), key=str)
    for _ in range(2):
        got = []
        for at in range(0, len(some), 7):
            columns, links = alignment.chunk_rows(pair, [t for _, t in some[at : at + 7]])
            n_links = Counter()
            for d, n in zip(links["doc"].to_pylist(), links["n"].to_pylist(), strict=True):
                n_links[d] += n
            own = zip(*(columns[k].tolist() for k in ("n_a", "n_b", "n_groups")), columns["groups_sha256"], strict=True)
            got += [(some[at + d][0], *c[:3], n_links[d], c[3]) for d, c in enumerate(own)]
        assert sorted(got, key=str) == expected
        assert not kept or len(pair.known.words)


def test_cuts_are_encoded_once(monkeypatch):
    """What a worker has encoded it does not encode again in a later part, unless it is long or there is too much."""
    pair, encoded = alignment.Pair(A, B), []
    plainly = pair.encoded
    monkeypatch.setattr(pair, "encoded", lambda words: encoded.append(words.to_pylist()) or plainly(words))
    long = "y" * 100
    for text in (f"one two two {long}", f"two three {long} one"):
        alignment.chunk_rows(pair, [text])
    assert [sorted(e) for e in encoded] == [sorted([" one", " two", f" {long}"]), sorted([" three", f" {long}"])]
    monkeypatch.setattr(alignment, "KEPT", 150)
    encoded.clear()
    for text in ("a b c d e", "a f", "c f"):
        alignment.chunk_rows(pair, [text])
    assert encoded == [[" a", " b", " c", " d", " e"], [" f"], [" c"]]


def test_empty_table(make):
    assert found(alignment.alignment_digests(make([]), A, B)) == []
