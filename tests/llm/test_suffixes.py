from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import suffixes


def brute(rows, length):
    """Rows in order of id (nulls first), then text."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for s in bytes(gone).split(b"\0") if s)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(df, rows, length, gram):
    found = suffixes.without_repeats(df, length=length, gram=gram).selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)")
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, length)


@pytest.mark.parametrize("length, gram, seed", [(20, 8, 1), (12, 4, 2), (100, 32, 3)])
def test_shared_passages(make, prose, length, gram, seed):
    rng = random.Random(seed)
    pool = prose(12, words=30, seed=seed)
    rows = []
    for i in range(60):
        a, b = rng.choices(pool, k=2)
        cut = rng.randrange(len(a))
        rows.append((i, a[cut:] + rng.choice(["", " ", "x" * rng.randrange(40)]) + b[: rng.randrange(len(b))]))
    check(make(rows).repartition(5), rows, length, gram)


def test_a_passage_that_all_documents_share(make, prose):
    passage = prose(1, words=12, seed=8)[0]
    rows = [(i, f"{t} {passage} {t[::-1]}") for i, t in enumerate(prose(80, words=8, seed=9))]
    check(make(rows).repartition(6), rows, 40, 12)


def test_periodic_texts(make):
    rows = [(1, "ab" * 200), (2, "a" * 150), (3, "ab" * 40 + "c" + "a" * 90), (4, "é" * 70)]
    check(make(rows), rows, 50, 16)


def test_odd_rows(make, odd_rows):
    rows = [r for r in odd_rows if r[0] != 6]
    check(make(rows), rows, 100, 32)


def test_very_long_text(make, odd_rows):
    text = dict(odd_rows)[6]
    rows = [(1, text[:50_000]), (2, text)]
    check(make(rows), rows, 100, 32)


def test_pieces_of_long_texts(make, prose, monkeypatch):
    """Runs that are cut where a long text is cut in parts are still compared string by string."""
    text = prose(1, words=3000, seed=12)[0]
    blocks = list(suffixes.pieces([text.encode() * 30, b"", b"x" * 99, b"y" * 100], 100))
    strings = sum(max(len(p) - 99, 0) for b in blocks for _, _, p in b)
    assert strings == max(len(text.encode()) * 30 - 99, 0) + 1
    rows = [(1, text * 20), (2, "q" + text * 3)]
    check(make(rows), rows, 100, 32)


def test_empty(make):
    assert suffixes.suffix_query(make([])).collect() == []


def test_multikey_order():
    rng = np.random.default_rng(0)
    columns = [rng.integers(0, n, 500) for n in (5, 4, 3, 100)]
    order = suffixes.multikey_order(columns)
    rows = list(zip(*(c[order].tolist() for c in columns), strict=True))
    assert rows == sorted(rows) and sorted(order.tolist()) == list(range(500))


def test_sliding_minimum():
    x = np.random.default_rng(1).integers(0, 1000, 101).astype(np.uint64)
    for width in (1, 7, 50, 101):
        assert suffixes.sliding_minimum(x, width).tolist() == [x[i : i + width].min() for i in range(len(x) - width + 1)]


def test_equal_strings_have_equal_anchors(prose):
    text = prose(1, words=200, seed=3)[0].encode()
    a = suffixes.runs([(0, 0, text)], 100, 32)
    b = suffixes.runs([(0, 0, b"other words before it " + text)], 100, 32)
    whole = set(zip(a[3].tolist(), a[4].tolist(), strict=True))
    other = set(zip(b[3].tolist(), b[4].tolist(), strict=True))
    assert len(whole - other) <= 1  # the run that the edge cuts


def test_a_common_phrase_gives_no_row_for_each_string(make, prose, monkeypatch):
    """A line of 62 bytes with different surroundings in every document: its runs are open, none of their pieces."""
    line = prose(1, words=40, seed=8)[0][:62]
    rows = [(i, f"{t} {line} {t[::-1]}") for i, t in enumerate(prose(400, words=14, seed=9))]
    seen = {}
    inner = suffixes.staged
    monkeypatch.setattr(suffixes, "staged", lambda df, name: seen.setdefault(name, inner(df, name)))
    check(make(rows).repartition(6), rows, 100, 32)
    assert seen["repeated-runs"].where("code & 3 = 2").count() > 400
    assert seen["pieces"].count() > 1000 and seen["repeated-strings"].count() < 400


def test_strings_across_buckets(make, prose):
    """A passage of two strings' length that very many documents share: its strings lie at the edges of many buckets."""
    passage = prose(1, words=60, seed=3)[0][:200]
    rows = [(i, f"{t}{passage}{t[::-1]}") for i, t in enumerate(prose(300, words=9, seed=4))]
    check(make(rows).repartition(9), rows, 100, 32)
