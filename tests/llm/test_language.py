from __future__ import annotations

import math
import random
import zlib

import pytest

from tidemark.llm import language

PARTS = {"aa": "the ing tion er and wh".split(), "bb": "ich keit ß ö ung sch".split(), "cc": "é aux oi le que ç".split()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(180):
        lang = ("aa", "bb", "cc")[i % 3]
        text = " ".join("".join(rng.choices(PARTS[lang], k=rng.randint(1, 3))) for _ in range(25))
        out.append((i, text, lang))
    return out


def test_held_out_accuracy(make, rows):
    found = {r.doc_id: r for r in language.identify(make(rows)).collect()}
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in rows)
    held = [(found[i].lang_pred, lang) for i, _, lang in rows if found[i].held_out]
    assert len(held) > 30 and sum(a == b for a, b in held) == len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_held_out_labels_are_not_read(make, rows):
    """Wrong languages on held-out rows, and a language only they have, change nothing."""
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in rows]
    a, b = (sorted(map(tuple, language.identify(make(r)).collect())) for r in (rows, wrong))
    assert a == b


def test_odd_rows(make, rows, odd_rows):
    odd = [(i, t, None) for i, t in odd_rows] + [(900, "123 !!", "aa"), (901, "the thing and", None)]
    shifted = [(i + 1000, t, lang) for i, t, lang in rows]
    found = language.identify(make(shifted + odd)).collect()
    assert len(found) == len(shifted) + len(odd)
    by = {r.doc_id: r for r in found}
    assert [(by[i].lang_pred, by[i].score, by[i].rejected) for i in (1, 2, 3, 900)] == [("und", 0.0, True)] * 4
    assert by[901].lang_pred == "aa"
    assert not by[None].held_out


def test_nothing_to_learn(make):
    found = language.identify(make([(1, "abc", None)])).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)]
    assert language.identify(make([])).collect() == []


def test_far_texts_are_rejected(make, rows):
    found = {r.doc_id: r for r in language.identify(make([*rows, (5000, "xyzzy qqqq jjjj vvvv xkxk zjzj", None)])).collect()}
    assert found[5000].rejected and sum(r.rejected for r in found.values()) < 20


def test_clusters_split_a_language_of_two_kinds():
    x = language.vectors([language.counted(t) for t in ["abab abab", "abab ab", "zyzy zy", "zyzy zyzy"]], language.np.ones(language.DIMENSIONS, "f4"))
    c = language.clustered(x, 2)
    nearest = (x @ c.T).argmax(axis=1)
    assert nearest[0] == nearest[1] != nearest[2] == nearest[3]


def plain_vector(text, idf):
    """Weights of the hashed bigrams and trigrams of a text, gram by gram."""
    points, gap = [32], True
    for c in text.lower():
        if c.isalpha():
            points.append(ord(c))
        elif not gap or len(points) == 1:
            points.append(32)
        gap = not c.isalpha()
    points.append(32)
    m = 0xFFFFFFFF
    counts = {}
    for i in range(len(points) - 1):
        pair = (points[i] * 0x9E3779B1 + points[i + 1] * 0x85EBCA77) & m
        grams = [pair]
        if i + 2 < len(points):
            grams.append((pair * 0xC2B2AE3D + points[i + 2] * 0x27D4EB2F + 1) & m)
        for g in grams:
            g = ((g ^ (g >> 15)) * 0x2C1B3C6D) & m
            counts[g >> 20] = counts.get(g >> 20, 0) + 1
    weights = {k: math.log1p(n) * float(idf[k]) for k, n in counts.items()}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    return {k: w / norm for k, w in weights.items()}


def test_labels_scores_and_rejections_as_a_plain_version(make, rows):
    some = [*rows, (5000, "xyzzy qqqq jjjj vvvv", None), (5001, "the ich é", None), (5002, " a  1b\n\nC ", None)]
    docs = make(some)
    idf, centres, names, least = language.fitted(docs, "doc_id", "text", "lang", 400, 4)
    found = {r.doc_id: r for r in language.identify(docs).collect()}
    for doc_id, text, _ in some:
        vector = plain_vector(text, idf)
        cosines = [sum(w * float(c[k]) for k, w in vector.items()) for c in centres]
        best = max(range(len(names)), key=lambda i: (cosines[i], -i))
        runner_up = max((c for c, n in zip(cosines, names, strict=True) if n != names[best]), default=-1)
        if cosines[best] - runner_up > 1e-5:
            assert found[doc_id].lang_pred == names[best]
        assert abs(found[doc_id].score - max(0.0, min(1.0, cosines[best]))) < 1e-5
        if abs(cosines[best] - least[best]) > 1e-5:
            assert found[doc_id].rejected == (cosines[best] < least[best])


def test_equal_languages_tie_to_the_first(make, rows):
    """Two languages with the same texts: the one that sorts first is told."""
    same = make([(i, "one text", ("yy", "xx")[i % 2]) for i in range(40)])
    assert {r.lang_pred for r in language.identify(same).collect()} == {"xx"}


def test_a_language_with_most_rows(make, rows):
    """About per_language texts are read of each language, whatever its share."""
    hot = [(1000 + i, f"the thing {i} and wh", "aa") for i in range(3000)]
    found = {r.doc_id: r for r in language.identify(make([*rows, *hot]), per_language=40).collect()}
    held = [(found[i].lang_pred, lang) for i, _, lang in rows if found[i].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
