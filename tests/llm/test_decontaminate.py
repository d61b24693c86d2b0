from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import decontaminate as d


def brute_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@given(st.lists(st.integers(0, 4), max_size=30), st.lists(st.integers(0, 4), max_size=40))
def test_common_subsequence(a, b):
    assert d.common_subsequence(d.places_of(a, 4), len(a), b) == brute_common(a, b)


def test_words():
    data = d.folded(pa.array(["Ab é-x\nÉ ab1 "]))[0]
    words, start = d.word_hashes(data)
    assert len(words) == 5 and start.tolist() == [0, 3, 6, 8, 11]
    assert words[0] == d.word_hashes(b"xx ab")[0][1] != words[4] and words[1] == words[3]


@pytest.fixture(scope="module")
def items(prose, spark):
    rng = random.Random(2)
    texts = [" ".join(t.split()[: rng.choice([8, 18, 30, 45, 60, 90, 150])]) for t in prose(40, words=150, seed=21)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(90, None), (91, ""), (92, " .. "), (None, "x y z"), (3, texts[3])]
    return texts, spark.createDataFrame([(*r, "c") for r in rows], "item_id long, text string, id string")


def planted(texts, prose):
    rng = random.Random(3)
    rows, truth = [], set()
    for i, clean in enumerate(prose(120, words=200, seed=22)):
        words = clean.split()
        if i % 2 == 0:
            item = i // 2 % len(texts)
            passage = texts[item].split()
            if i % 4 == 0 and len(passage) > 15:  # a paraphrase: one word in twelve is another
                passage = [w if rng.random() > 1 / 12 else "zzz" for w in passage]
            at = rng.randrange(len(words))
            words[at:at] = [w.upper() if i % 6 == 0 else w for w in passage]
            truth.add((i, item))
        rows.append((i, " ".join(words)))
    return rows, truth


def test_verbatim_and_paraphrased(make, items, prose):
    texts, benchmark = items
    rows, truth = planted(texts, prose)
    found = d.contaminated(make(rows), benchmark, rank=32, sample_docs=20).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    short = list(enumerate(texts))
    assert {p for p in truth if p[0] % 4} <= pairs  # verbatim ones are all there
    assert pairs == brute_pairs([(i, t) for i, t in rows if i in {x for x, _ in truth}], short)
    assert {i for i, _ in pairs} <= {i for i, _ in truth}


def test_blocks_give_the_same(make, items, prose):
    texts, benchmark = items
    rows, truth = planted(texts, prose)
    verbatim = {(i, n) for i, n in truth if i % 4}
    found = {(r.doc_id, r.item_id) for r in d.contaminated(make(rows), benchmark, block=12, rank=16, sample_docs=20).collect()}
    assert verbatim <= found and {i for i, _ in found} <= {i for i, _ in truth}


def test_clean_rows_stay_with_their_columns(make, items, prose, odd_rows):
    texts, benchmark = items
    rows, truth = planted(texts, prose)
    odd = [(i if i is None else i + 5000, t) for i, t in odd_rows]
    docs = make(rows + odd)
    kept = d.decontaminated(docs, benchmark, rank=32, sample_docs=20)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str)
    bad = {i for i, _ in brute_pairs([(i, t) for i, t in rows if i in {x for x, _ in truth}], list(enumerate(texts)))}
    assert not set(ids) & bad and len(bad) > 55
    assert sorted((i for i in ids if i not in bad), key=str) == sorted((i for i, _ in rows + odd if i not in bad), key=str)


def test_an_answer_that_is_missing(make, items):
    texts, benchmark = items
    item = next(t for t in texts if len(t.split()) == 60)
    words = item.split()
    df = make([(1, item), (2, " ".join(words[:46] + ["other"] * 14))])
    assert {r.doc_id for r in d.contaminated(df, benchmark, rank=32, sample_docs=2).collect()} == {1}


def test_empty_tables(make, items, spark):
    texts, benchmark = items
    assert d.contaminated(make([]), benchmark).collect() == []
    assert d.contaminated(make([(1, texts[0])]), benchmark.limit(0)).collect() == []
    assert d.decontaminated(make([(1, texts[0])]), benchmark.limit(0)).count() == 1


def test_latent_space_holds_the_items(make, items):
    """With as many dimensions as parts, projecting an item loses nothing."""
    texts, _ = items
    block = d.Items(list(enumerate(texts)))
    docs = make([(1, texts[0])]).selectExpr("doc_id AS id", "text")
    idf = np.ones(len(block.terms))
    basis = d.latent_space(d.sampled_passages(docs, 5), block, idf, len(block.parts) + 5)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-8)
    x = np.bincount(block.term_of(block.words[5]), minlength=len(idf)).astype(float)
    assert np.linalg.norm(basis.T @ x) > 0.98 * np.linalg.norm(x)


def common(a, b):
    numbers = {w: n for n, w in enumerate(dict.fromkeys(a), start=1)}
    return d.common_subsequence(d.places_of([numbers[w] for w in a], len(numbers)), len(a), [numbers.get(w, 0) for w in b])


def brute_pairs(docs, items, least=0.7):
    """Pairs with a stretch (an item and its length to both sides, as the checks see it) that passes."""
    out = set()
    for doc, text in docs:
        own = d.word_hashes(text.casefold().encode())[0].tolist()
        for item, passage in items:
            words = d.word_hashes(passage.casefold().encode())[0].tolist()
            answer = words[-max(1, len(words) // 4) :]
            room = 2 * len(words) + max((s for s, step in zip(d.REACH, d.REACHED, strict=True) if s + step - 1 <= len(words)), default=8)
            for s in range(max(1, len(own) - room + 1)):
                around = own[s : s + room]
                if common(words, around) / len(words) >= least and common(answer, around) >= least * len(answer):
                    out.add((doc, item))
                    break
    return out


def paraphrased(prose, replaced, passages):
    rng = random.Random(int(replaced * 10))
    common = " ".join(t for _, t in passages).split()
    rows = []
    for i, text in enumerate(prose(64, words=120, seed=32)):
        words = text.split()
        copy = [w if rng.random() >= replaced else rng.choice([f"new{i}", rng.choice(common)]) for w in passages[i % 16][1].split()]
        at = rng.randrange(len(words))
        rows.append((i, " ".join(words[:at] + copy + words[at:])))
    return rows


@pytest.fixture(scope="module")
def passages(prose):
    rng = random.Random(1)
    return [(i, " ".join(t.split()[: rng.choice([11, 14, 24, 40, 54])])) for i, t in enumerate(prose(16, words=60, seed=31))]


@pytest.mark.parametrize("replaced", [0.1, 0.2, 0.3])
def test_paraphrases_as_brute_force(make, prose, spark, passages, replaced):
    rows = paraphrased(prose, replaced, passages)
    truth = brute_pairs(rows, passages)
    benchmark = spark.createDataFrame(passages, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.contaminated(make(rows), benchmark, rank=16, sample_docs=20).collect()}
    assert len(truth) > 15 and found == truth


@pytest.mark.parametrize("replaced", [0.1, 0.2, 0.3])
def test_the_latent_space_alone_finds_nine_in_ten(make, prose, spark, passages, replaced):
    """With fewer dimensions than items, and without the index of rare words."""
    rows = paraphrased(prose, replaced, passages)
    truth = brute_pairs(rows, passages)
    benchmark = spark.createDataFrame(passages, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.contaminated(make(rows), benchmark, rank=12, sample_docs=20, index=False).collect()}
    assert found <= truth and len(found) >= 0.9 * len(truth)


def test_given_items_are_found_by_the_latent_space_alone(spark, sf_dir):
    """The items of the tables with every fifth word of another document, within other documents."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("n_chars between 300 and 3000").orderBy("doc_id").limit(100).collect()
    rng, rows = random.Random(4), []
    others = " ".join(r.text for r in docs).split()
    for n, r in enumerate(benchmark.orderBy("item_id").collect()):
        copy = [w if rng.random() >= 0.2 else rng.choice(others) for w in r.text.split()]
        host = docs[n % len(docs)].text.split()
        at = rng.randrange(len(host))
        rows.append((n, " ".join([*host[:at], *copy, *host[at:]]), "en", "s", 1))
    planted = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    pairs = [{(r.doc_id, r.item_id) for r in d.contaminated(planted, benchmark, index=index).collect()} for index in (True, False)]
    assert len(pairs[0]) > 0.5 * len(rows) and pairs[1] <= pairs[0] and len(pairs[1]) >= 0.9 * len(pairs[0])


def test_blocks_in_several_passes(make, items, prose, monkeypatch):
    monkeypatch.setattr(d, "GROUP", 2)
    texts, benchmark = items
    rows, truth = planted(texts, prose)
    found = {(r.doc_id, r.item_id) for r in d.contaminated(make(rows), benchmark, block=9, rank=8, sample_docs=20).collect()}
    assert found == brute_pairs([(i, t) for i, t in rows if i in {x for x, _ in truth}], list(enumerate(texts)))


def test_an_item_in_a_third_of_the_documents(make, prose, spark):
    """Copies with a word changed are all found, however often the item's words occur by that."""
    item = " ".join(prose(1, words=15, seed=41)[0].split())
    rows = []
    for i, text in enumerate(prose(300, words=60, seed=42)):
        words = text.split()
        if i % 3 == 0:
            copy = item.split()
            copy[i // 3 % 11] = f"other{i}"
            words[20:20] = copy
        rows.append((i, " ".join(words)))
    others = list(enumerate(prose(10, words=30, seed=43), start=1))
    benchmark = spark.createDataFrame([(0, item), *others], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.contaminated(make(rows), benchmark, rank=4, sample_docs=20).collect()}
    assert found == {(i, 0) for i in range(0, 300, 3)}


def dense_products(passages, idf):
    """AᵀA with a row of length 1 for each passage."""
    a = np.array([np.bincount(p, minlength=len(idf)) * idf for p in passages])
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    return a.T @ a


def test_products_of_passages_that_repeat_terms():
    rng = np.random.default_rng(5)
    idf = rng.random(7) + 0.2
    passages = [rng.integers(0, 7, n) for n in (1, 2, 2, 5, 32, 32, 9)]
    out = np.zeros((7, 7))
    d.add_products(out, np.concatenate(passages), np.array([1, 2, 0, 2, 5, 32, 32, 9]), idf)
    assert np.allclose(out + out.T, dense_products(passages, idf))


def test_the_space_is_fitted_to_all_documents(make, items, prose, monkeypatch):
    """Without a number of documents, each passage of each document that has a word of the items counts."""
    texts, benchmark = items
    seen = []
    inner = d.products

    def noted(passages, block, idf):
        gram, n = inner(passages, block, idf)
        seen.append((block, idf, gram.copy(), n))
        return gram, n

    monkeypatch.setattr(d, "products", noted)
    rows = [(i % 600, f"{texts[i % 40]} w{i} " + "other " * (i % 40)) for i in range(700)] + [(None, texts[0]), (5, None), (6, "")]
    d.contaminated(make(rows), benchmark, rank=8).count()
    [(block, idf, gram, n)] = seen
    passages = []
    for _, text in rows:
        words = d.word_hashes((text or "").casefold().encode())[0]
        known = [block.term_of(words[at : at + d.PASSAGE]) for at in range(0, len(words), d.PASSAGE)]
        passages += [t[t >= 0] for t in known if (t >= 0).any()]
    assert n == len(passages) > 700
    assert np.allclose(gram + gram.T, dense_products(passages, idf), rtol=1e-4, atol=1e-4)


def test_no_matrix_of_terms_comes_to_the_driver(make, items, prose, monkeypatch):
    """What the driver gathers for the latent space has a row as short as the basis for each term, and is the product."""
    texts, _ = items
    block = d.Items(list(enumerate(texts)))
    terms, rank = len(block.terms), 4
    docs = make([(i, f"{texts[i % 40]} {t}") for i, t in enumerate(prose(80, words=50, seed=41))]).select("text")
    idf = np.random.default_rng(6).random(terms) + 0.2
    counted = d.counted_passages(docs, block).where("words IS NOT NULL")
    gathered = []
    inner = type(docs).collect

    def noted(self):
        rows = inner(self)
        gathered.append(sum(len(x) if isinstance(x, bytes | bytearray) else 8 for r in rows for x in r))
        return rows

    monkeypatch.setattr(type(docs), "collect", noted)
    basis = d.latent_space(counted, block, idf, rank)
    monkeypatch.undo()
    assert basis.shape == (terms, rank) and 3 <= len(gathered)
    assert max(gathered) <= 8 * terms * (rank + d.EXTRA) + 16 * terms < 4 * terms * terms / 4

    monkeypatch.setattr(d, "SLICE", 8 * 4 * terms)  # many slices, of 8 rows
    gram, n = d.products(counted, block, idf)
    passages = [block.term_of(np.array(r.words, dtype=np.int64).view(np.uint64)) for r in counted.collect()]
    some = np.random.default_rng(8).standard_normal((terms, 5))
    assert n == len(passages) and np.allclose(gram.times(some), dense_products(passages, idf) @ some, rtol=1e-4, atol=1e-3)
    own = [block.term_of(p) for _, p, _ in block.parts]
    more = np.concatenate(own), np.array([len(t) for t in own]), idf, np.float32(0.5)
    both = dense_products(passages, idf) + dense_products(own, idf) / 2
    assert np.allclose(gram.times(some, more), both @ some, rtol=1e-4, atol=1e-3)

    gram, n = d.products(counted.limit(0), block, idf)  # the items count without any passage of a document
    assert n == 0 and not gram.times(some).any()
    assert np.allclose(gram.times(some, more), dense_products(own, idf) @ some / 2, rtol=1e-4, atol=1e-3)


def test_a_half_is_made_whole():
    half = np.triu(np.random.default_rng(9).random((23, 23)))
    whole = half.copy()
    d.made_whole(whole, 5)
    assert np.array_equal(whole, half + half.T)


@given(st.lists(st.sampled_from([0, 1, 2**63, 2**64 - 1, *range(2**60, 2**60 + 9)]), max_size=9, unique=True), st.integers(0, 40))
def test_terms_are_numbered_in_their_order(some, more):
    spread = d.mixed(np.arange(more, dtype=np.uint64))
    terms = np.unique(np.concatenate([np.array(some, dtype=np.uint64), spread]))
    words = np.concatenate([terms, terms + np.uint64(1), terms - np.uint64(1), np.array([0, 2**64 - 1], dtype=np.uint64)])
    number = {t: n for n, t in enumerate(terms.tolist())}
    assert d.Terms(terms).term_of(words).tolist() == [number.get(w, -1) for w in words.tolist()]


@pytest.fixture(scope="module")
def finder(prose):
    """A finder whose space holds every item whole, and its items' texts."""
    texts = [*(t for n in (16, 20, 24, 40, 56) for t in prose(4, words=n, seed=50 + n)), "one one two one three two one two one one two one"]
    block = d.Items(list(enumerate(texts)))
    rng = np.random.default_rng(3)
    return d.Finder(block, rng.random(len(block.terms)) + 0.5, np.eye(len(block.terms)), 0.6, 0.7), texts


def test_words_of_stretches_are_counted_as_one_by_one(finder, monkeypatch):
    monkeypatch.setattr(d, "STRETCHES", 300)
    block, rng = finder[0].items, np.random.default_rng(4)
    term = rng.integers(-1, len(block.terms) + 1, 500)
    item = rng.integers(0, len(block.words), 400)
    for n in range(0, 500, 100):  # an item with its words in another order
        own = block.term_of(block.words[n // 100 * 4])
        term[n : n + len(own)] = rng.permutation(own)
    low = rng.integers(0, 480, 400)
    low[:20], item[:20] = np.repeat(np.arange(0, 500, 100), 4), np.repeat(np.arange(0, 20, 4), 4)
    high = np.minimum(low + rng.integers(1, 120, 400), 500)
    want = []
    for a, b, i in zip(low, high, item, strict=True):
        own, there = (np.bincount(x[x >= 0], minlength=len(block.terms) + 1) for x in (block.term_of(block.words[i]), term[a:b]))
        want.append(np.minimum(own, there).sum() >= finder[0].need[i])
    got = finder[0].enough(term, low, high, item)
    assert got.tolist() == want and 0 < sum(want) < 400
    assert finder[0].enough(term, low[:0], high[:0], item[:0]).tolist() == []


def test_windows_between_other_words_have_their_cosine(finder):
    """Those of an item's words in clusters, with words that no item has in between."""
    f, rng = finder[0], np.random.default_rng(5)
    term = np.full(1200, -1)
    for n, words in enumerate(f.items.words):
        own = f.items.term_of(words)
        term[n * 57 : n * 57 + len(own)] = np.where(rng.random(len(own)) < 0.1, -1, own)
    found = 0
    padded = np.concatenate([term, np.full(200, -1)])
    for first, item, cosine, size in f.candidates(term):
        for at, i, c in zip(first, item, cosine, strict=True):
            window, own = (f.project[x].sum(axis=0, dtype=np.float64) for x in (padded[at : at + size], f.items.term_of(f.items.words[i])))
            assert c == pytest.approx(window[:-1] @ own[:-1] / np.sqrt(window[-1] * own[-1]) * own[-1] / (own[:-1] @ own[:-1]), rel=1e-4)
            found += 1
    assert found > len(f.items.words)


class Noting(np.ndarray):
    """An array that notes how many of its rows are asked for."""

    rows: list[int] = []

    def __getitem__(self, at):
        if isinstance(at, np.ndarray):
            self.rows.append(len(at))
        return np.asarray(self)[at]


def test_words_outside_of_windows_are_not_projected(finder, monkeypatch):
    f, texts = finder
    monkeypatch.setattr(Noting, "rows", [])
    monkeypatch.setattr(f, "project", f.project.view(Noting))
    term = np.full(40000, -1)
    own = f.items.term_of(f.items.words[19])
    term[20000 : 20000 + len(own)] = own
    assert any((item == 19).any() for _, item, _, _ in f.candidates(term))
    assert 0 < sum(Noting.rows) < 1000


def test_stretches_without_the_words_are_not_compared_in_order(finder, monkeypatch):
    """Windows near an item that have too few of its words, as often as it has them, are left out together."""
    f, texts = finder
    enough = []
    inner = f.common

    def noted(around, item):
        own, there = (np.bincount(x[x >= 0], minlength=len(f.items.terms) + 1) for x in (f.items.term_of(f.items.words[item]), around))
        enough.append(np.minimum(own, there).sum() >= f.need[item])
        return inner(around, item)

    monkeypatch.setattr(f, "common", noted)
    rows = ["one " * 40 + "two two two", texts[7], " ".join(sorted(texts[12].split())), ""]  # the first is near the last item
    found = d.found_in([f], d.folded(pa.array(rows)))
    assert any((item == 20).any() for _, item, _, _ in f.candidates(np.resize(f.items.term_of(d.word_hashes(rows[0].encode())[0]), 44)))
    truth = [{i for _, i in brute_pairs([(0, t)], list(enumerate(texts)))} for t in rows]
    assert [{i for i, _, _ in x} for x in found] == truth and truth[1] == {7}
    assert enough and all(enough)
