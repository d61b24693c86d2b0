from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import toxicity

LABELS = "doc_id long, toxic int, quality int"


@pytest.fixture(scope="module")
def planted(make, prose, spark):
    texts = prose(240, words=40, seed=4)
    bad = ["moron", "scum", "IDIOT!!"]
    rows, labels = [], []
    for i, text in enumerate(texts):
        toxic = i % 4 == 0
        words = text.split()
        for k in range(1 + i % 3 if toxic else 0):
            words.insert(7 * k, bad[(i // 4 + k) % 3])
        rows.append((i, " ".join(words)))
        if i < 160:
            labels.append((i, int(toxic), 0))
    return make(rows), spark.createDataFrame(labels, LABELS)


def test_held_out_texts(planted):
    docs, labels = planted
    found = {r.doc_id: r for r in toxicity.severity(docs, toxicity.train(docs, labels)).collect()}
    held = [found[i] for i in range(160, 240)]
    assert all(r.toxic == (r.doc_id % 4 == 0) for r in held)
    mean = [np.mean([r.severity for r in held if r.doc_id % 4 == 0 and r.doc_id % 3 == n]) for n in range(3)]
    assert mean[0] < mean[1] < mean[2]  # one, two and three insults


def test_weights_are_shared_and_thresholds_ordered(planted):
    model = toxicity.train(*planted)
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) >= 2
    for text in ("moron", "moron scum", "nothing", "", None):
        chances = model.at_least(text)
        assert chances == sorted(chances, reverse=True)
        logits = [np.log(p / (1 - p)) + t for p, t in zip(chances, model.thresholds, strict=True)]
        assert np.allclose(logits, logits[0])


def test_gradient_reaches_the_optimum():
    """Against a search over the same loss, one feature and two thresholds."""
    rng = np.random.default_rng(0)
    rows = [[0] if rng.random() < 0.5 else [] for _ in range(400)]
    grades = np.array([int(rng.random() < (0.7 if r else 0.2)) + int(rng.random() < (0.5 if r else 0.1)) for r in rows])
    weights, thresholds = toxicity.fit(rows, grades, 1)

    def loss(w, a, b):
        score = np.array([w if r else 0.0 for r in rows])
        upper = [1 / (1 + np.exp(score - t)) for t in (a, b)] + [np.ones(len(rows))]
        lower = [np.zeros(len(rows)), *upper[:2]]
        chance = np.array([u - v for u, v in zip(upper, lower, strict=True)])[grades, np.arange(len(rows))]
        return -np.log(chance).mean() + 0.02 / 2 / len(rows) * w * w

    own = loss(weights[0], *thresholds)
    near = [loss(weights[0] + i, thresholds[0] + j, thresholds[1] + k) for i in (-0.05, 0, 0.05) for j in (-0.05, 0, 0.05) for k in (-0.05, 0, 0.05)]
    assert own <= min(near) + 1e-6


def test_odd_rows(planted, make, odd_rows, spark):
    docs, labels = planted
    model = toxicity.train(docs, labels)
    odd = make(odd_rows)
    found = toxicity.severity(odd, model).collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted((i for i, _ in odd_rows), key=str)
    assert not any(r.toxic for r in found)
    kept = toxicity.without_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows)
    # labels that are null, repeated or in doubt
    strange = labels.unionByName(spark.createDataFrame([(None, 1, 0), (1, None, 0), (3, 1, 0), (0, 1, 0), (9999, 1, 0)], LABELS))
    toxicity.train(docs.unionByName(odd), strange)


def test_nothing_to_learn(make, spark):
    model = toxicity.train(make([(1, "a b c")]), spark.createDataFrame([], LABELS))
    assert [r.toxic for r in toxicity.severity(make([(1, "a"), (2, None)]), model).collect()] == [False, False]
    assert toxicity.severity(make([]), model).collect() == []
    assert toxicity.without_toxic(make([]), model).collect() == []


def test_sample_bound(planted):
    docs, labels = planted
    assert len(toxicity.train(docs, labels, sample_rows=40, least_ratio=3.0).weights) > 0
