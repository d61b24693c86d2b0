from __future__ import annotations

import math

import numpy as np
import pytest

from tidemark.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, id long, dim int, cell int"


def brute(rows, every, k):
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fine[i, tuple(math.floor(256 * float(np.float32(x))) for x in v)] = True
    out = []
    for q, a in fine:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in fine if i != q and len(a) == len(b))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def check(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA)
    found = sorted(map(tuple, topk.top_k(df, every=5, **settings).collect()))
    assert found == brute(rows, 5, settings.get("k", 5))


@pytest.mark.parametrize("cell, block", [(1000, 1000), (40, 15)])
def test_random(spark, cell, block):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    check(spark, rows, cell=cell, block=block)


def test_clusters_and_one_common_vector(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8)) * 3
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.05).astype(np.float32).tolist()) for i in range(200)]
    rows += [(1000 + i, [0.5] * 8) for i in range(150)]
    check(spark, rows, cell=128, block=32, k=3)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (5, None), (10, [float("nan"), 1.0]), (15, [float("inf"), 1.0]), (20, [None, 1.0]), (None, [1.0, 1.0]),
        (25, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [-0.001, 0.0]), (3, [1.0, 2.0, 3.0]), (30, [1.0, 0.0, 0.0]), (35, []), (4, []),
    ]
    check(spark, rows)


def test_empty_and_single(spark):
    check(spark, [])
    check(spark, [(0, [1.0])])


def test_large_components(spark):
    """Products beyond what doubles hold exactly."""
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(1 << 18, 1 << 21, 3) * 1.0).astype(np.float32).tolist()) for i in range(60)]
    check(spark, rows)


def test_search_prunes():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(400, 4)) * 2 + c for c in ([300, 0, 0, 0], [0, 300, 0, 0], [-300, 0, 0, 0])]).astype(np.int64)
    seen = []
    search = topk.Search(x[:20], np.arange(20), x, np.arange(1200) + 100, np.full(20, -(1 << 62)), 3)
    score = search.score
    search.score = lambda q, r: (seen.append(len(q) * len(r)), score(q, r))
    search.run()
    assert sum(seen) < 20 * 1200 * 0.6
