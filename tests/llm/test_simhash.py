from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.common import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute_groups(ids, fps, radius=2):
    best = dict(zip(range(len(fps)), ids, strict=True))
    fps = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    label = np.arange(len(fps))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(fps))])
        if (new == label).all():
            break
        label = new
    return [min((best[j] for j in np.flatnonzero(label == c) if best[j] is not None), default=None) for c in label]


def check(df, rows):
    found = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_query(df).collect()), key=str)
    fps = [brute_fingerprint(t) for _, t in rows]
    groups = brute_groups([i for i, _ in rows], fps)
    assert found == sorted(((i, f"{f:016x}", g) for (i, _), f, g in zip(rows, fps, groups, strict=True)), key=str)


def test_near_copies(make, prose):
    texts = prose(40, words=200)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, t + " more") for i, t in enumerate(texts[:10])]
    rows += [(200 + i, texts[0]) for i in range(5)]
    check(make(rows), rows)


def test_odd_rows(make, odd_rows):
    check(make(odd_rows), odd_rows)


def test_empty(make):
    assert simhash.simhash_query(make([])).collect() == []
    assert simhash.one_of_each_group(make([])).collect() == []


def test_one_stays(make, prose):
    a, b = prose(2, words=100)
    kept = simhash.one_of_each_group(make([(3, a), (1, a), (2, b), (None, a)]))
    assert sorted(kept.select("doc_id").collect(), key=str) == [(1,), (2,), (None,)]
    assert "row" in kept.columns


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_of_clustered_fingerprints(spark, radius):
    """Many fingerprints in few balls, so that one key is hot and is split by more bits."""
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 64, 3, dtype=np.uint64)
    fps = {int(c) for c in rng.integers(0, 1 << 64, 300, dtype=np.uint64)}
    for c in centres:
        for _ in range(300):
            flips = rng.choice(24, rng.integers(0, 4), replace=False)
            fps.add(int(c) ^ sum(1 << int(b) for b in flips))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp long, first long")
    links = simhash.links(df, radius).collect()
    assert all((a.u ^ a.v).bit_count() <= radius or ((a.u ^ a.v) & simhash.ALL).bit_count() <= radius for a in links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links or [(0, 0)], "u long, v long")).collect()}
    mine = [found.get(f, f) for f in signed]
    groups = brute_groups(list(range(len(fps))), fps, radius)
    assert len(set(zip(mine, groups, strict=True))) == len(set(mine)) == len(set(groups))


def test_components_of_a_chain(spark):
    n = 300
    order = np.random.default_rng(0).permutation(n).tolist()
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001)]
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.root for r in found if r.node < n} == {0}
    assert {r.root for r in found if r.node >= n} == {1000}
