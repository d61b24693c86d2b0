"""Feeds of transactions: only whole ones are applied, in the order of their commits."""

from __future__ import annotations

import random

import pytest

from tidemark.operators import FeedColumns, apply_transactions, broken_chains, split_feed, transaction_states

ROW = "k long, j string, v string"
IMAGE = "struct<k: long, j: string, v: string>"
FEED = f"tx long, commit long, size long, place long, before {IMAGE}, after {IMAGE}"
KEYS = ["k", "j"]


def feed_of(spark, rows):
    return spark.createDataFrame(rows, FEED)


def target_of(spark, rows):
    return spark.createDataFrame(rows, ROW)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def history(seed, transactions=12):
    """Random transactions over a small table, and its state after each commit."""
    rng = random.Random(seed)
    state, feed, states = {}, [], [set()]
    for tx in range(transactions):
        changes = []
        for place in range(rng.randint(1, 8)):
            key = rng.choice(list(state)) if state and rng.random() < 0.7 else None
            new = (rng.randrange(6), rng.choice("xy"))
            if key is None and new not in state:
                after = (*new, f"{tx}-{place}")
                changes.append((None, after))
                state[new] = after
            elif key is not None and rng.random() < 0.25:
                changes.append((state.pop(key), None))
            elif key is not None and (new not in state or new == key):
                before = state.pop(key)
                after = (*new, rng.choice([None, f"{tx}-{place}"]))
                changes.append((before, after))
                state[new] = after
        feed += [(100 + tx, tx, len(changes), n, b, a) for n, (b, a) in enumerate(changes)]
        states.append(set(state.values()))
    return feed, states


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("small", [True, False])
def test_a_feed_that_is_cut_anywhere(spark, seed, small):
    feed, states = history(seed)
    rng = random.Random(seed)
    target, waiting, applied = target_of(spark, []), feed_of(spark, []), 0
    cut = rng.randrange(1, len(feed))
    for part in (feed[:cut], feed[cut:]):
        delivered = part + rng.sample(part, len(part) // 3)
        rng.shuffle(delivered)
        arrived = waiting.unionByName(feed_of(spark, delivered))
        result, left = apply_transactions(target, arrived, KEYS, small_feed=small)
        target = target_of(spark, [tuple(r) for r in result.collect()])
        waiting = feed_of(spark, [r for r in left.collect()])
        applied += len(part)
        seen = feed[:applied]
        whole = 0
        while whole < 12 and sum(r[1] == whole for r in seen) == sum(r[1] == whole for r in feed):
            whole += 1
        assert set(rows_of(target)) == states[whole]
        assert {(r.tx, r.place) for r in waiting.collect()} == {(r[0], r[3]) for r in seen if r[1] >= whole}
    assert waiting.isEmpty()


def test_what_follows_a_gap_waits(spark):
    a, b, c = ((n, "x", "v") for n in (1, 2, 3))
    rows = [(1, 10, 1, 0, None, a), (2, 20, 2, 0, None, b), (3, 30, 1, 0, None, c)]
    ready, waiting = split_feed(feed_of(spark, rows))
    assert [r.tx for r in ready.collect()] == [1] and sorted(r.tx for r in waiting.collect()) == [2, 3]
    states = {r.tx: (r.announced, r.arrived, r.is_whole) for r in transaction_states(feed_of(spark, rows)).collect()}
    assert states == {1: (1, 1, True), 2: (2, 1, False), 3: (1, 1, True)}
    nowhere = [*rows, (None, 5, 1, 0, None, c), (4, None, 2, 0, None, c)]
    ready, waiting = split_feed(feed_of(spark, nowhere))
    assert ready.isEmpty() and waiting.count() == 5
    assert split_feed(feed_of(spark, []))[0].isEmpty()


def test_a_key_that_changes_places_with_another(spark):
    one, two = (1, "x", "a"), (2, "x", "b")
    rows = [(1, 1, 3, 0, one, (9, "x", "a")), (1, 1, 3, 1, two, (1, "x", "b")), (1, 1, 3, 2, (9, "x", "a"), (2, "x", "a"))]
    result, _ = apply_transactions(target_of(spark, [one, two, (None, "x", "kept")]), feed_of(spark, rows), KEYS)
    assert rows_of(result) == sorted([(1, "x", "b"), (2, "x", "a"), (None, "x", "kept")], key=repr)


@pytest.mark.parametrize("rows_per_task", [5_000_000, 2])
def test_broken_chains(spark, rows_per_task):
    feed, _ = history(3)
    assert broken_chains(target_of(spark, []), feed_of(spark, feed), KEYS, rows_per_task=rows_per_task).isEmpty()
    target = target_of(spark, [(1, "x", "a"), (2, "x", "b"), (7, "x", "never named")])
    rows = [
        (1, 1, 1, 0, (1, "x", "other"), (1, "x", "c")), (2, 2, 1, 0, (1, "x", "c"), None), (3, 3, 1, 0, (1, "x", "c"), None),
        (4, 4, 1, 0, None, (2, "x", "z")), (5, 5, 1, 0, (3, "x", "q"), (4, "x", "q")), (6, 6, 1, 0, None, (4, "x", "q")),
    ]
    found = broken_chains(target, feed_of(spark, rows), KEYS, FeedColumns(), rows_per_task=rows_per_task)
    assert rows_of(found) == sorted(
        [(1, "x", 1, "other_values"), (1, "x", 3, "not_there"), (2, "x", 4, "already_there"), (3, "x", 5, "not_there"), (4, "x", 6, "already_there")], key=repr
    )
