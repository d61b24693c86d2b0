"""Late changes: batches in any order give what one rebuild of the whole log gives."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators import Versions, check_scd2, one_per_time, scd2_corrections, scd2_place, scd2_rebuild
from tidemark.plans import staged

START = datetime(2026, 1, 1)
SCHEMA = "k int, j string, v string, w int, origin string, at timestamp_ntz"
KEYS, TRACKED = ["k", "j"], ["v", "w"]


def frame(spark, rows):
    return spark.createDataFrame([(k, j, v, w, o, at if at is None else START + timedelta(hours=at)) for k, j, v, w, o, at in rows], SCHEMA)


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("seed", "cell", "rows_per_task"), [(1, "auto", 5_000_000), (2, "auto", 4), (3, "day", 5_000_000)])
def test_any_order_of_batches_is_one_rebuild(spark, seed, cell, rows_per_task):
    rng = random.Random(seed)
    rows = []
    for _ in range(150):
        k = rng.choice([1, 1, 1, 2, 3, 4, 5, 6])  # a key with a third of all rows
        rows.append((k, rng.choice("xy"), rng.choice(["a", "b", None]), rng.choice([1, None]), f"o{rng.randrange(9)}", rng.randrange(120)))
    batches = [rows[i::4] for i in range(4)]
    rng.shuffle(batches)
    log = frame(spark, batches[0])
    options = {"carry": ["origin"], "cell": cell, "rows_per_task": rows_per_task}
    history = scd2_rebuild(one_per_time(log, KEYS, "at"), KEYS, TRACKED, "at", **options)
    for batch in batches[1:]:
        changes = frame(spark, batch)
        history = staged(scd2_place(staged(history, "h"), log, changes, KEYS, TRACKED, "at", **options), "h")
        log = log.unionByName(changes)
    whole = scd2_rebuild(one_per_time(log, KEYS, "at"), KEYS, TRACKED, "at", carry=["origin"])
    assert rows_of(history) == rows_of(whole)
    assert check_scd2(history, KEYS).isEmpty()


def seen(spark, rows):
    """(history, log) of rows (value, hour) of one key."""
    log = frame(spark, [(1, "x", v, 1, "o", at) for v, at in rows])
    return scd2_rebuild(log, KEYS, TRACKED, "at"), log


def placed(spark, rows, late):
    history, log = seen(spark, rows)
    changes = frame(spark, [(1, "x", v, 1, "late", at) for v, at in late])
    found = scd2_place(history, log, changes, KEYS, TRACKED, "at")
    hours = lambda t: None if t.year == 9999 else (t - START).total_seconds() / 3600
    return sorted((hours(r.valid_from), hours(r.valid_to), r.v) for r in found.collect())


def test_splits_and_stitches(spark):
    rows = [("a", 0), ("a", 4), ("b", 10), ("c", 20)]
    # within a version: split, and again what it was from when it was next seen
    assert placed(spark, rows, [("z", 2)]) == [(0, 2, "a"), (2, 4, "z"), (4, 10, "a"), (10, 20, "b"), (20, None, "c")]
    # after the last time that the version was seen: up to the next one
    assert placed(spark, rows, [("z", 6)]) == [(0, 6, "a"), (6, 10, "z"), (10, 20, "b"), (20, None, "c")]
    # the same as the next version: that one begins earlier
    assert placed(spark, rows, [("b", 6)]) == [(0, 6, "a"), (6, 20, "b"), (20, None, "c")]
    assert placed(spark, rows, [("a", 6)])[0] == (0, 10, "a")
    assert placed(spark, rows, [("z", -5)])[:2] == [(-5, 0, "z"), (0, 10, "a")]
    assert placed(spark, rows, [("a", -5)])[0] == (-5, 10, "a")
    assert placed(spark, rows, [("d", 30), ("c", 25)])[-2:] == [(20, 30, "c"), (30, None, "d")]


def test_only_the_touched_span_is_rebuilt(spark):
    history, log = seen(spark, [(str(n), 10 * n) for n in range(20)])
    changes = frame(spark, [(1, "x", "late", 1, "l", 95), (2, "x", "new", 1, "l", 5), (None, "x", "no key", 1, "l", 5), (1, "x", "no time", 1, "l", None)])
    replaced, added = scd2_corrections(history, log, changes, KEYS, TRACKED, "at")
    assert sorted(r.v for r in replaced.collect()) == ["10", "9"]
    assert sorted((r.k, r.v) for r in added.collect()) == [(1, "10"), (1, "9"), (1, "late"), (2, "new")]


def test_a_key_that_was_closed(spark):
    history, log = seen(spark, [("a", 0), ("b", 10), ("c", 20)])
    names = Versions()
    gone = history.withColumn(names.is_current, history.valid_from < START)  # all are closed
    changes = frame(spark, [(1, "x", "z", 1, "l", 5)])
    assert len(scd2_place(gone, log, changes, KEYS, TRACKED, "at").collect()) == 4
    with pytest.raises(Exception, match="closed"):
        scd2_place(gone, log, frame(spark, [(1, "x", "z", 1, "l", 25)]), KEYS, TRACKED, "at").collect()


def test_empty_batches_and_histories(spark):
    history, log = seen(spark, [("a", 0)])
    empty = frame(spark, [])
    assert rows_of(scd2_place(history, log, empty, KEYS, TRACKED, "at")) == rows_of(history)
    assert rows_of(scd2_place(history.limit(0), empty, log, KEYS, TRACKED, "at")) == rows_of(history)
