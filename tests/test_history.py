from __future__ import annotations

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import Audit, add_audit
from tidemark.operators import as_of_join, check_scd2, first_versions, scd2_extend, scd2_merge, scd2_rebuild
from tidemark.operators.history import cell_of, with_cell
from tidemark.plans import staged

END = datetime(9999, 12, 31)
START = datetime(2026, 3, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def change_log(seed: int, keys: int, size: int):
    """(key, time, value) with one hot key that holds a third of all rows; times are unique per key."""
    rng = random.Random(seed)
    found = {}
    while len(found) < size:
        key = 0 if rng.random() < 0.34 else rng.randrange(1, keys)
        at = START + timedelta(minutes=rng.randrange(0, 60 * 24 * 20))
        found[(key, at)] = rng.choice(["a", "a", "b", None])
    return [(k, t, v) for (k, t), v in found.items()]


def versions_of(log):
    """Brute force: the versions a log leads to."""
    out = []
    by_key = {}
    for key, at, value in sorted(log, key=lambda r: (r[0], r[1])):
        by_key.setdefault(key, []).append((at, value))
    for key, changes in by_key.items():
        kept = [c for i, c in enumerate(changes) if i == 0 or changes[i - 1][1] != c[1]]
        for i, (at, value) in enumerate(kept):
            last = i + 1 == len(kept)
            out.append((key, value, at, END if last else kept[i + 1][0], last))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cell", ["minute", "hour", "day", "month", "auto"])
@pytest.mark.parametrize("seed", [1, 2])
def test_rebuild_matches_brute_force_for_any_cell(spark, cell, seed):
    log = change_log(seed, 12, 900)
    df = spark.createDataFrame(log, "k int, at timestamp_ntz, v string").repartition(5)
    assert rows(scd2_rebuild(df, ["k"], ["v"], "at", cell=cell)) == versions_of(log)


@pytest.mark.parametrize("limit", [0, 60, 10_000])
def test_auto_cells_split_hot_keys_only(spark, limit):
    log = change_log(4, 12, 900)
    df = spark.createDataFrame(log, "k int, at timestamp_ntz, v string").repartition(5)
    sizes = Counter(k for k, _, _ in log)
    hot = {k for k, n in sizes.items() if n > limit}
    cells = with_cell(df, ["k"], "at", "auto", limit)
    split = {r.k for r in cells.where("_cell is not null").collect()}
    assert split == hot and cells.count() == len(log)
    assert rows(scd2_rebuild(df, ["k"], ["v"], "at", rows_per_task=limit)) == versions_of(log)
    assert check_scd2(scd2_rebuild(df, ["k"], ["v"], "at"), ["k"], rows_per_task=limit).isEmpty()


def test_a_hot_null_key_is_split_too(spark):
    log = [(None, START + timedelta(minutes=i), "ab"[i % 2]) for i in range(50)]
    df = spark.createDataFrame(log, "k int, at timestamp_ntz, v string")
    cells = with_cell(df, ["k"], "at", "auto", 10)
    assert cells.select("_cell").distinct().count() == 50
    assert scd2_rebuild(df, ["k"], ["v"], "at", rows_per_task=10).count() == 50


def test_rebuild_takes_any_growing_cell(spark):
    log = change_log(3, 5, 300)
    df = spark.createDataFrame(log, "k int, at timestamp_ntz, v string")
    cell = F.date_trunc("week", "at")
    assert rows(scd2_rebuild(df, ["k"], ["v"], "at", cell=cell)) == versions_of(log)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize(
    "kind, cell",
    [(k, c) for k in ("timestamp_ntz", "timestamp") for c in ("minute", "hour", "day", "week", "quarter")]
    + [("date", c) for c in ("day", "week", "quarter")],
)
def test_cells_grow_with_time_in_any_zone(spark, zone, kind, cell):
    """Times around clock changes, and before 1970."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        starts = ["1969-12-31 12:00:00", "2024-03-10 00:30:00", "2024-11-03 00:00:00"]
        df = spark.createDataFrame([(s, i) for s in starts for i in range(300)], "s string, i int").select(
            (F.col("s").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("i"))).cast(kind).alias("t")
        )
        cells = df.select("t", cell_of(df, "t", cell).alias("c"))
        out_of_order = cells.alias("a").join(cells.alias("b"), F.expr("a.t < b.t and a.c > b.c"))
        assert out_of_order.isEmpty() and cells.where("c is null").isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rebuild_equals_merging_batch_by_batch(spark, tmp_path):
    rng = random.Random(5)
    bare = Audit(record_hash=None)
    log, state = [], None
    for day in range(5):
        at = START + timedelta(days=day)
        batch_rows = [(k, rng.choice(["x", "y", None])) for k in range(25) if rng.random() < 0.6]
        log += [(k, at, v) for k, v in batch_rows]
        batch = add_audit(spark.createDataFrame(batch_rows, "k int, v string"), at, "s", bare)
        merged = first_versions(batch, at) if state is None else scd2_merge(state, batch, ["k"], ["v"], at, audit=bare)
        merged.write.parquet(f"{tmp_path}/{day}")
        state = spark.read.parquet(f"{tmp_path}/{day}")
    whole = spark.createDataFrame(log, "k int, at timestamp_ntz, v string")
    names = ["k", "v", "valid_from", "valid_to", "is_current"]
    assert rows(scd2_rebuild(whole, ["k"], ["v"], "at")) == rows(state.select(names)) == versions_of(log)


def test_rebuild_spreads_a_hot_key(spark):
    """A key with all rows is shuffled by its cells; only edges of cells meet by key alone."""
    df = spark.range(0, 20_000).select(
        (F.col("id") % 1).alias("k"),
        F.timestamp_seconds(F.col("id") * 600).cast("timestamp_ntz").alias("at"),
        F.col("id").alias("v"),
    )
    out = scd2_rebuild(df, ["k"], ["v"], "at", cell="day")
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", out._jdf.queryExecution().executedPlan().toString())
    assert [("_cell" in e) for e in exchanges] == [True, False, True]  # the last is the second union branch's copy
    assert out.count() == scd2_rebuild(df, ["k"], ["v"], "at", rows_per_task=1000).count() == 20_000
    assert out.where("is_current").count() == 1
    assert check_scd2(out, ["k"]).isEmpty()


def test_rebuild_carries_columns_and_groups_null_keys(spark):
    log = [(None, START, "a", 1), (None, START + timedelta(days=2), "a", 2), (None, START + timedelta(days=3), "b", 3)]
    df = spark.createDataFrame(log, "k int, at timestamp_ntz, v string, n int")
    out = scd2_rebuild(df, ["k"], ["v"], "at", carry=["n"])
    assert rows(out) == [
        (None, "a", 1, START, START + timedelta(days=3), False),
        (None, "b", 3, START + timedelta(days=3), END, True),
    ]


@pytest.mark.parametrize("small", [True, False])
def test_extend_equals_one_rebuild(spark, small):
    log = change_log(9, 10, 500)
    cut = START + timedelta(days=9)
    old = spark.createDataFrame([r for r in log if r[1] < cut], "k int, at timestamp_ntz, v string")
    new = spark.createDataFrame([r for r in log if r[1] >= cut], "k int, at timestamp_ntz, v string")
    past = staged(scd2_rebuild(old, ["k"], ["v"], "at"), "past")
    later = scd2_extend(past.where("is_current"), new, ["k"], ["v"], "at", small_changes=small)
    assert rows(past.where("not is_current").unionByName(later)) == versions_of(log)


# checks


def dim(spark, data):
    return spark.createDataFrame(
        [(k, START + timedelta(days=a), END if b is None else START + timedelta(days=b), c) for k, a, b, c in data],
        "k int, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean",
    )


def test_check_finds_each_fault(spark):
    faulty = dim(
        spark,
        [
            (1, 0, 5, False), (1, 5, None, True),  # clean
            (2, 0, 6, False), (2, 5, None, True),  # overlap
            (3, 0, 4, False), (3, 5, None, True),  # gap
            (4, 0, 0, False), (4, 0, None, True),  # empty interval
            (5, 0, 5, False),  # no current row
            (6, 0, 5, True), (6, 5, None, True),  # two of them
        ],
    )
    found = [(r.k, None if r.valid_from is None else (r.valid_from - START).days, r.issue)
             for r in check_scd2(faulty, ["k"]).collect()]
    assert sorted(found, key=repr) == sorted(
        [(2, 0, "overlap"), (3, 0, "gap"), (4, 0, "empty_interval"), (5, None, "no_current"), (6, None, "several_current")],
        key=repr,
    )


@pytest.mark.parametrize("cell", ["hour", "day", "year", "auto"])
def test_check_sees_neighbours_in_other_cells(spark, cell):
    rng = random.Random(11)
    data, expected = [], 0
    for key in range(8):
        at = 0
        for _ in range(30):
            end = at + rng.randrange(1, 50)
            wrong = rng.random() < 0.2
            expected += wrong
            data.append((key, START + timedelta(hours=at), START + timedelta(hours=end + wrong), False))
            at = end
        data.append((key, START + timedelta(hours=at), END, True))
    df = spark.createDataFrame(data, "k int, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    found = check_scd2(df, ["k"], cell=cell)
    assert found.count() == expected and {r.issue for r in found.collect()} == {"overlap"}


# as-of


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("cell", ["hour", "month", "auto"])
def test_as_of_matches_brute_force(spark, how, small, cell):
    log = change_log(21, 8, 400)
    versions = versions_of(log)
    history = staged(scd2_rebuild(spark.createDataFrame(log, "k int, at timestamp_ntz, v string"), ["k"], ["v"], "at"), "h")
    rng = random.Random(4)
    facts = []
    for i in range(600):
        key = 0 if i % 3 == 0 else rng.choice([*range(1, 9), 99, None])
        at = START + timedelta(minutes=rng.randrange(-1000, 60 * 24 * 25)) if i % 50 else None
        facts.append((i, key, at))
    facts += [(1000 + i, k, t) for i, (k, _, t, _, _) in enumerate(versions[:40])]  # exactly at a start
    df = spark.createDataFrame(facts, "id int, k int, seen timestamp_ntz")
    expected = []
    for i, key, at in facts:
        hit = [v for k, v, a, b, _ in versions if key is not None and at is not None and k == key and a <= at < b]
        if hit or how == "left":
            expected.append((i, key, at, hit[0] if hit else None))
    out = as_of_join(df, history, ["k"], "seen", ["v"], how=how, cell=cell, small_dim=small, rows_per_task=100)
    assert rows(out) == sorted(expected, key=repr)


def test_as_of_respects_gaps_and_shared_names(spark):
    history = spark.createDataFrame(
        [(1, "a", START, START + timedelta(days=1), False), (1, "b", START + timedelta(days=3), END, True)],
        "k int, v string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean",
    )
    facts = spark.createDataFrame([(1, START + timedelta(days=d)) for d in (0, 2, 4)], "k int, seen timestamp_ntz")
    for small in (True, False):
        out = as_of_join(facts, history, ["k"], "seen", ["v", "valid_from"], small_dim=small)
        assert [r.v for r in out.orderBy("seen").collect()] == ["a", None, "b"]
    with pytest.raises(ValueError):
        as_of_join(facts, history, ["k"], "seen", ["v"], how="full")
    with pytest.raises(ValueError):
        as_of_join(facts.withColumnRenamed("seen", "v"), history, ["k"], "v", ["v"])
