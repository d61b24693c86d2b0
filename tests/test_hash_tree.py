"""Reconciliation by ranges, and minimal keys."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import descend, minimal_keys, range_sums, reconcile, reconcile_by_ranges, unequal_ranges, unique_sets
from tidemark.operators.hash_tree import Ranges, in_ranges
from tidemark.operators.unique_sets import hashed_sample, repeats, verified

KINDS = {
    "long": ("k long", lambda n: n * 1_000_003 - 10**9),
    "int": ("k int", lambda n: n - 50),
    "time": ("k timestamp_ntz", lambda n: datetime(2026, 1, 1) + timedelta(seconds=977 * n, microseconds=n)),
    "text": ("k string", lambda n: f"key {n}"),
}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize(("fanout", "leaf_rows"), [(4, 3), (64, 10)])
def test_same_differing_keys_as_reconcile(spark, kind, fanout, leaf_rows):
    schema, key = KINDS[kind]
    rng = random.Random(fanout)
    rows = [(key(rng.randrange(300)), rng.choice("ab"), rng.choice([None, 1.5])) for _ in range(400)] + [(None, "n", 1.0)]
    other = [r for i, r in enumerate(rows) if i % 97] + [(key(301), "new", None), (None, "n", 2.0), rows[5]]
    other[40] = (other[40][0], "changed", None)
    source, target = (spark.createDataFrame(x, f"{schema}, v string, w double") for x in (rows, other))
    expected = reconcile(source, target, ["k"]).where("status <> 'equal'")
    assert rows_of(reconcile_by_ranges(source, target, ["k"], fanout=fanout, leaf_rows=leaf_rows)) == rows_of(expected)


def test_equal_ranges_send_no_keys(spark):
    source = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    target = source.withColumn("v", F.when(F.col("k").isin(5_000, 77_777), F.lit(99)).otherwise(F.col("v")))
    ranges = descend(source, target, ["k"], fanout=16, leaf_rows=20)
    assert ranges.width == 16 and [r[0] for r in ranges.intervals()] == [4992, 77776]
    left = in_ranges(source, ["k"], ranges)
    assert left.count() == 32
    found = reconcile_by_ranges(source, target, ["k"], fanout=16, leaf_rows=20)
    assert rows_of(found) == [(5_000, 1, 1, "changed"), (77_777, 1, 1, "changed")]
    assert reconcile_by_ranges(source, source, ["k"]).isEmpty()


def test_ranges_reach_the_files(spark, tmp_path):
    spark.range(0, 50_000, 1, 10).select(F.col("id").alias("k")).write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    plan = in_ranges(stored, ["k"], Ranges(0, 100, (3, 4, 90)))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,300)" in plan and "LessThanOrEqual(k,499)" in plan


def test_many_ranges_and_one_side_empty(spark, monkeypatch):
    monkeypatch.setattr("tidemark.operators.hash_tree.MOST_FILTERS", 2)
    source = spark.range(0, 3000).select(F.col("id").alias("k"), F.lit(1).alias("v")).union(spark.sql("SELECT cast(null as long), 1"))
    target = source.withColumn("v", F.when(F.col("k") % 100 == 0, F.lit(2)).otherwise(F.col("v")))
    expected = reconcile(source, target, ["k"]).where("status <> 'equal'")
    assert rows_of(reconcile_by_ranges(source, target, ["k"], fanout=8, leaf_rows=10)) == rows_of(expected)
    assert reconcile_by_ranges(source, target.limit(0), ["k"], fanout=8, leaf_rows=10).count() == 3001
    assert reconcile_by_ranges(source.limit(0), target.limit(0), ["k"]).count() == 0


def test_sums_of_a_side_can_be_kept(spark, tmp_path):
    source = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    range_sums(source, ["k"], ["k", "v"], 0, 100).write.parquet(f"{tmp_path}/sums")
    later = source.where("k <> 512")
    found = unequal_ranges(spark.read.parquet(f"{tmp_path}/sums"), range_sums(later, ["k"], ["k", "v"], 0, 100))
    assert rows_of(found) == [(5, 100)]


def brute(rows, columns, most):
    found = []
    for size in range(1, most + 1):
        for c in combinations(range(len(columns)), size):
            values = [tuple(r[i] for i in c) for r in rows]
            if len(set(values)) == len(rows) and not any(None in v for v in values) and not any(set(k) <= set(c) for k in found):
                found.append(c)
    return sorted(",".join(columns[i] for i in c) for c in found)


@pytest.mark.parametrize(("seed", "sample"), [(1, 20_000), (2, 20), (3, 1)])
def test_minimal_keys(spark, seed, sample):
    """Whatever the sample refutes or does not."""
    rng = random.Random(seed)
    rows = list({(rng.randrange(9), rng.randrange(9), rng.choice("abc"), rng.randrange(30), rng.choice([None, 1, 2]), rng.random()) for _ in range(80)})
    columns = list("abcdef")
    df = spark.createDataFrame(rows, "a int, b int, c string, d int, e int, f double").repartition(3)
    found = minimal_keys(df, most_columns=4, sample_rows=sample)
    assert sorted(r["columns"] for r in found.collect()) == brute(rows, columns, 4)


def test_repeated_rows_have_no_key_and_empty_tables_have_all(spark):
    rows = [(1, "a")] * 500 + [(2, "b")]
    df = spark.createDataFrame(rows, "a int, b string")
    sample = hashed_sample(df, ["a", "b"], 10_000)
    assert len(sample) == 3 and repeats(sample, [0, 1])
    assert minimal_keys(df).collect() == []
    assert sorted(r["columns"] for r in minimal_keys(df.limit(0)).collect()) == ["a", "b"]


def shuffled_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(n).length() for n in range(files.size()))


@pytest.mark.parametrize("small", [0, 1_000_000])
def test_keys_are_proven_with_little_disk(spark, monkeypatch, small):
    """No pass leaves its shuffle behind, and the passes tell what is unique."""
    monkeypatch.setattr(unique_sets, "SMALL", small, raising=False)
    df = spark.range(100_000).selectExpr("id AS a", "id % 50000 AS b", "id % 3 AS c", "id DIV 2 * 2 AS d")
    before = shuffled_bytes(spark)
    assert verified(df, [("a",), ("b",), ("b", "c"), ("d",), ("c", "d"), ("a", "c")]) == {("a",), ("b", "c"), ("c", "d"), ("a", "c")}
    assert shuffled_bytes(spark) - before < 100_000


@pytest.mark.parametrize("hits", [0, 1, 1000])
def test_a_few_repeats_are_found_by_the_values(spark, monkeypatch, hits):
    """Two equal rows among many: no share shows them for sure, the whole does."""
    monkeypatch.setattr(unique_sets, "HITS", hits)
    df = spark.range(5000).selectExpr("id AS a", "CAST(id AS STRING) AS b")
    again = df.unionByName(df.where("a IN (17, 4321)"))
    assert unique_sets.is_unique(df, ["a", "b"]) and not unique_sets.is_unique(again, ["a", "b"]) and not unique_sets.is_unique(again, ["b"])
