"""Key summaries, and loads that read only what they lead to."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge_summaries, possible_parts, summarise_keys, unloaded_rows, words_for
from tidemark.plans import KeyedLog, scratch_path

START = datetime(2026, 1, 1)
SCHEMA = "k long, j string, v string, at timestamp_ntz"


def frame(spark, rows):
    return spark.createDataFrame([(k, j, v, START + timedelta(hours=at)) for k, j, v, at in rows], SCHEMA)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("k", "j", "v", "at")) for r in df.collect()), key=repr)


def test_no_key_is_missed_and_few_are_found_in_vain(spark):
    there = spark.range(0, 40_000).select((F.col("id") % 4).alias("part"), F.col("id").alias("k"))
    words = words_for(10_000)
    assert words == 4096 and words_for(1) == 1 and words_for(0) == 1
    summary = summarise_keys(there, ["k"], words, ["part"])
    asked = spark.range(0, 140_000).select(F.col("id").alias("k"))
    found = possible_parts(summary, [words], asked, ["k"], ["part"])
    right = found.where((F.col("k") < 40_000) & (F.col("k") % 4 == F.col("part"))).count()
    assert right == 40_000
    asked_in_vain = 140_000 * 4 - 40_000
    rate = (found.count() - right) / asked_in_vain
    assert 0 < rate < 0.004, rate  # at 26 bits a key, as words are a power of two


@pytest.mark.parametrize("words", [1024, 256, 1])
def test_merged_summaries_hold_what_each_held(spark, words):
    parts = [summarise_keys(spark.range(n, n + 900).select(F.col("id").alias("k")), ["k"], size) for n, size in ((0, 1024), (5000, 4096))]
    merged = merge_summaries(parts[0].unionByName(parts[1]), words).withColumn("part", F.lit(1))
    whole = summarise_keys(spark.range(0, 900).union(spark.range(5000, 5900)).select(F.col("id").alias("k")), ["k"], words)
    assert sorted(merged.drop("part").collect()) == sorted(whole.collect())


def random_batches(seed, n=5):
    rng = random.Random(seed)
    for b in range(n):
        yield [(rng.choice([None, *range(60)]), rng.choice(["x", "y"]), f"{b}-{i}", rng.randrange(500)) for i in range(60)]


@pytest.mark.parametrize("seed", [1, 2])
def test_the_log_is_what_reading_all_keys_gives(spark, seed):
    log = KeyedLog(spark, scratch_path(spark, "log"), ["k", "j"], "at")
    expected = frame(spark, [])
    for n, rows in enumerate(random_batches(seed)):
        batch = frame(spark, rows)
        expected = spark.createDataFrame(expected.unionByName(unloaded_rows(expected, batch, ["k", "j"], "at")).collect(), SCHEMA)
        log.append(batch, f"load-{n}")
        assert log.append(batch, f"load-{n}") == {}
    assert rows_of(log.read()) == rows_of(expected)


def test_loads_without_the_keys_are_not_read(spark, monkeypatch):
    log = KeyedLog(spark, scratch_path(spark, "log"), ["k"], "at")
    for n in range(8):
        log.append(frame(spark, [(k, "x", "first", 0) for k in range(1000 * n, 1000 * n + 50)]), f"load-{n}")
    read = []
    inner = log.read
    monkeypatch.setattr(log, "read", lambda loads=None: read.append(loads) or inner(loads))
    assert log.append(frame(spark, [(5003, "x", "again", 9), (99_999, "x", "new", 9)]), "replay") == {"rows": 1, "looked_at": ["load-5"]}
    assert read == [["load-5"]]
    files = inner(["load-5"]).inputFiles()
    assert files and all("load=load-5" in f for f in files)
    assert log.append(frame(spark, [(70_000 + k, "x", "new", 9) for k in range(5)]), "other")["looked_at"] == []


def test_a_load_that_died_is_not_seen_and_can_be_done_again(spark, monkeypatch):
    log = KeyedLog(spark, scratch_path(spark, "log"), ["k"], "at")
    assert log.read() is None
    log.append(frame(spark, [(1, "x", "a", 0)]), "one")
    monkeypatch.setattr("tidemark.plans.keyed_log.summarise_keys", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        log.append(frame(spark, [(1, "x", "b", 1), (2, "x", "c", 1)]), "two")
    monkeypatch.undo()
    assert len(rows_of(log.read())) == 1
    log.append(frame(spark, [(1, "x", "b", 1), (2, "x", "c", 1)]), "two")
    assert [r[2] for r in rows_of(log.read())] == ["a", "c"]
    log.append(frame(spark, []), "empty")
    with pytest.raises(ValueError):
        log.append(frame(spark, []), "a/b")
