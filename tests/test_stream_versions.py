"""Histories kept in state per key, against a plain walk over the whole log."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from tidemark.operators import check_scd2, scd2_rebuild
from tidemark.plans import scratch_path
from tidemark.streaming import append_stream, state_on_disk, stream_versions, versions_of

START, END = datetime(2026, 4, 1), datetime(9999, 12, 31)
SCHEMA = "k int, v string, w double, at timestamp_ntz"


class Landing:
    """A folder that batches land in, and a stream of versions that works them off."""

    def __init__(self, spark, delay, expire=None):
        self.spark, self.delay, self.expire = spark, delay, expire
        self.landing, self.out, self.checkpoint = (scratch_path(spark, n) for n in ("landing", "versions", "checkpoint"))

    def land(self, rows):
        data = [(k, v, w, at if at is None or isinstance(at, datetime) else START + timedelta(hours=at)) for k, v, w, at in rows]
        self.spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(self.landing)

    def run(self):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(self.landing)
        with state_on_disk(self.spark):
            query = append_stream(stream_versions(stream, ["k"], ["v", "w"], "at", self.delay, self.expire), self.out, self.checkpoint)
        query.awaitTermination()
        return query

    def log(self):
        return self.spark.read.parquet(self.out)

    def history(self):
        return rows_of(versions_of(self.log(), ["k"], ["v", "w"]))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain(rows, mark, expire=None):
    """The versions of all rows up to the mark."""
    by_key = defaultdict(list)
    for k, v, w, at in rows:
        if at <= mark:
            by_key[k].append((at, v, w))
    out = []
    for k, own in by_key.items():
        current = None
        for at, v, w in sorted(own):
            if current and expire and at > current[3] + expire:
                out.append((k, *current[:3], current[3] + expire, False))
                current = None
            if current and current[:2] == [v, w]:
                current[3] = at
                continue
            if current:
                out.append((k, *current[:3], at, False))
            current = [v, w, at, at]
        if expire and current[3] + expire <= mark:
            out.append((k, *current[:3], current[3] + expire, False))
        else:
            out.append((k, *current[:3], END, True))
    return sorted(out, key=repr)


@pytest.mark.parametrize("expire", [None, 20])
def test_rows_in_any_order_within_the_delay(spark, expire):
    rng = random.Random(7)
    times = rng.sample(range(400), 160)
    rows = [(rng.randrange(12), rng.choice(["a", "b", None]), rng.choice([1.0, None]), START + timedelta(minutes=30 * t)) for t in times]
    rows.sort(key=lambda r: r[-1] + timedelta(hours=rng.uniform(0, 40)))
    stream = Landing(spark, "50 hours", expire and expire * 3600)
    for part in (rows[:60], rows[60:110]):
        stream.land(part)
    stream.run()
    stream.land(rows[110:])
    stream.run()  # from the checkpoint
    mark = max(r[-1] for r in rows) - timedelta(hours=50)
    assert stream.history() == plain(rows, mark, expire and timedelta(hours=expire))
    assert not rows_of(stream.log().where("is_late"))
    if not expire:
        history = versions_of(stream.log(), ["k"], ["v", "w"])
        settled = spark.createDataFrame([r for r in rows if r[-1] <= mark], SCHEMA)
        assert rows_of(history) == rows_of(scd2_rebuild(settled, ["k"], ["v", "w"], "at"))
        assert check_scd2(history, ["k"]).isEmpty()


def test_what_can_not_be_placed_is_told_apart(spark):
    stream = Landing(spark, "1 hour", 10 * 3600)
    stream.land([(1, "a", 1.0, 0), (1, "b", 1.0, 5), (2, "x", 1.0, 0), (None, "n", 1.0, 3), (1, "t", 1.0, None)])
    stream.land([(9, "far", 1.0, 8)])
    stream.run()
    stream.land([
        (1, "late", 1.0, 2), (1, "b", 1.0, 5), (1, "c", 1.0, 6), (3, "unheard of", 1.0, 1),
        (9, "one", 1.0, 40), (9, "two", 1.0, 40), (8, "end", 1.0, 60),
    ])
    stream.run()
    at = [START + timedelta(hours=h) for h in (0, 1, 2, 5, 6, 8, 16, 40, 50)]
    late = {(r.k, r.v, r.valid_from) for r in stream.log().where("is_late").collect()}
    assert late == {(1, "late", at[2]), (3, "unheard of", at[1]), (None, "n", START + timedelta(hours=3)), (1, "t", None), (9, "two", at[7])}
    assert stream.history() == sorted(
        [
            (1, "a", 1.0, at[0], at[3], False), (1, "b", 1.0, at[3], at[4], False), (1, "c", 1.0, at[4], at[6], False),
            (2, "x", 1.0, at[0], START + timedelta(hours=10), False),
            (9, "far", 1.0, at[5], START + timedelta(hours=18), False), (9, "one", 1.0, at[7], at[8], False),
        ],
        key=repr,
    )


def test_a_batch_reads_what_has_landed_and_nothing_else(spark):
    stream = Landing(spark, "1 hour")
    stream.land([(k, "a", 1.0, 0) for k in range(50)])
    stream.run()
    stream.land([(1, "b", 1.0, 5)])
    query = stream.run()
    plan = query._jsq.explainInternal(True)
    assert "TransformWithState" in plan and "Join" not in plan and stream.out not in plan.split("Physical Plan")[1].split("WriteFiles")[0]
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) > 0
