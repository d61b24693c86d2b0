from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tidemark.operators import check_scd2
from tidemark.plans import VersionedTable, scratch_path
from tidemark.streaming import append_stream, merge_changes, stream_append, stream_incremental, stream_scd2

START = datetime(2026, 4, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def changes(spark, data):
    return spark.createDataFrame(
        [(k, v, START + timedelta(days=d)) for k, v, d in data], "k int, v string, at timestamp_ntz"
    )


@pytest.mark.parametrize("splits", [1, 8])
def test_copies_are_appended_once(spark, splits):
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "out", "checkpoint"))
    hot = changes(spark, [(0, "hot", 1)] * 200 + [(k, "x", 1) for k in range(1, 50)]).repartition(8)
    for _ in range(2):  # the second round lands after the first was processed
        hot.write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(hot.schema).parquet(landing)
        once = stream_incremental(arriving, ["k"], "at", "10 days", splits)
        assert dict(once.dtypes)["at"] == "timestamp_ntz"
        append_stream(once, out, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(hot.distinct())


def test_late_copies_are_found_in_the_table(spark):
    table = VersionedTable(spark, scratch_path(spark, "log"))
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    for batch in ([(1, "a", 0), (2, "b", 500)], [(1, "a", 0), (3, "very late", 1), (3, "very late", 1)]):
        changes(spark, batch).write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(changes(spark, []).schema).parquet(landing)
        stream_append(arriving, table, checkpoint, ["k"], "at").awaitTermination()
    assert rows(table.read().select("k", "v")) == [(1, "a"), (2, "b"), (3, "very late")]


def test_a_stream_can_go_on(spark):
    table = VersionedTable(spark, scratch_path(spark, "log"))
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    changes(spark, [(1, "a", 0)]).write.parquet(landing)
    arriving = spark.readStream.schema(changes(spark, []).schema).parquet(landing)
    query = stream_append(arriving, table, checkpoint, ["k"], "at", every="1 second")
    query.processAllAvailable()
    changes(spark, [(1, "a", 0), (2, "b", 0)]).write.mode("append").parquet(landing)
    query.processAllAvailable()
    query.stop()
    assert rows(table.read().select("k", "v")) == [(1, "a"), (2, "b")]


def test_row_times_survive_a_clock_change(spark):
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "out", "checkpoint"))
    skipped_hour = spark.createDataFrame([(1, datetime(2024, 3, 10, 2, 30))], "k int, at timestamp_ntz")
    skipped_hour.write.parquet(landing)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        arriving = spark.readStream.schema(skipped_hour.schema).parquet(landing)
        append_stream(stream_incremental(arriving, ["k"], "at", "1 day"), out, checkpoint).awaitTermination()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows(spark.read.parquet(out)) == [(1, datetime(2024, 3, 10, 2, 30))]


@pytest.mark.parametrize("options", [{}, {"bucket_by": ["k"], "buckets": 4}])
def test_history_follows_the_stream(spark, options):
    table = VersionedTable(spark, scratch_path(spark, "dim"), **options)
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    for batch in ([(1, "a", 0), (1, "b", 1), (2, "x", 0)], [(1, "c", 2), (1, "c", 3), (3, "n", 2)]):
        changes(spark, batch).write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(changes(spark, []).schema).parquet(landing)
        stream_scd2(arriving, table, checkpoint, ["k"], ["v"], "at").awaitTermination()
    found = [(r.k, r.v, (r.valid_from - START).days, r.is_current) for r in table.read().collect()]
    assert sorted(found) == [(1, "a", 0, False), (1, "b", 1, False), (1, "c", 2, True), (2, "x", 0, True), (3, "n", 2, True)]
    assert check_scd2(table.read(), ["k"]).isEmpty()
    first, second = table.manifest().loads
    assert first.endswith("-batch-0") and second.endswith("-batch-1") and first[:36] == second[:36]


def test_a_batch_is_applied_once(spark):
    table = VersionedTable(spark, scratch_path(spark, "dim"))
    batch = changes(spark, [(1, "a", 0), (1, "a", 0), (1, "b", 1)])
    assert merge_changes(table, batch, "one", ["k"], ["v"], "at")["rows"] == 2
    assert merge_changes(table, batch, "one", ["k"], ["v"], "at") == {}
    state = rows(table.read())
    merge_changes(table, changes(spark, [(1, "b", 1)]), "two", ["k"], ["v"], "at")  # redelivered
    assert rows(table.read()) == state


def test_late_and_keyless_changes_are_kept_apart(spark):
    table, late = VersionedTable(spark, scratch_path(spark, "dim")), scratch_path(spark, "late")
    merge_changes(table, changes(spark, [(1, "a", 5)]), "one", ["k"], ["v"], "at")
    mixed = changes(spark, [(1, "old", 2), (1, "b", 6), (None, "n", 6)])
    with pytest.raises(ValueError):
        merge_changes(table, mixed, "two", ["k"], ["v"], "at")
    merge_changes(table, mixed, "two", ["k"], ["v"], "at", late_path=late)
    assert rows(table.read().select("k", "v", "is_current")) == [(1, "a", False), (1, "b", True)]
    assert rows(spark.read.parquet(late).select("k", "v")) == [(1, "old"), (None, "n")]
