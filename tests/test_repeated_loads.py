"""Loads after the first: nothing may be lost, repeated or changed without a word."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import ColumnMap, project
from tidemark.operators import apply_changes, profile_table, scd2_extend, scd2_rebuild
from tidemark.plans import Changes, Full, Incremental, LoadSpec, Scd1, Scd2, VersionedTable, open_table, run_load, scratch_path
from tidemark.plans.versioned import ConcurrentLoad
from tidemark.sinks import full_load
from tidemark.streaming import merge_changes, stream_append

START = datetime(2026, 4, 1)
T1, T2, T3 = "2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def changes(spark, data):
    return spark.createDataFrame([(k, v, START + timedelta(days=d)) for k, v, d in data], "k int, v string, at timestamp_ntz")


def fresh(spark, **options):
    return VersionedTable(spark, scratch_path(spark, "t"), **options)


def test_streams_with_checkpoints_of_their_own_share_a_table(spark):
    table = fresh(spark)
    for first in (0, 100):
        landing = scratch_path(spark, "landing")
        data = changes(spark, [(first + k, "x", 1) for k in range(5)])
        data.write.parquet(landing)
        arriving = spark.readStream.schema(data.schema).parquet(landing)
        stream_append(arriving, table, scratch_path(spark, "checkpoint"), ["k"], "at").awaitTermination()
    assert table.read().count() == 10


def test_late_is_judged_by_when_a_key_was_last_seen(spark):
    table, late = fresh(spark), scratch_path(spark, "late")
    merge_changes(table, changes(spark, [(1, "a", 1), (1, "a", 3)]), "one", ["k"], ["v"], "at")
    merge_changes(table, changes(spark, [(1, "b", 2), (2, "n", 2)]), "two", ["k"], ["v"], "at", late_path=late)
    assert rows(table.read().select("k", "v", "is_current")) == [(1, "a", True), (2, "n", True)]
    assert rows(spark.read.parquet(late).select("k", "v")) == [(1, "b")]
    merge_changes(table, changes(spark, [(1, "a", 9), (2, "m", 9)]), "three", ["k"], ["v"], "at")
    seen = {(r.k, r.v): (r.last_seen - START).days for r in table.read().where("is_current").collect()}
    assert seen == {(1, "a"): 9, (2, "m"): 9}


def test_both_forms_of_extend_agree_on_null_keys(spark):
    past = scd2_rebuild(changes(spark, [(None, "a", 0), (1, "a", 0), (2, "x", 0)]), ["k"], ["v"], "at")
    later = changes(spark, [(None, "b", 1), (1, "b", 1), (3, "n", 1)])
    small, large = (rows(scd2_extend(past, later, ["k"], ["v"], "at", small_changes=s)) for s in (True, False))
    assert small == large and sum(r[-1] for r in small) == 4


def test_new_columns_of_an_append_are_kept(spark):
    table = fresh(spark)
    table.append(spark.sql("SELECT 1L AS k, 'a' AS v"), "one")
    table.append(spark.sql("SELECT 2L AS k, 'b' AS v, 3 AS extra"), "two")
    assert rows(table.read()) == [(1, "a", None), (2, "b", 3)]
    with pytest.raises(ValueError, match="extra"):
        table.append(spark.sql("SELECT 2L AS k, 'b' AS v"), "three")
    with pytest.raises(ValueError, match="another type"):
        table.append(spark.sql("SELECT 2L AS k, 'b' AS v, 'x' AS extra"), "three")


def test_digits_of_any_script_are_decimals(spark):
    values = ["１２", "x１２", "१२.५", "1２", "²", "x", "-１"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for kind in ("DECIMAL(10,2)", "INT", "DOUBLE"):
        guarded = project(df, [ColumnMap("x", kind, source="v")])
        assert rows(guarded) == rows(df.select(F.expr(f"try_cast(v as {kind}) AS x")))


def test_of_two_writers_one_fails_and_undoes_nothing(spark):
    table = fresh(spark)
    table.append(spark.range(3), "a")
    other = VersionedTable(spark, table.root)
    stale = other.manifest()
    table.append(spark.range(5), "b")
    write = other._write

    def begun_before(df, old, *args, **more):
        return write(df, stale, *args, **more)

    other._write = begun_before
    commit = other._commit
    other._commit = lambda old, loads, *rest: commit(stale, loads, *rest)
    with pytest.raises(ConcurrentLoad):
        other.append(spark.range(7), "c")
    assert table.read().count() == 8 and table.manifest().loads == ("a", "b")
    VersionedTable(spark, table.root).append(spark.range(7), "c")
    assert table.read().count() == 15


def test_an_old_change_does_not_bring_a_deleted_row_back(spark):
    schema = "k int, v string, n long, op string"
    mapping = [ColumnMap("k", "INT", source="k", pk=True), ColumnMap("v", "STRING", source="v"), ColumnMap("n", "BIGINT", source="n"), ColumnMap("op", "STRING", source="op")]
    spec = LoadSpec("f", "shop.public.f", "warehouse.stg.f", Changes(["k"], "n", "op"), mapping)
    table = fresh(spark)
    old = spark.createDataFrame([(1, "a", 1, "U"), (2, "b", 2, "U")], schema)
    run_load(spec, old, table, T1)
    run_load(spec, spark.createDataFrame([(1, None, 3, "D")], schema), table, T2)
    run_load(spec, old, table, T3, load_id="again")
    assert rows(table.read().select("k", "v")) == [(2, "b")]
    run_load(spec, spark.createDataFrame([(1, "new", 4, "U")], schema), table, T3, load_id="later")
    assert rows(table.read().select("k", "v")) == [(1, "new"), (2, "b")]
    target = spark.createDataFrame([(2, "b")], "k int, v string")
    assert rows(apply_changes(target, old, ["k"], "n", "op", after=3)) == [(2, "b")]


def test_a_full_load_leaves_no_partition_behind(spark):
    path = scratch_path(spark, "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        full_load(spark.range(4).withColumn("p", F.col("id").cast("string")), path, partition_by=["p"])
        full_load(spark.sql("SELECT 9L AS id, '3' AS p"), path, partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.id for r in spark.read.parquet(path).collect()] == [9]


def test_an_empty_partition_value_is_refused(spark):
    df = spark.sql("SELECT 1 AS k, '' AS p")
    with pytest.raises(Exception, match="empty string in partition column p"):
        full_load(df, scratch_path(spark, "t"), partition_by=["p"])
    with pytest.raises(Exception, match="empty string in partition column p"):
        fresh(spark, partition_by=["p"]).replace(df, "one")


def test_two_changes_of_a_key_at_one_time_are_refused(spark):
    log = changes(spark, [(1, "a", 1), (1, "b", 1), (2, "a", 1)])
    for cell in ("auto", "day"):
        with pytest.raises(Exception, match="several changes of a key at one time"):
            scd2_rebuild(log, ["k"], ["v"], "at", cell=cell).collect()


@pytest.mark.parametrize("on_repeat", ["append", "skip", "latest"])
def test_a_coarser_target_does_not_read_rows_again(spark, on_repeat):
    source = spark.createDataFrame([(1, START + timedelta(hours=5)), (2, START + timedelta(hours=9))], "k int, at timestamp_ntz")
    mapping = [ColumnMap("k", "INT", source="k"), ColumnMap("day", "DATE", source="at")]
    spec = LoadSpec("d", "shop.public.d", "warehouse.stg.d", Incremental(["k"], "day", "at", on_repeat), mapping)
    table = fresh(spark)
    assert run_load(spec, source, table, T1).watermark == "2026-04-01 09:00:00"
    run_load(spec, source, table, T2)
    assert rows(table.read().select("k")) == [(1,), (2,)]
    assert table.read().columns == ["k", "day", "load_ts", "source_system", "record_hash"]
    more = source.unionByName(spark.createDataFrame([(3, START + timedelta(hours=10))], source.schema))
    assert run_load(spec, more, table, T3).watermark == "2026-04-01 10:00:00"
    assert rows(table.read().select("k")) == [(1,), (2,), (3,)]


def test_a_merge_into_a_table_without_a_load_time(spark):
    table = fresh(spark)
    mapping = [ColumnMap("k", "BIGINT", source="id", pk=True), ColumnMap("v", "STRING", source="v")]
    spec = LoadSpec("m", "shop.public.m", "warehouse.stg.m", Scd1(["k"]), mapping)
    first = spark.sql(
        "SELECT 1L AS k, 'a' AS v, timestamp_ntz '2026-01-01' AS load_ts, 'shop' AS source_system, 'x' AS record_hash"
    )
    table.append(first, "by hand")
    run_load(spec, spark.sql("SELECT 2L AS id, 'b' AS v"), table, T2)
    assert rows(table.read().select("k", "v")) == [(1, "a"), (2, "b")]


def test_a_bad_value_in_a_transform_is_null(spark):
    df = spark.createDataFrame([("2026-01-02", 4, 2), ("no date", 4, 0)], "d string, a int, b int")
    mapping = [ColumnMap("d", "DATE", source="d", transform="to_date($)"), ColumnMap("q", "DOUBLE", expression="a / b"), ColumnMap("n", "INT", source="d", transform="cast($ as int)", null_default="7")]
    assert rows(project(df, mapping).select(F.col("d").cast("string"), "q", "n")) == [("2026-01-02", 2.0, 7), (None, None, 7)]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    with pytest.raises(Exception, match="cannot be cast"):
        project(df, mapping, strict=True).collect()


def test_one_shuffle_of_the_log_when_no_key_is_hot(spark):
    log = changes(spark, [(k, "ab"[d % 2], d) for k in range(20) for d in range(6)]).repartition(3)

    def shuffles(**more):
        plan = scd2_rebuild(log, ["k"], ["v"], "at", **more)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning(k")

    assert shuffles() == 1
    assert "BroadcastExchange" not in scd2_rebuild(log, ["k"], ["v"], "at")._jdf.queryExecution().executedPlan().toString()
    hot = changes(spark, [(0, "ab"[d % 2], d) for d in range(200)]).unionByName(log.where("k > 0"))
    whole, split = (rows(scd2_rebuild(hot, ["k"], ["v"], "at", rows_per_task=n)) for n in (10_000, 50))
    assert whole == split and len(whole) == 200 + 19 * 6


def test_formats_of_a_catalog_are_refused_here(spark):
    spec = LoadSpec("i", "shop.public.i", "warehouse.stg.i", Scd1(["k"]), [ColumnMap("k", "INT", source="k", pk=True)], file_format="iceberg")
    with pytest.raises(ValueError, match="catalog"):
        open_table(spark, spec, scratch_path(spark, "t"))


def test_estimates_are_close(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    exact, estimated = ({r.column_name: r.distinct_count for r in profile_table(orders, distinct=d).collect()} for d in ("exact", "approx"))
    assert exact.keys() == estimated.keys()
    assert all(abs(estimated[c] - n) <= 0.15 * n for c, n in exact.items())


@pytest.mark.parametrize("buckets", [0, 4])
def test_late_changes_of_other_keys_are_taken(spark, buckets):
    """Loads of parts of a feed, in any order, leave what one load of the whole feed leaves."""
    schema = "k int, v string, n long, op string"
    mapping = [ColumnMap("k", "INT", source="k", pk=True), ColumnMap("v", "STRING", source="v"), ColumnMap("n", "BIGINT", source="n"), ColumnMap("op", "STRING", source="op")]
    spec = LoadSpec("f", "shop.public.f", "warehouse.stg.f", Changes(["k"], "n", "op"), mapping)
    parts = [
        [(1, "a", 1, "U"), (2, "b", 9, "U"), (3, "c", 5, "U"), (8, "n", None, "U")],
        [(4, "late", 2, "I"), (5, "tied", 9, "I"), (3, "newer", 6, "U"), (6, "unnumbered", None, "I"), (1, None, 4, "D"), (7, None, 7, "D"), (2, "none", None, "U")],
        [(1, "old", 3, "U"), (7, "old", 6, "I"), (3, "old", 4, "U"), (1, "old", None, "U"), (8, "m", 3, "U")],
    ]
    expected = [(2, "b"), (3, "newer"), (4, "late"), (5, "tied"), (6, "unnumbered"), (8, "m")]
    for order in ([0, 1, 2], [2, 1, 0]) if buckets else ([1, 0, 2, 1],):
        path = dict(bucket_by=["k"], buckets=buckets) if buckets else {}
        table = fresh(spark, **path)
        for i, part in enumerate(order):
            run_load(spec, spark.createDataFrame(parts[part], schema), table, T1, load_id=str(i))
        assert rows(table.read().select("k", "v")) == expected, order
        run_load(spec, spark.createDataFrame([(1, "again", 5, "I")], schema), table, T2, load_id="more")
        assert (1, "again") in rows(table.read().select("k", "v"))


@pytest.mark.parametrize("strategy", [Scd1(["k"]), Scd2(["k"], ["v"]), Full()])
def test_a_load_that_died_before_it_was_noted(spark, strategy):
    """Commit without a row in the log, as a crash between the two leaves it: the rerun notes it, once."""
    spec = LoadSpec("t", "shop.public.t", "w.d.t", strategy, [ColumnMap("k", "INT", source="k", pk=True), ColumnMap("v", "STRING", source="v")])
    table, log = VersionedTable(spark, scratch_path(spark, "t")), scratch_path(spark, "audit")
    source = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    later = spark.createDataFrame([(1, "c"), (2, "b"), (3, "d")], "k int, v string")
    run_load(spec, source, table, "2026-01-01", audit_log=log)
    done = run_load(spec, later, table, "2026-01-02")  # not noted
    run_load(spec, source, table, "2026-01-03", load_id="third")
    for _ in range(2):
        assert run_load(spec, later, table, "2026-01-02", audit_log=log).figures == {}
        noted = {r.load_id: (r.rows_written, r.closed, r.opened, r.load_ts) for r in spark.read.parquet(log).collect()}
        assert len(noted) == spark.read.parquet(log).count() == 2
        assert noted[done.load_id] == (done.figures["rows"], done.figures.get("closed"), done.figures.get("opened"), "2026-01-02 00:00:00")
