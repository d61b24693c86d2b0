from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import Audit, ColumnMap
from tidemark.operators import BatchRefused, Versions, check_scd2
from tidemark.plans import (
    Changes,
    Full,
    Incremental,
    LoadSpec,
    Scd1,
    Scd2,
    VersionedTable,
    cluster_settings,
    extract,
    load_connection,
    load_spec,
    open_table,
    run_load,
    scratch_path,
    shared_folder,
    shuffle_partitions,
    staging,
)

T1, T2, T3 = "2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00"
MAPPING = [
    ColumnMap("k", "BIGINT", source="id", pk=True),
    ColumnMap("a", "STRING", source="a", transform="upper($)"),
    ColumnMap("w", "TIMESTAMP_NTZ", source="changed_at"),
]


def spec(strategy, mapping=MAPPING, **more):
    return LoadSpec("t", "shop.public.t", "warehouse.stg.t", strategy, mapping, **more)


def source(spark, data):
    return spark.createDataFrame(
        [(k, a, datetime(2026, 1, d)) for k, a, d in data], "id int, a string, changed_at timestamp_ntz"
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def fresh(spark, **options):
    return VersionedTable(spark, scratch_path(spark, "t"), **options)


# specs


@pytest.mark.parametrize(
    "bad",
    [
        lambda: spec(Scd1([])),
        lambda: spec(Scd1(["nope"])),
        lambda: spec(Scd1(["k"], ["nope"])),
        lambda: spec(Scd2(["k"], [])),
        lambda: spec(Scd2(["k"], ["a"]), [*MAPPING, ColumnMap("valid_from", "DATE", source="x")]),
        lambda: spec(Incremental(["k"], "nope")),
        lambda: spec(Full(), []),
        lambda: spec(Full(), [MAPPING[0], MAPPING[0]]),
        lambda: spec(Full(), layer="gold"),
        lambda: LoadSpec("T", "shop.public.t", "x", Full(), MAPPING),
        lambda: LoadSpec("t", "shop.t", "x", Full(), MAPPING),
    ],
)
def test_contradictory_specs_are_refused(bad):
    with pytest.raises(ValueError):
        bad()


def test_primary_keys():
    assert spec(Full()).primary_keys == ["k"]
    assert spec(Scd1(["a"])).primary_keys == ["a"]
    assert spec(Full()).source_system == "shop" and spec(Full()).source_table == "public.t"


DOCUMENT = {
    "apiVersion": "v1",
    "kind": "Entity",
    "metadata": {"name": "dds_clients", "layer": "dds", "owner": "team", "tags": ["dim"]},
    "source": {"ref": "shop.public.clients"},
    "target": {"schema": "dds", "table": "dim_clients", "format": "parquet", "partition_by": ["is_current"]},
    "load": {"strategy": "scd2", "business_keys": ["client_id"], "tracked_columns": ["email"], "current_flag": "is_open"},
    "mapping": [
        {"target": "client_id", "type": "BIGINT", "source": "id", "pk": True},
        {"target": "email", "type": "VARCHAR(160)", "source": "email", "transform": "lower(trim($))"},
    ],
    "audit": {"record_hash_column": None},
    "sinks": [
        {
            "name": "gp", "kind": "greenplum", "jdbc_url": "jdbc:postgresql://gp/dw", "schema": "marts",
            "table": "clients", "user": "env:U", "password": "env:P",
        }
    ],
}


def test_spec_from_a_document():
    found = load_spec(DOCUMENT)
    assert found.strategy == Scd2(("client_id",), ("email",), Versions(is_current="is_open"))
    assert found.target == "warehouse.dds.dim_clients" and found.audit == Audit(record_hash=None)
    assert found.sinks[0].kind == "greenplum" and found.partition_by == ("is_current",)
    for load, kind in (
        ({"strategy": "full"}, Full()),
        ({"strategy": "incremental", "business_keys": ["client_id"], "watermark_column": "email"},
         Incremental(("client_id",), "email")),
        ({"strategy": "scd1", "business_keys": ["client_id"]}, Scd1(("client_id",))),
    ):
        assert load_spec({**DOCUMENT, "load": load}).strategy == kind


@pytest.mark.parametrize(
    "change",
    [
        {"kind": "Job"},
        {"surprise": 1},
        {"load": {"strategy": "upsert"}},
        {"load": {"strategy": "full", "business_keys": ["client_id"]}},
        {"metadata": {"name": "x", "layer": "dds", "colour": "red"}},
    ],
)
def test_bad_documents_are_refused(change):
    with pytest.raises(ValueError):
        load_spec({**DOCUMENT, **change})


def test_connection_from_a_document():
    connection = {"kind": "postgres", "host": "db", "port": 5432, "database": "shop", "user": "env:U", "password": "env:P"}
    name, found = load_connection({"name": "shop", "connection": connection})
    assert (name, found.url) == ("shop", "jdbc:postgresql://db:5432/shop")
    with pytest.raises(ValueError):
        load_connection({"name": "shop", "connection": {**connection, "pool": 3}})
    with pytest.raises(KeyError):
        extract(None, spec(Full()), {})


def test_cluster_settings_size_the_shuffle():
    assert shuffle_partitions(0.1) == 8
    assert shuffle_partitions(100 * 1024) == 409_600
    assert cluster_settings(1024)["spark.sql.shuffle.partitions"] == "4096"


# tables


def test_reading_before_the_first_load(spark):
    table = fresh(spark)
    assert table.manifest() is None and not table.has_load("x")
    with pytest.raises(ValueError):
        table.read()


def test_append_and_replace(spark):
    table = fresh(spark, partition_by=["p"])
    df = spark.range(6).select("id", (F.col("id") % 2).cast("string").alias("p"))
    assert table.append(df, "one", T1, "id") == {"rows": 6, "watermark": "5"}
    assert table.append(df, "one", T1, "id") == {}
    table.append(df.limit(0), "none", T2, "id")
    assert table.manifest().watermark == "5" and table.read().count() == 6
    table.append(df, "two", T2)
    assert table.read().count() == 12 and table.read().dtypes == df.dtypes
    old = table.manifest()
    table.replace(df.where("id = 1"), "three", T3)
    assert rows(table.read()) == [(1, "1")]
    assert table.read(old).count() == 12  # readers of the older state are not disturbed
    assert table.expired_paths() == [f"{table.root}/data/{p}" for p in old.paths]


def test_a_load_that_dies_before_its_commit_leaves_no_trace(spark, monkeypatch):
    table = fresh(spark)
    table.replace(spark.range(3), "one")

    def die(self, *args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "_commit", die)
        with pytest.raises(RuntimeError):
            table.replace(spark.range(50), "two")
    spark.range(1).write.mode("overwrite").parquet(f"{table.root}/manifest/2/_temporary/0")  # a torn commit
    assert table.read().count() == 3 and not table.has_load("two")
    table.replace(spark.range(7), "two")
    assert table.read().count() == 7


def test_table_arguments(spark):
    with pytest.raises(ValueError):
        fresh(spark, bucket_by=["k"])
    with pytest.raises(ValueError):
        fresh(spark, bucket_by=["k"], buckets=4, partition_by=["p"])


def test_buckets_are_part_of_a_table(spark):
    table = fresh(spark, bucket_by=["k"], buckets=4)
    run_load(spec(Scd1(["k"])), source(spark, [(1, "a", 1)]), table, T1)
    for options in ({}, {"bucket_by": ["k"], "buckets": 8}):
        with pytest.raises(ValueError):
            VersionedTable(spark, table.root, **options).read()
    for change in (table.replace, table.append):
        with pytest.raises(ValueError):
            change(spark.range(1), "x")


def test_staged_rows_are_removed_after_a_load(spark):
    with staging(spark.range(5), "few") as rows_of_load:
        folder = rows_of_load.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert rows_of_load.count() == 5 and os.path.exists(folder)
    assert not os.path.exists(folder)


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark) + "/")
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


class Session:
    """As much of a session as the shared folder looks at."""

    def __init__(self, master, setting=None):
        self.master, self.folder = master, None
        self.sparkContext = self
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_without_a_setting():
    assert shared_folder(Session("yarn", "s3a://shared/tmp/")) == "s3a://shared/tmp"
    with pytest.raises(RuntimeError):
        shared_folder(Session("yarn"))
    local = Session("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.folder


# runs


def test_full_run(spark):
    table = fresh(spark)
    result = run_load(spec(Full()), source(spark, [(1, "a", 1), (2, "b", 2)]), table, T1)
    assert result.figures == {"rows": 2}
    assert rows(table.read().select("k", "a", "source_system")) == [(1, "A", "shop"), (2, "B", "shop")]
    run_load(spec(Full()), source(spark, [(3, "c", 1)]), table, T2)
    assert rows(table.read().select("k")) == [(3,)]


def test_incremental_runs_follow_the_watermark(spark):
    strategy = Incremental(["k"], "w", source_watermark="changed_at")
    table = fresh(spark)
    first = run_load(spec(strategy), source(spark, [(1, "a", 1), (2, "b", 2)]), table, T1)
    assert first.watermark == "2026-01-02 00:00:00"
    everything = source(spark, [(1, "a", 1), (2, "b", 2), (2, "B", 3)])
    second = run_load(spec(strategy), everything, table, T2)
    assert second.figures["rows"] == 1 and second.watermark == "2026-01-03 00:00:00"
    assert run_load(spec(strategy), everything, table, T2).figures == {}  # the same run again
    assert run_load(spec(strategy), everything, table, T3).figures["rows"] == 0
    assert table.read().count() == 3


@pytest.mark.parametrize("options", [{}, {"bucket_by": ["k"], "buckets": 4}])
def test_incremental_run_keeping_the_latest(spark, options):
    strategy = Incremental(["k"], "w", source_watermark="changed_at", on_repeat="latest", overlap="2 days")
    table = fresh(spark, **options)
    run_load(spec(strategy), source(spark, [(1, "a", 1), (2, "b", 2)]), table, T1)
    second = run_load(spec(strategy), source(spark, [(2, "late", 2), (2, "B", 3), (5, "old", 1)]), table, T2)
    assert rows(table.read().select("k", "a")) == [(1, "A"), (2, "B"), (5, "OLD")]
    assert second.watermark == "2026-01-03 00:00:00"
    run_load(spec(strategy), source(spark, []), table, T3)
    assert table.read().count() == 3 and table.manifest().watermark in (None, "2026-01-03 00:00:00")


def test_incremental_run_skipping_what_is_there(spark):
    strategy = Incremental(["k"], "w", source_watermark="changed_at", on_repeat="skip", overlap="2 days")
    table = fresh(spark)
    run_load(spec(strategy), source(spark, [(1, "a", 1), (2, "b", 2), (2, "b", 1)]), table, T1)
    before = table.manifest().paths
    run_load(spec(strategy), source(spark, [(2, "again", 2), (3, "c", 3), (3, "c", 2)]), table, T2)
    assert rows(table.read().select("k", "a")) == [(1, "A"), (2, "B"), (3, "C")]
    assert table.manifest().paths[: len(before)] == before  # appended, not rewritten
    with pytest.raises(ValueError):
        spec(Incremental(["k"], "w", on_repeat="guess"))


@pytest.mark.parametrize("options", [{}, {"bucket_by": ["k"], "buckets": 4}])
def test_scd1_runs(spark, options):
    table = fresh(spark, **options)
    run_load(spec(Scd1(["k"])), source(spark, [(k, "a", 1) for k in range(20)]), table, T1)
    before = set(table.manifest().paths)
    run_load(spec(Scd1(["k"])), source(spark, [(1, "b", 1), (99, "n", 1)]), table, T2)
    found = {r.k: r.a for r in table.read().collect()}
    assert len(found) == 21 and found[1] == "B" and found[99] == "N" and found[2] == "A"
    if options:  # untouched buckets keep their files
        assert before & set(table.manifest().paths)


@pytest.mark.parametrize("options", [{}, {"bucket_by": ["k"], "buckets": 4}])
def test_scd2_runs(spark, options):
    strategy = Scd2(["k"], ["a"])
    table = fresh(spark, **options)
    first = run_load(spec(strategy), source(spark, [(k, "a", 1) for k in range(20)]), table, T1)
    assert first.figures == {"rows": 20, "current": 20, "closed": 0, "opened": 20}
    one = run_load(spec(strategy), source(spark, [(1, "b", 1), (2, "a", 1), (99, "n", 1)]), table, T2)
    assert one.figures["closed"] == 1 and one.figures["opened"] == 2
    state = rows(table.read())
    history = [p for p in table.manifest().paths if "is_current=false" in p]
    again = run_load(spec(strategy), source(spark, [(1, "b", 1), (2, "a", 1), (99, "n", 1)]), table, T2, load_id="again")
    assert again.figures["closed"] == 0 and rows(table.read()) == state
    run_load(spec(strategy), source(spark, [(1, "c", 1)]), table, T3)
    assert set(history) < set(table.manifest().paths)  # older history is listed again, not rewritten
    assert check_scd2(table.read(), ["k"]).isEmpty()
    assert table.read().where("k = 1").count() == 3 and table.current().count() == 21
    assert "is_current=false" not in " ".join(table.current().inputFiles())


@pytest.mark.parametrize("options", [{}, {"bucket_by": ["k"], "buckets": 4}])
def test_change_feed_runs(spark, options):
    mapping = [*MAPPING, ColumnMap("op", "STRING", source="op")]
    strategy = Changes(["k"], "w", "op")

    def feed(data):
        return source(spark, [d[:3] for d in data]).withColumn(
            "op", F.element_at(F.create_map(*[F.lit(x) for d in data for x in (d[0] * 100 + d[2], d[3])]),
                               F.col("id") * 100 + F.dayofmonth("changed_at"))
        )

    table = fresh(spark, **options)
    run_load(spec(strategy, mapping), feed([(k, "a", 1, "I") for k in range(8)] + [(1, "b", 2, "U")]), table, T1)
    assert "op" not in table.read().columns and table.read().count() == 8
    gone = feed([(k, "x", 3, "D") for k in range(1, 8)] + [(9, "n", 3, "I"), (0, "stale", 0 + 1, "U")])
    run_load(spec(strategy, mapping), gone, table, T2)
    assert rows(table.read().select("k", "a")) == [(0, "A"), (9, "N")]
    with pytest.raises(BatchRefused):
        run_load(spec(strategy, mapping), source(spark, [(None, "a", 1)]).withColumn("op", F.lit("I")), table, T3)


@pytest.mark.parametrize("options", [{}, {"bucket_by": ["k"], "buckets": 4}])
def test_scd2_run_closing_missing_keys(spark, options):
    strategy = Scd2(["k"], ["a"], close_missing=True, carry_untracked=True)
    table = fresh(spark, **options)
    run_load(spec(strategy), source(spark, [(k, "a", 1) for k in range(8)]), table, T1)
    run_load(spec(strategy), source(spark, [(1, "a", 2)]), table, T2)
    assert [r.k for r in table.current().collect()] == [1]
    assert table.read().count() == 8 and table.read().where("w is null").isEmpty()
    run_load(spec(strategy), source(spark, [(2, "a", 3)]), table, T3)
    assert rows(table.read().where("k = 2").select("is_current")) == [(False,), (True,)]


@pytest.mark.parametrize("buckets", [8, 5])
def test_a_merge_writes_few_files(spark, buckets):
    """4 shuffle partitions: 8 buckets fall into whole tasks, 5 need to be brought together."""
    table = fresh(spark, bucket_by=["k"], buckets=buckets)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for ts, letter in ((T1, "a"), (T2, "b")):
            run_load(spec(Scd1(["k"])), source(spark, [(k, letter, 1) for k in range(400)]), table, ts)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(table.read().inputFiles()) == buckets
    assert rows(table.read().groupBy("a").count()) == [("B", 400)]


def test_partitions_are_kept_by_every_strategy(spark):
    for strategy in (Full(), Incremental(["k"], "w", "changed_at"), Scd1(["k"]), Scd2(["k"], ["a", "w"])):
        found = spec(strategy, partition_by=("a",))
        table = open_table(spark, found, scratch_path(spark, "t"))
        run_load(found, source(spark, [(1, "a", 1), (2, "b", 1)]), table, T1)
        run_load(found, source(spark, [(1, "c", 2), (2, "b", 2)]), table, T2)
        assert any("/a=C/" in name for name in table.read().inputFiles())
        assert "C" in {r.a for r in table.read().collect()}
    bucketed = open_table(spark, spec(Scd1(["k"])), scratch_path(spark, "t"), buckets=4)
    assert (bucketed.bucket_by, bucketed.buckets, bucketed.file_format) == (["k"], 4, "parquet")


def test_plain_and_history_tables_are_not_mixed_up(spark):
    plain, history = fresh(spark), fresh(spark)
    run_load(spec(Full()), source(spark, [(1, "a", 1)]), plain, T1)
    run_load(spec(Scd2(["k"], ["a"])), source(spark, [(1, "a", 1)]), history, T1)
    with pytest.raises(ValueError):
        run_load(spec(Scd2(["k"], ["a"])), source(spark, [(1, "a", 1)]), plain, T2)
    with pytest.raises(ValueError):
        history.append(history.read(), "x")
    assert plain.read().count() == history.read().count() == 1


def test_bucketed_merge_reads_touched_buckets_only(spark):
    table = fresh(spark, bucket_by=["k"], buckets=8)
    run_load(spec(Scd1(["k"])), source(spark, [(k, "a", 1) for k in range(40)]), table, T1)
    batch = spark.createDataFrame([(3,)], "k int")  # another type than the table's BIGINT
    touched = table.touched_buckets(batch, table.manifest())
    assert len(touched) == 1
    read = table.read(buckets=touched)
    assert read.where("k = 3").count() == 1 and read.count() < 40
    assert all(f"key_bucket={touched[0]}/" in name for name in read.inputFiles())


def test_bad_batches_and_old_load_times_are_refused(spark):
    table = fresh(spark)
    strategy = Scd2(["k"], ["a"])
    run_load(spec(strategy), source(spark, [(1, "a", 1)]), table, T2)
    with pytest.raises(BatchRefused):
        run_load(spec(strategy), source(spark, [(1, "a", 1), (1, "b", 1)]), table, T3)
    with pytest.raises(BatchRefused):
        run_load(spec(strategy), source(spark, [(None, "a", 1)]), table, T3)
    with pytest.raises(ValueError):
        run_load(spec(strategy), source(spark, [(1, "b", 1)]), table, T1)
    assert table.read().count() == 1


@pytest.mark.parametrize("strategy", [Scd1(["k"], latest_by="w"), Scd2(["k"], ["a"], latest_by="w")])
def test_repeated_keys_can_be_cut_to_the_latest(spark, strategy):
    table = fresh(spark)
    run_load(spec(strategy), source(spark, [(1, "a", 1), (1, "b", 3), (1, "c", 2)]), table, T1)
    assert rows(table.read().select("k", "a")) == [(1, "B")]


def test_surrogate_key_is_loaded(spark):
    table = fresh(spark)
    audited = spec(Scd2(["k"], ["a"]), audit=Audit(surrogate_key="sk"))
    run_load(audited, source(spark, [(1, "a", 1), (2, "b", 1)]), table, T1)
    run_load(audited, source(spark, [(1, "z", 1)]), table, T2)
    keys = {(r.k, r.sk) for r in table.read().collect()}
    assert len(keys) == 2 and None not in {sk for _, sk in keys}


def test_manifest_lists_loads(spark):
    table = fresh(spark)
    run_load(spec(Full()), source(spark, [(1, "a", 1)]), table, T1)
    run_load(spec(Full()), source(spark, [(1, "a", 1)]), table, "2026-01-02T03:00:00+03:00")
    manifest = table.manifest()
    assert manifest.loads == ("t@2026-01-01 00:00:00", "t@2026-01-02 00:00:00")
    assert json.loads(manifest.schema.json())["fields"][0]["name"] == "k"
