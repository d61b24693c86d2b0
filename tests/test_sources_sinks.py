from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import ColumnMap
from tidemark.plans import scratch_path
from tidemark.sinks import (
    MartSink,
    append,
    append_with_watermark,
    distributed,
    export_files,
    full_load,
    full_load_table,
    mart_columns,
    ordered,
    sink_options,
)
from tidemark.sources import Connection, Partitioning, jdbc_options, read_incremental, read_table, secret


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_incremental_filter_reaches_the_scan(spark, sf_dir):
    orders = read_table(spark, f"{sf_dir}/orders.parquet")
    part = read_incremental(orders, "o_orderdate", "1998-01-01 00:00:00")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate,1998-01-01T00:00)]" in plan(part)
    assert read_incremental(orders, "o_orderdate", None) is orders


def test_incremental_bound_is_strict(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "w int")
    assert [r.w for r in read_incremental(df, "w", 2).collect()] == [3]
    days = spark.createDataFrame([(datetime(2026, 1, d),) for d in (1, 2, 3)], "w timestamp_ntz")
    assert read_incremental(days, "w", "2026-01-02").count() == 1
    assert read_incremental(days, "w", datetime(2026, 1, 2), overlap="1 day").count() == 2


@pytest.mark.parametrize("file_format", ["parquet", "orc", "csv", "json"])
def test_file_formats(spark, file_format):
    path = scratch_path(spark, "files")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    df.write.format(file_format).save(path)
    assert sorted(map(tuple, read_table(spark, path, file_format, schema=df.schema).collect())) == [(1, "a"), (2, None)]


def test_text_formats_need_a_schema(spark):
    with pytest.raises(ValueError):
        read_table(spark, "/nowhere", "csv")
    with pytest.raises(ValueError):
        read_table(spark, "/nowhere", "xml")


def test_jdbc_options(monkeypatch, tmp_path):
    monkeypatch.setenv("SHOP_USER", "reader")
    (tmp_path / "pw").write_text("hidden\nmore\n")
    db = Connection("postgres", "db", 5432, "shop", "env:SHOP_USER", f"file:{tmp_path}/pw", {"fetchsize": "500"})
    options = jdbc_options(db, "public.orders", partitioning=Partitioning("id", 1, 1000, 16))
    assert options["url"] == "jdbc:postgresql://db:5432/shop"
    assert options["driver"] == "org.postgresql.Driver"
    assert (options["user"], options["password"]) == ("reader", "hidden")
    assert (options["partitionColumn"], options["numPartitions"], options["fetchsize"]) == ("id", "16", "500")
    assert "hidden" not in repr(db)
    assert Connection("clickhouse", "ch", 8123, "dw", "u", "p").url == "jdbc:clickhouse://ch:8123/dw"
    with pytest.raises(ValueError):
        Connection("oracle", "db", 1, "x", "u", "p")


def test_secrets(monkeypatch):
    assert secret("plain") == "plain"
    monkeypatch.delenv("NOT_SET", raising=False)
    with pytest.raises(KeyError):
        secret("env:NOT_SET")
    with pytest.raises(NotImplementedError):
        secret("vault:kv/x")


def test_full_load_replaces_and_append_adds(spark):
    path = scratch_path(spark, "table")
    full_load(spark.range(5), path)
    full_load(spark.range(3), path)
    append(spark.range(3), path)
    assert spark.read.parquet(path).count() == 6


def test_append_returns_the_watermark(spark):
    path = scratch_path(spark, "table")
    assert append_with_watermark(spark.range(5), path, "id") == 4
    assert append_with_watermark(spark.range(0), path, "id") is None
    assert spark.read.parquet(path).count() == 5


def test_partitioned_write_splits_a_hot_value_and_joins_small_ones(spark):
    """One date holds most rows: it must spread over files, small dates must not."""
    path = scratch_path(spark, "hot")
    rows = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") < 150_000, "hot").otherwise(F.concat(F.lit("d"), (F.col("id") % 5).cast("string"))).alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("body"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        full_load(rows, path, partition_by=["d"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).select("d", F.input_file_name().alias("f")).distinct().groupBy("d").count()
    counts = {r["d"]: r["count"] for r in files.collect()}
    assert counts["hot"] > 4
    assert all(n <= 2 for d, n in counts.items() if d != "hot")
    assert spark.read.parquet(path).count() == 200_000


def test_bucketed_table_joins_without_shuffling_it(spark):
    full_load_table(spark.range(1000).withColumn("v", F.col("id") * 2), "bucketed", bucket_by=["id"], buckets=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed").join(spark.range(100).withColumnRenamed("id", "k"), F.expr("id = k"), "full_outer")
        assert plan(joined).count("Exchange") == 1
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed")
    with pytest.raises(ValueError):
        full_load_table(spark.range(1), "bucketed", bucket_by=["id"])


MAPPING = [ColumnMap("id", "BIGINT", source="id", pk=True), ColumnMap("v", "STRING", source="v")]


def mart(spark):
    return spark.range(100).select("id", F.col("id").cast("string").alias("v"), F.lit(True).alias("is_current"))


def test_mart_has_mapped_columns_only(spark):
    assert mart_columns(mart(spark), MAPPING).columns == ["id", "v"]
    assert mart_columns(mart(spark), MAPPING, keep=["is_current"]).columns == ["id", "v", "is_current"]


def test_mart_layouts(spark):
    ranged = ordered(mart(spark), ["id"], 4)
    placed = ranged.select("id", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("n")).collect()
    assert [r.id for r in sorted(placed, key=lambda r: r.n)] == list(range(100))
    assert len({r.p for r in placed}) == 4
    assert "rebalance" in plan(distributed(mart(spark), ["id"], 4)).lower()
    for layout in (ordered, distributed):
        with pytest.raises(ValueError):
            layout(mart(spark), [])


def test_export_modes(spark):
    path = scratch_path(spark, "mart")
    for mode, rows in (("overwrite", 100), ("append", 200), ("overwrite", 100)):
        export_files(mart(spark), path, MAPPING, "clickhouse", ["id"], mode)
        assert spark.read.parquet(path).count() == rows
    with pytest.raises(ValueError):
        export_files(mart(spark), path, MAPPING, "clickhouse", ["id"], "ignore")


def test_sink_options():
    sink = MartSink("gp", "greenplum", "jdbc:postgresql://gp:5432/dw", "marts", "clients", "u", "p")
    options = sink_options(sink, ["id", "day"])
    assert options["dbtable"] == "marts.clients" and options["truncate"] == "true"
    assert options["createTableOptions"] == "DISTRIBUTED BY (id)"
    ch = MartSink("ch", "clickhouse", "jdbc:clickhouse://ch:8123/dw", "marts", "orders", "u", "p")
    assert sink_options(ch, ["id", "day"])["createTableOptions"] == "ENGINE = MergeTree ORDER BY (id, day)"
    with pytest.raises(ValueError):
        MartSink("x", "mysql", "u", "s", "t", "u", "p")
    with pytest.raises(ValueError):
        MartSink("x", "greenplum", "u", "s", "t", "u", "p", write_mode="ignore")
