"""Mappings, technical columns, full loads and the mart export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import Audit, ColumnMap, add_audit, project
from tidemark.operators import canonicalise
from tidemark.plans import Full, LoadSpec, VersionedTable, run_load, scratch_path
from tidemark.sinks import export_files, full_load
from tidemark.sources import read_table
from warehouse_queries.inputs import CLIENTS, FIRST, ORDER_COLUMNS_SQL, ORDERS, SYSTEM, hash_sql, table

LINES = [
    ColumnMap("order_id", "BIGINT", source="l_orderkey"),
    ColumnMap("line_number", "INT", source="l_linenumber"),
    ColumnMap(
        "net_amount",
        "DECIMAL(38,4)",
        expression="cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2)))",
    ),
    ColumnMap("speed", "STRING", expression="case when l_quantity >= 25 then 'bulk' else 'single' end"),
    ColumnMap("ship_month", "STRING", source="l_shipdate", transform="date_format($, 'yyyy-MM')"),
    ColumnMap("bad_number", "INT", source="l_returnflag", null_default="'0'"),
]


FAULTY = [
    ColumnMap("order_id", "BIGINT", source="o_orderkey"),
    ColumnMap("order_date", "DATE", expression="to_date(concat(if(o_orderkey % 7 = 0, 'x', ''), cast(o_orderdate as string)))"),
    ColumnMap("urgency", "INT", source="o_orderpriority", transform="cast(substring($, 1, o_orderkey % 3 + 1) as int)"),
    ColumnMap("share", "DOUBLE", expression="o_totalprice / (o_orderkey % 5)", null_default="-1"),
    ColumnMap("small", "SMALLINT", source="o_custkey", transform="$ * 1000"),
]


def map_orders_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "orders"), ORDERS)


def map_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "lineitem"), LINES)


def map_audit_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_audit(project(table(spark, sf_dir, "customer"), CLIENTS), FIRST, SYSTEM)


def map_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = Audit(record_hash=None, surrogate_key="client_sk")
    rows = project(table(spark, sf_dir, "customer"), CLIENTS)
    return add_audit(rows, FIRST, SYSTEM, audit, keys=["client_id"])


def map_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, numbers and divisions that cannot be, planted in transforms and expressions."""
    return project(table(spark, sf_dir, "orders"), FAULTY)


def load_orders_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily orders mart as one run: map, add technical columns, replace, read back."""
    spec = LoadSpec("dm_orders_daily", f"{SYSTEM}.public.orders", "warehouse.dm.orders_daily", Full(), ORDERS)
    mart = VersionedTable(spark, scratch_path(spark, "orders-mart"))
    run_load(spec, table(spark, sf_dir, "orders"), mart, FIRST)
    return mart.read()


def full_load_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "clients")
    rows = project(table(spark, sf_dir, "customer"), CLIENTS)
    full_load(rows.limit(0), path, "orc")  # an older state, replaced by the next line
    full_load(rows, path, "orc")
    return read_table(spark, path, "orc", schema=rows.schema)


def full_load_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    month = ColumnMap("order_month", "STRING", source="o_orderdate", transform="date_format($, 'yyyy-MM')")
    rows = project(table(spark, sf_dir, "orders"), [*ORDERS, month])
    full_load(rows, path, partition_by=["order_month"])
    return read_table(spark, path, schema=rows.schema)


def export_mart_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mart")
    loaded = add_audit(project(table(spark, sf_dir, "orders"), ORDERS), FIRST, SYSTEM)
    export_files(loaded, path, ORDERS, "clickhouse", ["order_id"])
    return read_table(spark, path)


def export_mart_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mart")
    loaded = add_audit(project(table(spark, sf_dir, "orders"), ORDERS), FIRST, SYSTEM)
    export_files(loaded, path, ORDERS, "greenplum", ["order_id"], keep=["load_ts"])
    export_files(loaded, path, ORDERS, "greenplum", ["order_id"], mode="append", keep=["load_ts"])
    return read_table(spark, path)


def canonical_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonicalise(table(spark, sf_dir, "events"), timestamp_type="TIMESTAMP_NTZ")


def canonical_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays as JSON text; the text is read back, as engines print floats differently."""
    flat = canonicalise(table(spark, sf_dir, "embeddings"))
    numbers = F.from_json("embedding", "array<float>")
    return flat.select("vec_id", "label", F.posexplode(numbers).alias("place", "number"))


def full_load_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load over one with more partitions, in a session that replaces partitions one by one."""
    path, setting = scratch_path(spark, "orders"), "spark.sql.sources.partitionOverwriteMode"
    year = ColumnMap("order_year", "STRING", source="o_orderdate", transform="date_format($, 'yyyy')")
    rows = project(table(spark, sf_dir, "orders"), [*ORDERS, year])
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        full_load(rows, path, partition_by=["order_year"])
        full_load(rows.where("order_year >= '1995'"), path, partition_by=["order_year"])
    finally:
        spark.conf.set(setting, before)
    return read_table(spark, path, schema=rows.schema)


QUERIES = {
    "map_orders_mart": (map_orders_mart, f"SELECT {ORDER_COLUMNS_SQL} FROM orders"),
    "map_expression": (
        map_expression,
        """
SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_linenumber AS INTEGER) AS line_number,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(38,4))
         AS net_amount,
       CASE WHEN l_quantity >= 25 THEN 'bulk' ELSE 'single' END AS speed,
       strftime(l_shipdate, '%Y-%m') AS ship_month,
       TRY_CAST(coalesce(l_returnflag, '0') AS INTEGER) AS bad_number
FROM lineitem
""",
    ),
    "map_audit_hash": (
        map_audit_hash,
        f"""
SELECT *, TIMESTAMP '{FIRST}' AS load_ts, '{SYSTEM}' AS source_system,
       {hash_sql([rule.target for rule in CLIENTS])} AS record_hash
FROM (SELECT CAST(c_custkey AS BIGINT) AS client_id, c_name AS full_name, lower(trim(c_mktsegment)) AS segment_code,
             CAST(c_nationkey AS INTEGER) AS nation_id, CAST(coalesce(c_acctbal, 0) AS DECIMAL(18,2)) AS balance
      FROM customer)
""",
    ),
    "map_surrogate_key": (
        map_surrogate_key,
        """
SELECT CAST(c_custkey AS BIGINT) AS client_id, c_name AS full_name, lower(trim(c_mktsegment)) AS segment_code,
       CAST(c_nationkey AS INTEGER) AS nation_id, CAST(coalesce(c_acctbal, 0) AS DECIMAL(18,2)) AS balance,
       CAST('2026-01-01' AS TIMESTAMP) AS load_ts, 'shop' AS source_system,
       sha256(concat(length(CAST(c_custkey AS VARCHAR)), ':', CAST(c_custkey AS VARCHAR))) AS client_sk
FROM customer
""",
    ),
    "load_orders_mart": (
        load_orders_mart,
        f"""
SELECT *, TIMESTAMP '{FIRST}' AS load_ts, '{SYSTEM}' AS source_system,
       {hash_sql([rule.target for rule in ORDERS])} AS record_hash
FROM (SELECT {ORDER_COLUMNS_SQL} FROM orders)
""",
    ),
    "full_load_clients": (
        full_load_clients,
        """
SELECT CAST(c_custkey AS BIGINT) AS client_id, c_name AS full_name, lower(trim(c_mktsegment)) AS segment_code,
       CAST(c_nationkey AS INTEGER) AS nation_id, CAST(coalesce(c_acctbal, 0) AS DECIMAL(18,2)) AS balance
FROM customer
""",
    ),
    "map_bad_values": (
        map_bad_values,
        """
SELECT CAST(o_orderkey AS BIGINT) AS order_id,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS order_date,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(substring(o_orderpriority, 1, 1) AS INTEGER) END AS urgency,
       CASE WHEN o_orderkey % 5 = 0 THEN -1.0 ELSE o_totalprice / (o_orderkey % 5) END AS share,
       TRY_CAST(o_custkey * 1000 AS SMALLINT) AS small
FROM orders
""",
    ),
    "full_load_replaced": (
        full_load_replaced,
        f"""SELECT {ORDER_COLUMNS_SQL}, strftime(o_orderdate, '%Y') AS order_year FROM orders
WHERE o_orderdate >= TIMESTAMP '1995-01-01'""",
    ),
    "full_load_partitioned": (
        full_load_partitioned,
        f"SELECT {ORDER_COLUMNS_SQL}, strftime(o_orderdate, '%Y-%m') AS order_month FROM orders",
    ),
    "export_mart_sorted": (export_mart_sorted, f"SELECT {ORDER_COLUMNS_SQL} FROM orders"),
    "export_mart_distributed": (
        export_mart_distributed,
        f"""
SELECT {ORDER_COLUMNS_SQL}, TIMESTAMP '{FIRST}' AS load_ts FROM orders
UNION ALL
SELECT {ORDER_COLUMNS_SQL}, TIMESTAMP '{FIRST}' AS load_ts FROM orders
""",
    ),
    "canonical_types": (
        canonical_types,
        """
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(ts AS TIMESTAMP) AS ts, CAST(user_id AS BIGINT) AS user_id,
       CAST(event_type AS VARCHAR) AS event_type, CAST(value AS DOUBLE) AS value, CAST(props AS VARCHAR) AS props
FROM events
""",
    ),
    "canonical_nested": (
        canonical_nested,
        """
SELECT vec_id, label, CAST(place AS INTEGER) AS place, embedding[place + 1] AS number
FROM (SELECT *, unnest(range(len(embedding))) AS place FROM embeddings)
""",
    ),
}
