"""Tables, mappings and second snapshots that the queries share, in Spark and in SQL.

The second snapshot of a table is the whole table with changes planted by key: rows that
went away, tracked values that became NULL or changed, untracked changes, and new keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import Audit, ColumnMap, add_audit, project
from tidemark.sources import read_table

FIRST = "2026-01-01 00:00:00"
SECOND = "2026-01-02 00:00:00"
SYSTEM = "shop"

CLIENTS = [
    ColumnMap("client_id", "BIGINT", source="c_custkey", pk=True),
    ColumnMap("full_name", "VARCHAR(200)", source="c_name"),
    ColumnMap("segment_code", "VARCHAR(20)", source="c_mktsegment", transform="lower(trim($))"),
    ColumnMap("nation_id", "INT", source="c_nationkey"),
    ColumnMap("balance", "DECIMAL(18,2)", source="c_acctbal", null_default="0"),
]
CLIENT_KEYS = ["client_id"]
CLIENT_TRACKED = ["full_name", "segment_code", "nation_id"]

PRODUCTS = [
    ColumnMap("product_id", "BIGINT", source="p_partkey", pk=True),
    ColumnMap("name", "VARCHAR(200)", source="p_name"),
    ColumnMap("category", "VARCHAR(80)", source="p_type"),
    ColumnMap("brand", "VARCHAR(80)", source="p_brand"),
    ColumnMap("price", "DECIMAL(18,2)", source="p_retailprice", null_default="0"),
    ColumnMap("size", "INT", source="p_size"),
]
PRODUCT_KEYS = ["product_id"]
PRODUCT_TRACKED = ["name", "category", "brand", "price"]

ORDERS = [
    ColumnMap("order_id", "BIGINT", source="o_orderkey", pk=True),
    ColumnMap("order_date", "DATE", source="o_orderdate", transform="to_date($)"),
    ColumnMap("client_id", "BIGINT", source="o_custkey"),
    ColumnMap("status", "VARCHAR(20)", source="o_orderstatus", transform="upper(trim($))"),
    ColumnMap("channel", "VARCHAR(20)", source="o_orderpriority"),
    ColumnMap("total_amount", "DECIMAL(18,2)", source="o_totalprice", null_default="0"),
]
ORDER_LOG = [*ORDERS, ColumnMap("updated_at", "TIMESTAMP_NTZ", source="o_orderdate")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def customer_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, rows = F.col("c_custkey"), table(spark, sf_dir, "customer")
    kept = rows.where(key % 11 != 0).withColumns(
        {
            "c_mktsegment": F.when(key % 17 == 0, F.lit(None))
            .when(key % 7 == 0, F.lit("VIP"))
            .otherwise(F.col("c_mktsegment")),
            "c_acctbal": F.when(key % 5 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")),
        }
    )
    return kept.unionByName(rows.where(key % 13 == 0).withColumn("c_custkey", -key - 1))


def part_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, rows = F.col("p_partkey"), table(spark, sf_dir, "part")
    dearer = (key % 7 == 0) & (key % 17 != 0)
    kept = rows.where(key % 11 != 0).withColumns(
        {
            "p_brand": F.when(key % 17 == 0, F.lit(None)).otherwise(F.col("p_brand")),
            "p_retailprice": F.when(dearer, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")),
            "p_size": F.when(key % 5 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")),
        }
    )
    return kept.unionByName(rows.where(key % 13 == 0).withColumn("p_partkey", -key - 1))


def clients(spark: SparkSession, sf_dir: str, audit: Audit = Audit()) -> tuple[DataFrame, DataFrame]:
    """Both snapshots of the client table, mapped, with technical columns."""
    first = project(table(spark, sf_dir, "customer"), CLIENTS)
    second = project(customer_second(spark, sf_dir), CLIENTS)
    return add_audit(first, FIRST, SYSTEM, audit), add_audit(second, SECOND, SYSTEM, audit)


def products(spark: SparkSession, sf_dir: str, audit: Audit = Audit()) -> tuple[DataFrame, DataFrame]:
    first = project(table(spark, sf_dir, "part"), PRODUCTS)
    second = project(part_second(spark, sf_dir), PRODUCTS)
    return add_audit(first, FIRST, SYSTEM, audit), add_audit(second, SECOND, SYSTEM, audit)


CUSTOMER_SECOND_SQL = """
customer_second AS (
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'VIP' ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_custkey % 11 <> 0
  UNION ALL
  SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 13 = 0)
"""

PART_SECOND_SQL = """
part_second AS (
  SELECT p_partkey, p_name, p_type,
         CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_brand END AS p_brand,
         CASE WHEN p_partkey % 7 = 0 AND p_partkey % 17 <> 0 THEN p_retailprice + 1 ELSE p_retailprice END
           AS p_retailprice,
         CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS p_size
  FROM part WHERE p_partkey % 11 <> 0
  UNION ALL
  SELECT -p_partkey - 1, p_name, p_type, p_brand, p_retailprice, p_size FROM part WHERE p_partkey % 13 = 0)
"""


def hash_sql(columns: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({name} AS VARCHAR), '')" for name in columns)
    return f"sha256(concat_ws('||', {parts}))"


def _client_rows(name: str, source: str, load_ts: str) -> str:
    columns = [rule.target for rule in CLIENTS]
    return f"""
{name} AS (
  SELECT *, TIMESTAMP '{load_ts}' AS load_ts, '{SYSTEM}' AS source_system, {hash_sql(columns)} AS record_hash
  FROM (SELECT CAST(c_custkey AS BIGINT) AS client_id, c_name AS full_name,
               lower(trim(c_mktsegment)) AS segment_code, CAST(c_nationkey AS INTEGER) AS nation_id,
               CAST(coalesce(c_acctbal, 0) AS DECIMAL(18,2)) AS balance
        FROM {source}))
"""


def _product_rows(name: str, source: str, load_ts: str) -> str:
    columns = [rule.target for rule in PRODUCTS]
    return f"""
{name} AS (
  SELECT *, TIMESTAMP '{load_ts}' AS load_ts, '{SYSTEM}' AS source_system, {hash_sql(columns)} AS record_hash
  FROM (SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS name, p_type AS category, p_brand AS brand,
               CAST(coalesce(p_retailprice, 0) AS DECIMAL(18,2)) AS price, CAST(p_size AS INTEGER) AS size
        FROM {source}))
"""


# t and s: target and batch of a merge.
CLIENT_MERGE_SQL = ",".join(
    ["WITH " + CUSTOMER_SECOND_SQL, _client_rows("t", "customer", FIRST), _client_rows("s", "customer_second", SECOND)]
)
PRODUCT_MERGE_SQL = ",".join(
    ["WITH " + PART_SECOND_SQL, _product_rows("t", "part", FIRST), _product_rows("s", "part_second", SECOND)]
)

ORDER_COLUMNS_SQL = """
  CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_orderdate AS DATE) AS order_date,
  CAST(o_custkey AS BIGINT) AS client_id, upper(trim(o_orderstatus)) AS status, o_orderpriority AS channel,
  CAST(coalesce(o_totalprice, 0) AS DECIMAL(18,2)) AS total_amount
"""

# The client history after both snapshots, written as the two steps of a merge: close, then insert.
CLIENT_HISTORY_SQL = (
    CLIENT_MERGE_SQL
    + f""",
opened AS (
  SELECT *, TIMESTAMP '{FIRST}' AS valid_from, TIMESTAMP '9999-12-31' AS valid_to, TRUE AS is_current FROM t),
closed AS (
  SELECT o.client_id, o.full_name, o.segment_code, o.nation_id, o.load_ts, o.source_system, o.record_hash,
         o.valid_from,
         CASE WHEN s.client_id IS NOT NULL THEN TIMESTAMP '{SECOND}' ELSE o.valid_to END AS valid_to,
         s.client_id IS NULL AS is_current
  FROM opened o LEFT JOIN s ON o.client_id = s.client_id AND o.is_current
    AND (o.full_name IS DISTINCT FROM s.full_name OR o.segment_code IS DISTINCT FROM s.segment_code
         OR o.nation_id IS DISTINCT FROM s.nation_id)),
history AS (
  SELECT * FROM closed
  UNION ALL
  SELECT s.client_id, s.full_name, s.segment_code, s.nation_id, s.load_ts, s.source_system, s.record_hash,
         TIMESTAMP '{SECOND}', TIMESTAMP '9999-12-31', TRUE
  FROM s WHERE NOT EXISTS (SELECT 1 FROM closed c WHERE c.client_id = s.client_id AND c.is_current))
"""
)

EVENT_HISTORY_SQL = """
WITH marked AS (
  SELECT user_id, event_type, ts,
         lag(event_type) OVER w IS DISTINCT FROM event_type OR row_number() OVER w = 1 AS is_change
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
history AS (
  SELECT user_id, event_type, ts AS valid_from,
         coalesce(lead(ts) OVER v, TIMESTAMP '9999-12-31') AS valid_to, lead(ts) OVER v IS NULL AS is_current
  FROM marked WHERE is_change WINDOW v AS (PARTITION BY user_id ORDER BY ts))
"""
