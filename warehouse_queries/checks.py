"""Discovery, quality checks, lineage, run audit and reconciliation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import ColumnMap, add_audit, declared_lengths, project
from tidemark.operators import (
    Versions,
    check_lengths,
    check_not_null,
    check_references,
    check_scd2,
    check_unique,
    check_write_conflicts,
    column_lineage_audit,
    dataset_lineage,
    key_candidates,
    lineage_events,
    minimal_keys,
    profile_table,
    reconcile,
    reconcile_by_ranges,
    reconcile_summary,
    run_audit,
    scd1_upsert,
    scd2_merge,
)
from tidemark.plans import LoadSpec, Scd2, VersionedTable, run_load, scratch_path, staged
from tidemark.plans.runner import AUDIT_LOG
from tidemark.sources import read_incremental
from warehouse_queries.history import event_history, first_history
from warehouse_queries.inputs import (
    CLIENT_HISTORY_SQL,
    CLIENT_KEYS,
    CLIENT_TRACKED,
    CLIENTS,
    CUSTOMER_SECOND_SQL,
    EVENT_HISTORY_SQL,
    FIRST,
    ORDER_LOG,
    PRODUCT_KEYS,
    PRODUCT_MERGE_SQL,
    SECOND,
    SYSTEM,
    customer_second,
    products,
    table,
)
from warehouse_queries.loads import LOWER_BOUND

AUDITED = [*CLIENTS, ColumnMap("segment_number", "INT", source="c_mktsegment")]
TEXTS = [
    ColumnMap("text", "VARCHAR(2000)", source="text"),
    ColumnMap("lang", "VARCHAR(2)", source="lang"),
    ColumnMap("source", "VARCHAR(3)", source="source"),
    ColumnMap("doc_id", "BIGINT", source="doc_id"),
]


def reconcile_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and a copy in which a few ranges of keys differ."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    kept = orders.where(~key.between(700, 709)).withColumn(
        "o_orderstatus", F.when(key.between(300, 420) & (key % 7 == 0), F.lit("Z")).otherwise(F.col("o_orderstatus"))
    )
    copy = kept.unionByName(orders.where(key < 4).withColumn("o_orderkey", -key - 1))
    return reconcile_by_ranges(orders, copy, ["o_orderkey"], leaf_rows=50)


def minimal_line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimal_keys(table(spark, sf_dir, "lineitem"), LINE_COLUMNS)


def minimal_order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimal_keys(table(spark, sf_dir, "orders"))


LINE_COLUMNS = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_returnflag l_shipdate".split()
ORDER_COLUMNS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()


def lattice_sql(name: str, columns: list[str], most: int = 3) -> str:
    """Every set of columns counted, and of the unique ones those that hold no other."""
    sets = [c for size in range(1, most + 1) for c in combinations(columns, size)]
    counted = " UNION ALL ".join(
        f"SELECT '{','.join(c)}' AS columns, {len(c)} AS n_columns, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(c)} FROM {name})) = count(*) "
        f"AND count(*) = count(*) FILTER ({' AND '.join(f'{x} IS NOT NULL' for x in c)}) AS is_unique FROM {name}"
        for c in sets
    )
    return f"""
WITH counted AS ({counted}),
found AS (SELECT columns, n_columns, string_split(columns, ',') AS names FROM counted WHERE is_unique)
SELECT columns, CAST(n_columns AS INTEGER) AS n_columns FROM found f
WHERE NOT EXISTS (SELECT 1 FROM found g WHERE g.n_columns < f.n_columns AND list_has_all(f.names, g.names))
"""


def profile_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project(customer_second(spark, sf_dir), CLIENTS)
    return profile_table(rows)


def profile_orders_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-pass profile, without its estimates; tests hold those against exact counts."""
    return profile_table(table(spark, sf_dir, "orders"), distinct="approx", timestamp_type="TIMESTAMP_NTZ").drop(
        "distinct_count"
    )


def lineitem_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = [
        ["l_orderkey"],
        ["l_orderkey", "l_linenumber"],
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"],
    ]
    return key_candidates(table(spark, sf_dir, "lineitem"), candidates)


def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = add_audit(project(table(spark, sf_dir, "customer"), AUDITED), FIRST, SYSTEM)
    return column_lineage_audit(customer_second(spark, sf_dir), target, AUDITED, CLIENT_KEYS)


def _loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    early = orders.where(F.col("o_orderdate") <= F.lit(LOWER_BOUND).cast("timestamp_ntz"))
    late = read_incremental(orders, "o_orderdate", LOWER_BOUND)
    first = add_audit(project(early, ORDER_LOG), FIRST, SYSTEM)
    return first.unionByName(add_audit(project(late, ORDER_LOG), SECOND, "archive"))


def _order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_lineage({"ods.orders": _loaded_orders(spark, sf_dir)}, "updated_at")


def lineage_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_edges(spark, sf_dir)


def lineage_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage_events(_order_edges(spark, sf_dir), {"ods.orders": ORDER_LOG})


def audit_of_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = first_history(spark, sf_dir)
    merged = scd2_merge(target, batch, CLIENT_KEYS, CLIENT_TRACKED, SECOND)
    return run_audit(target, merged, CLIENT_KEYS, SECOND, Versions())


def run_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the runner noted about two loads of the clients, one of them given twice."""
    spec = LoadSpec(
        "dds_clients", f"{SYSTEM}.public.clients", "warehouse.dds.dim_clients", Scd2(CLIENT_KEYS, CLIENT_TRACKED), CLIENTS
    )
    target, log = VersionedTable(spark, scratch_path(spark, "dim-clients")), scratch_path(spark, "audit-log")
    for rows, load_ts in ((table(spark, sf_dir, "customer"), FIRST), (customer_second(spark, sf_dir), SECOND)):
        for _ in range(2):
            run_load(spec, rows, target, load_ts, audit_log=log)
    return spark.read.schema(AUDIT_LOG).parquet(log).drop("watermark")


def audit_of_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = products(spark, sf_dir)
    return run_audit(target, scd1_upsert(target, batch, PRODUCT_KEYS), PRODUCT_KEYS, SECOND)


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return check_references(orders, ["o_custkey"], customer_second(spark, sf_dir), ["c_custkey"])


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_not_null(customer_second(spark, sf_dir), ["c_custkey", "c_name", "c_mktsegment"])


def dq_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_lengths(project(table(spark, sf_dir, "documents"), TEXTS), declared_lengths(TEXTS))


def dq_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event history with faults planted by user."""
    group = F.col("user_id") % 10
    hour = F.expr("interval 1 hour")
    planted = event_history(spark, sf_dir).withColumns(
        {
            "valid_to": F.when(group == 0, F.col("valid_to") + hour)
            .when(group == 1, F.col("valid_to") - hour)
            .otherwise(F.col("valid_to")),
            "is_current": F.when(group == 2, F.lit(False)).when(group == 3, F.lit(True)).otherwise(F.col("is_current")),
        }
    )
    return check_scd2(staged(planted, "event-history"), ["user_id"])


def dq_write_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = {"first": table(spark, sf_dir, "customer"), "second": customer_second(spark, sf_dir)}
    return check_write_conflicts(feeds, ["c_custkey"])


def reconcile_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = project(customer_second(spark, sf_dir), CLIENTS)
    target = project(table(spark, sf_dir, "customer"), CLIENTS)
    return reconcile(source, target, CLIENT_KEYS)


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_summary(reconcile_clients(spark, sf_dir))


_COMPARED = ["full_name", "segment_code", "nation_id", "balance"]
_STATUS_SQL = (
    CUSTOMER_SECOND_SQL
    + """,
src AS (SELECT CAST(c_custkey AS BIGINT) AS client_id, c_name AS full_name, lower(trim(c_mktsegment)) AS segment_code,
               c_nationkey AS nation_id, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer_second),
tgt AS (SELECT CAST(c_custkey AS BIGINT) AS client_id, c_name AS full_name, lower(trim(c_mktsegment)) AS segment_code,
               c_nationkey AS nation_id, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer),
compared AS (
  SELECT coalesce(src.client_id, tgt.client_id) AS client_id,
         CAST(src.client_id IS NOT NULL AS BIGINT) AS source_rows,
         CAST(tgt.client_id IS NOT NULL AS BIGINT) AS target_rows,
         CASE WHEN tgt.client_id IS NULL THEN 'missing' WHEN src.client_id IS NULL THEN 'extra'
              WHEN """
    + " OR ".join(f"src.{c} IS DISTINCT FROM tgt.{c}" for c in _COMPARED)
    + """ THEN 'changed' ELSE 'equal' END AS status
  FROM src FULL OUTER JOIN tgt ON src.client_id = tgt.client_id)
"""
)


def _profile_sql(columns: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, '{type_name}' AS column_type, count(*) AS row_count,
        count(*) - count({name}) AS null_count, CAST(min({name}) AS VARCHAR) AS min_value,
        CAST(max({name}) AS VARCHAR) AS max_value, count(DISTINCT {name}) AS distinct_count FROM {source}"""
        for name, type_name in columns.items()
    )


def _keys_sql(candidates: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS columns, (SELECT count(*) FROM lineitem) AS row_count, count(*) AS distinct_count,
        CAST(0 AS BIGINT) AS null_rows, count(*) = (SELECT count(*) FROM lineitem) AS is_key
        FROM (SELECT DISTINCT {c} FROM lineitem)"""
        for c in candidates
    )


_ISSUES_SQL = (
    EVENT_HISTORY_SQL
    + """,
planted AS (
  SELECT user_id, valid_from,
         CASE user_id % 10 WHEN 0 THEN valid_to + INTERVAL 1 HOUR WHEN 1 THEN valid_to - INTERVAL 1 HOUR
              ELSE valid_to END AS valid_to,
         CASE user_id % 10 WHEN 2 THEN FALSE WHEN 3 THEN TRUE ELSE is_current END AS is_current
  FROM history),
neighbours AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS next_from FROM planted)
SELECT user_id, valid_from, 'empty_interval' AS issue FROM neighbours WHERE valid_to <= valid_from
UNION ALL SELECT user_id, valid_from, 'overlap' FROM neighbours WHERE next_from < valid_to
UNION ALL SELECT user_id, valid_from, 'gap' FROM neighbours WHERE next_from > valid_to
UNION ALL
SELECT user_id, NULL, CASE WHEN sum(is_current::INT) = 0 THEN 'no_current' ELSE 'several_current' END
FROM planted GROUP BY user_id HAVING sum(is_current::INT) <> 1
"""
)

_LOADED_SQL = f"""
WITH loaded AS (
  SELECT o_orderdate AS updated_at, TIMESTAMP '{FIRST}' AS load_ts, '{SYSTEM}' AS upstream
  FROM orders WHERE o_orderdate <= TIMESTAMP '{LOWER_BOUND}'
  UNION ALL
  SELECT o_orderdate, TIMESTAMP '{SECOND}', 'archive' FROM orders WHERE o_orderdate > TIMESTAMP '{LOWER_BOUND}'),
edges AS (
  SELECT upstream, 'ods.orders' AS downstream, load_ts, count(*) AS row_count, min(updated_at) AS first_watermark,
         max(updated_at) AS last_watermark FROM loaded GROUP BY upstream, load_ts)
"""


def _json_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%g')"


_EVENT_SQL = (
    """'{"downstream":"ods.orders","first_watermark":"' || """
    + _json_time("first_watermark")
    + """ || '","last_watermark":"' || """
    + _json_time("last_watermark")
    + """ || '","load_ts":"' || """
    + _json_time("load_ts")
    + """ || '","row_count":' || row_count || ',"upstream":"' || upstream || '","columns":["""
    + ",".join(f'{{"source":"{rule.source}","target":"{rule.target}"}}' for rule in ORDER_LOG)
    + "]}'"
)


def _lineage_sql() -> str:
    pairs = {
        "client_id": ("c_custkey", "CAST({c} AS BIGINT)"),
        "full_name": ("c_name", "{c}"),
        "segment_code": ("c_mktsegment", "lower(trim({c}))"),
        "nation_id": ("c_nationkey", "{c}"),
        "balance": ("c_acctbal", "CAST(coalesce({c}, 0) AS DECIMAL(18,2))"),
        "segment_number": ("c_mktsegment", "TRY_CAST({c} AS INTEGER)"),
    }
    rows = " UNION ALL ".join(
        f"""SELECT '{target}' AS target_column, '{source}' AS source_column, count(*) AS rows_compared,
        count(*) FILTER ({rule.format(c="t." + source)} IS DISTINCT FROM {rule.format(c="s." + source)}) AS mismatches,
        count(*) FILTER ({rule.format(c="s." + source)} IS NULL AND s.{source} IS NOT NULL) AS nulls_produced
        FROM customer t JOIN customer_second s ON t.c_custkey = s.c_custkey"""
        for target, (source, rule) in pairs.items()
    )
    return f"WITH {CUSTOMER_SECOND_SQL} {rows}"


QUERIES = {
    "profile_table": (
        profile_customer,
        f"WITH {CUSTOMER_SECOND_SQL}, "
        """p AS (SELECT CAST(c_custkey AS BIGINT) AS client_id, c_name AS full_name,
        lower(trim(c_mktsegment)) AS segment_code, c_nationkey AS nation_id,
        CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer_second)"""
        + _profile_sql(
            {
                "client_id": "BIGINT",
                "full_name": "STRING",
                "segment_code": "STRING",
                "nation_id": "INT",
                "balance": "DECIMAL(38,9)",
            },
            "p",
        ),
    ),
    "profile_table_approx": (
        profile_orders_approx,
        " UNION ALL ".join(
            f"""SELECT '{name}' AS column_name, '{kind}' AS column_type, count(*) AS row_count,
            count(*) - count({name}) AS null_count, CAST(min({name}) AS VARCHAR) AS min_value,
            CAST(max({name}) AS VARCHAR) AS max_value FROM orders"""
            for name, kind in (
                ("o_orderkey", "BIGINT"),
                ("o_custkey", "BIGINT"),
                ("o_orderstatus", "STRING"),
                ("o_totalprice", "DOUBLE"),
                ("o_orderdate", "TIMESTAMP_NTZ"),
                ("o_orderpriority", "STRING"),
            )
        ),
    ),
    "key_candidates": (
        lineitem_keys,
        _keys_sql(
            [
                "l_orderkey",
                "l_orderkey,l_linenumber",
                "l_orderkey,l_linenumber,l_partkey,l_suppkey",
                "l_orderkey,l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_shipdate",
            ]
        ),
    ),
    "lineage_columns": (lineage_columns, _lineage_sql()),
    "lineage_datasets": (lineage_datasets, _LOADED_SQL + "SELECT * FROM edges"),
    "lineage_events": (
        lineage_documents,
        _LOADED_SQL + f"SELECT downstream, upstream, load_ts, {_EVENT_SQL} AS event FROM edges",
    ),
    "run_audit": (
        audit_of_history,
        CLIENT_HISTORY_SQL
        + f"""
SELECT TIMESTAMP '{SECOND}' AS load_ts,
  (SELECT count(*) FROM s WHERE client_id NOT IN (SELECT client_id FROM t)) AS inserted,
  (SELECT count(*) FROM history WHERE NOT is_current) AS updated,
  (SELECT count(*) FROM history WHERE NOT is_current) AS closed,
  (SELECT count(*) FROM history WHERE is_current AND valid_from < TIMESTAMP '{SECOND}') AS unchanged
""",
    ),
    "run_audit_log": (
        run_audit_log,
        CLIENT_HISTORY_SQL
        + f"""
SELECT 'dds_clients@{FIRST}' AS load_id, 'warehouse.dds.dim_clients' AS target, 'scd2' AS strategy, '{FIRST}' AS load_ts,
       count(*) AS rows_written, CAST(0 AS BIGINT) AS closed, count(*) AS opened FROM t
UNION ALL
SELECT 'dds_clients@{SECOND}', 'warehouse.dds.dim_clients', 'scd2', '{SECOND}', count(*),
       count(*) FILTER (NOT is_current), count(*) FILTER (valid_from = TIMESTAMP '{SECOND}') FROM history
""",
    ),
    "run_audit_upsert": (
        audit_of_upsert,
        PRODUCT_MERGE_SQL
        + f"""
SELECT TIMESTAMP '{SECOND}' AS load_ts,
  (SELECT count(*) FROM s WHERE product_id NOT IN (SELECT product_id FROM t)) AS inserted,
  (SELECT count(*) FROM s JOIN t USING (product_id) WHERE s.record_hash <> t.record_hash) AS updated,
  CAST(0 AS BIGINT) AS closed,
  (SELECT count(*) FROM t) - (SELECT count(*) FROM s JOIN t USING (product_id) WHERE s.record_hash <> t.record_hash)
    AS unchanged
""",
    ),
    "dq_unique": (
        dq_unique,
        "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    ),
    "dq_orphans": (
        dq_orphans,
        f"""WITH {CUSTOMER_SECOND_SQL}
SELECT o_custkey, count(*) AS row_count FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer_second WHERE c_custkey = o_custkey) GROUP BY o_custkey""",
    ),
    "dq_not_null": (
        dq_not_null,
        f"WITH {CUSTOMER_SECOND_SQL}"
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS null_count
            FROM customer_second"""
            for c in ("c_custkey", "c_name", "c_mktsegment")
        ),
    ),
    "dq_lengths": (
        dq_lengths,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, CAST({n} AS BIGINT) AS max_length, CAST(max(length({c})) AS BIGINT) AS longest,
            count(*) FILTER (length({c}) > {n}) AS too_long FROM documents"""
            for c, n in (("text", 2000), ("lang", 2), ("source", 3))
        ),
    ),
    "dq_scd2": (dq_scd2, _ISSUES_SQL),
    "dq_write_conflicts": (
        dq_write_conflicts,
        f"""WITH {CUSTOMER_SECOND_SQL},
written AS (SELECT c_custkey, 1 AS feed FROM customer UNION ALL SELECT c_custkey, 2 FROM customer_second)
SELECT c_custkey, CAST(count(DISTINCT feed) AS INTEGER) AS feed_count, count(*) AS row_count
FROM written GROUP BY c_custkey HAVING count(DISTINCT feed) > 1""",
    ),
    "minimal_line_keys": (minimal_line_keys, lattice_sql("lineitem", LINE_COLUMNS)),
    "minimal_order_keys": (minimal_order_keys, lattice_sql("orders", ORDER_COLUMNS)),
    "reconcile_by_ranges": (
        reconcile_copy,
        """
WITH copy AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey BETWEEN 300 AND 420 AND o_orderkey % 7 = 0 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice FROM orders WHERE o_orderkey NOT BETWEEN 700 AND 709
  UNION ALL
  SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey < 4)
SELECT coalesce(o.o_orderkey, c.o_orderkey) AS o_orderkey, CAST(o.o_orderkey IS NOT NULL AS BIGINT) AS source_rows,
       CAST(c.o_orderkey IS NOT NULL AS BIGINT) AS target_rows,
       CASE WHEN c.o_orderkey IS NULL THEN 'missing' WHEN o.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS status
FROM orders o FULL JOIN copy c ON o.o_orderkey = c.o_orderkey
WHERE o.o_orderkey IS NULL OR c.o_orderkey IS NULL OR o.o_custkey IS DISTINCT FROM c.o_custkey
   OR o.o_orderstatus IS DISTINCT FROM c.o_orderstatus OR o.o_totalprice IS DISTINCT FROM c.o_totalprice
""",
    ),
    "reconcile": (reconcile_clients, f"WITH {_STATUS_SQL} SELECT * FROM compared"),
    "reconcile_summary": (
        reconcile_counts,
        f"WITH {_STATUS_SQL} SELECT "
        + ", ".join(
            f"count(*) FILTER (status = '{s}') AS {s}_keys" for s in ("missing", "extra", "changed", "equal")
        )
        + " FROM compared",
    ),
}
