"""Incremental loads, in-place merges and change feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import Audit, ColumnMap, add_audit, project
from tidemark.operators import (
    apply_changes,
    apply_transactions,
    incremental_append,
    latest_per_key,
    next_watermark,
    scd1_upsert,
    unloaded_rows,
)
from tidemark.plans import Changes, Incremental, KeyedLog, LoadSpec, VersionedTable, run_load, scratch_path, staged
from tidemark.sources import read_incremental
from warehouse_queries.inputs import (
    FIRST,
    ORDER_COLUMNS_SQL,
    ORDER_LOG,
    PRODUCT_KEYS,
    PRODUCT_MERGE_SQL,
    PRODUCT_TRACKED,
    SECOND,
    SYSTEM,
    hash_sql,
    products,
    table,
)

LOWER_BOUND = "1998-01-01 00:00:00"
REPLAY_FROM = "1997-12-01 00:00:00"
MIDDLE = "2024-01-15 00:00:00"
FEED_KEYS = ["user_id", "band"]


def _order_rows(df: DataFrame, load_ts: str) -> DataFrame:
    return add_audit(project(df, ORDER_LOG), load_ts, SYSTEM)


def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(read_incremental(table(spark, sf_dir, "orders"), "o_orderdate", LOWER_BOUND), ORDER_LOG)


def incremental_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(read_incremental(table(spark, sf_dir, "orders"), "o_orderdate", None), ORDER_LOG)


def _target_and_replay(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders loaded so far, and a slice that overlaps them, with some statuses changed."""
    orders = table(spark, sf_dir, "orders")
    changed = F.when(F.col("o_orderkey") % 9 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
    replay = read_incremental(orders, "o_orderdate", REPLAY_FROM).withColumn("o_orderstatus", changed)
    loaded = orders.where(F.col("o_orderdate") <= F.lit(LOWER_BOUND).cast("timestamp_ntz"))
    return _order_rows(loaded, FIRST), _order_rows(replay, SECOND)


def incremental_append_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, replay = _target_and_replay(spark, sf_dir)
    return incremental_append(target, replay)


def incremental_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, replay = _target_and_replay(spark, sf_dir)
    return incremental_append(target, replay, ["order_id"], "updated_at", ["load_ts", "record_hash"])


def incremental_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a replayed slice adds to an insert-only table."""
    target, replay = _target_and_replay(spark, sf_dir)
    return unloaded_rows(target, replay, ["order_id"], "updated_at")


def incremental_skip_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a table of one load for each two years, whose key summaries say which of them to look at."""
    target, replay = _target_and_replay(spark, sf_dir)
    log = KeyedLog(spark, scratch_path(spark, "orders-log"), ["order_id"], "updated_at")
    pair = F.floor(F.year("updated_at") / 2)
    for years in range(1990 // 2, 1999 // 2 + 1):
        log.append(target.where(pair == years), f"years-{2 * years}")
    log.append(replay, "replay")
    return log.read(["replay"]).drop("load")


def watermark_of_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_incremental(table(spark, sf_dir, "orders"), "o_orderdate", LOWER_BOUND)
    return next_watermark(project(rows, ORDER_LOG), "updated_at")


def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: the second finds its lower bound in what the first one wrote."""
    orders = table(spark, sf_dir, "orders")
    spec = LoadSpec(
        "ods_orders", f"{SYSTEM}.public.orders", "warehouse.ods.orders",
        Incremental(["order_id"], "updated_at", source_watermark="o_orderdate"), ORDER_LOG,
    )
    target = VersionedTable(spark, scratch_path(spark, "ods-orders"))
    early = orders.where(F.col("o_orderdate") <= F.lit(LOWER_BOUND).cast("timestamp_ntz"))
    run_load(spec, early, target, FIRST)
    run_load(spec, orders, target, SECOND)
    return target.read()


def incremental_date_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target that keeps the day only, loaded twice from a source with times: the second run reads nothing."""
    spec = LoadSpec(
        "ods_event_days", f"{SYSTEM}.public.events", "warehouse.ods.event_days",
        Incremental(["event_id"], "day", source_watermark="ts"),
        [ColumnMap("event_id", "BIGINT", source="event_id"), ColumnMap("day", "DATE", source="ts")],
    )
    target = VersionedTable(spark, scratch_path(spark, "event-days"))
    for load_ts in (FIRST, SECOND):
        run_load(spec, table(spark, sf_dir, "events"), target, load_ts)
    return target.read().select("event_id", "day")


def scd1_upsert_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = products(spark, sf_dir)
    return scd1_upsert(target, batch, PRODUCT_KEYS, PRODUCT_TRACKED)


def scd1_upsert_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = products(spark, sf_dir)
    return scd1_upsert(target, batch, PRODUCT_KEYS, PRODUCT_TRACKED, small_batch=False)


def scd1_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = products(spark, sf_dir)
    return scd1_upsert(target, batch, PRODUCT_KEYS)


def scd1_no_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = Audit(record_hash=None)
    target, batch = products(spark, sf_dir, audit)
    return scd1_upsert(target, batch, PRODUCT_KEYS, PRODUCT_TRACKED, audit)


def scd1_tracked_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = products(spark, sf_dir)
    return scd1_upsert(target, batch, PRODUCT_KEYS, PRODUCT_TRACKED, change_test="tracked", carry_untracked=True)


BAND_STATE = [
    ColumnMap("user_id", "BIGINT", source="user_id"),
    ColumnMap("band", "INT", source="value", transform="floor($ / 10)"),
    ColumnMap("event_type", "STRING", source="event_type"),
    ColumnMap("ts", "TIMESTAMP_NTZ", source="ts"),
]


def change_feed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed as two runs into a table."""
    return _feed_runs(spark, sf_dir, [0, 1])


def apply_changes_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the first part once more at the end: rows deleted since do not come back."""
    return _feed_runs(spark, sf_dir, [0, 1, 0])


def _feed_runs(spark: SparkSession, sf_dir: str, order: list[int]) -> DataFrame:
    """A run over each of the feed's two halves in the given order."""
    events, middle = table(spark, sf_dir, "events"), F.lit(MIDDLE).cast("timestamp_ntz")
    op = ColumnMap("op", "STRING", expression="case when event_type = 'error' then 'D' else 'U' end")
    spec = LoadSpec(
        "ods_bands", f"{SYSTEM}.public.events", "warehouse.ods.bands", Changes(FEED_KEYS, "ts", "op"), [*BAND_STATE, op]
    )
    target = VersionedTable(spark, scratch_path(spark, "bands"))
    halves = [events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)]
    for n, half in enumerate(order):
        run_load(spec, halves[half], target, FIRST if n == 0 else SECOND, load_id=f"run-{n}")
    return target.read()


def _state_and_feed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """State per user and price band from the first events; the later ones as a change feed."""
    middle = F.lit(MIDDLE).cast("timestamp_ntz")
    rows = project(table(spark, sf_dir, "events"), BAND_STATE)
    state = latest_per_key(rows.where(F.col("ts") < middle), FEED_KEYS, "ts")
    op = F.when(F.col("event_type") == "error", F.lit("D")).otherwise(F.lit("U"))
    return state, rows.where(F.col("ts") >= middle).withColumn("op", op)


def apply_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(*_state_and_feed(spark, sf_dir), FEED_KEYS, "ts", "op")


def apply_change_feed_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(*_state_and_feed(spark, sf_dir), FEED_KEYS, "ts", "op", small_feed=False)


TX_HOURS, CUTS = 6, (4_000, 9_000)
SLOT_KEYS = ["user_id", "slot"]


def transaction_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with images: each user has one row, whose key has the price band; an error removes it.

    The events of six hours are a transaction; every tenth change is delivered twice.
    """
    by_user = Window.partitionBy("user_id").orderBy("ts")
    row = F.struct("user_id", F.floor(F.col("value") / 20).alias("slot"), "event_type", "ts")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", row.alias("row"))
    images = events.select(
        "event_id",
        F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / (3600 * TX_HOURS)).alias("tx"),
        F.lag(F.when(F.col("event_type") != "error", F.col("row"))).over(by_user).alias("before"),
        F.when(F.col("event_type") != "error", F.col("row")).alias("after"),
    )
    sizes = images.groupBy("tx").agg(F.count("*").alias("size"))
    feed = images.join(sizes, "tx").select("event_id", "tx", F.col("tx").alias("commit"), "size", F.col("event_id").alias("place"), "before", "after")
    return feed.unionByName(feed.where("event_id % 10 = 0"))


def transactions_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed cut within a transaction, twice: what had to wait at the first cut comes again with the second part."""
    feed = staged(transaction_feed(spark, sf_dir), "feed")
    target = spark.createDataFrame([], "user_id long, slot long, event_type string, ts timestamp_ntz")
    waiting, start = feed.limit(0), 0
    for end in CUTS:
        arrived = waiting.unionByName(feed.where(F.col("event_id").between(start, end - 1)))
        state, left = apply_transactions(target, arrived, SLOT_KEYS)
        target, waiting, start = staged(state, "slots"), staged(left, "waiting"), end
    return target


ORDER_LOG_NAMES = [rule.target for rule in ORDER_LOG]
ORDER_LOG_SQL = f"{ORDER_COLUMNS_SQL}, o_orderdate AS updated_at"


def _order_rows_sql(source: str, load_ts: str) -> str:
    return f"""
SELECT *, TIMESTAMP '{load_ts}' AS load_ts, '{SYSTEM}' AS source_system, {hash_sql(ORDER_LOG_NAMES)} AS record_hash
FROM (SELECT {ORDER_LOG_SQL} FROM {source})
"""


REPLAY_SQL = f"""
WITH replay AS (
  SELECT * REPLACE (CASE WHEN o_orderkey % 9 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus)
  FROM orders WHERE o_orderdate > TIMESTAMP '{REPLAY_FROM}'),
loaded AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '{LOWER_BOUND}'),
appended AS ({_order_rows_sql("loaded", FIRST)} UNION ALL {_order_rows_sql("replay", SECOND)})
"""


def _upsert_sql(changed: str, assigned: list[str], columns: list[str]) -> str:
    """The merge as its two steps: update matched rows, then insert unmatched ones."""
    updated = ", ".join(
        f"CASE WHEN s.product_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" if c in assigned else f"t.{c}"
        for c in columns
    )
    inserted = ", ".join(f"s.{c}" if c in [*assigned, "product_id"] else f"NULL AS {c}" for c in columns)
    return f"""{PRODUCT_MERGE_SQL}
SELECT {updated} FROM t LEFT JOIN s ON t.product_id = s.product_id AND ({changed})
UNION ALL
SELECT {inserted} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.product_id = s.product_id)
"""


_AUDIT = ["load_ts", "source_system", "record_hash"]
_ALL = ["product_id", "name", "category", "brand", "price", "size", *_AUDIT]
_UPSERT = _upsert_sql("t.record_hash <> s.record_hash", [*PRODUCT_TRACKED, *_AUDIT], _ALL)
_DIFFERS = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in PRODUCT_TRACKED)

_FEED_SQL = f"""
WITH rows AS (
  SELECT user_id, CAST(floor(value / 10) AS INTEGER) AS band, event_type, ts FROM events),
state AS (
  SELECT * FROM rows WHERE ts < TIMESTAMP '{MIDDLE}'
  QUALIFY row_number() OVER (PARTITION BY user_id, band ORDER BY ts DESC) = 1),
feed AS (
  SELECT * FROM rows WHERE ts >= TIMESTAMP '{MIDDLE}'
  QUALIFY row_number() OVER (PARTITION BY user_id, band ORDER BY ts DESC) = 1)
SELECT * FROM feed WHERE event_type <> 'error'
UNION ALL
SELECT * FROM state WHERE NOT EXISTS (
  SELECT 1 FROM feed WHERE feed.user_id = state.user_id AND feed.band = state.band)
"""

_RUNS_SQL = f"""
SELECT *, CASE WHEN ts < TIMESTAMP '{MIDDLE}' THEN TIMESTAMP '{FIRST}' ELSE TIMESTAMP '{SECOND}' END AS load_ts,
       '{SYSTEM}' AS source_system, {hash_sql([rule.target for rule in BAND_STATE])} AS record_hash
FROM (
  SELECT user_id, CAST(floor(value / 10) AS INTEGER) AS band, event_type, ts FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, floor(value / 10) ORDER BY ts DESC) = 1)
WHERE event_type <> 'error'
"""

QUERIES = {
    "incremental_slice": (
        incremental_slice,
        f"SELECT {ORDER_LOG_SQL} FROM orders WHERE o_orderdate > TIMESTAMP '{LOWER_BOUND}'",
    ),
    "incremental_first_run": (incremental_first_run, f"SELECT {ORDER_LOG_SQL} FROM orders"),
    "incremental_append": (incremental_append_slice, REPLAY_SQL + "SELECT * FROM appended"),
    "incremental_latest": (
        incremental_latest,
        REPLAY_SQL
        + """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, load_ts DESC, record_hash DESC) AS place
  FROM appended) WHERE place = 1
""",
    ),
    "incremental_skip": (
        incremental_skip,
        REPLAY_SQL
        + f"""
SELECT * FROM appended WHERE load_ts = TIMESTAMP '{SECOND}'
AND order_id NOT IN (SELECT o_orderkey FROM loaded)
""",
    ),
    "incremental_skip_summaries": (
        incremental_skip_summaries,
        REPLAY_SQL
        + f"""
SELECT * FROM appended WHERE load_ts = TIMESTAMP '{SECOND}'
AND order_id NOT IN (SELECT o_orderkey FROM loaded)
""",
    ),
    "next_watermark": (
        watermark_of_slice,
        f"SELECT max(o_orderdate) AS next_watermark FROM orders WHERE o_orderdate > TIMESTAMP '{LOWER_BOUND}'",
    ),
    "incremental_runs": (
        incremental_runs,
        f"""
WITH early AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '{LOWER_BOUND}'),
late AS (SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM early))
{_order_rows_sql("early", FIRST)} UNION ALL {_order_rows_sql("late", SECOND)}
""",
    ),
    "scd1_upsert_products": (scd1_upsert_products, _UPSERT),
    "scd1_upsert_shuffled": (scd1_upsert_shuffled, _UPSERT),
    "scd1_all_columns": (
        scd1_all_columns,
        _upsert_sql("t.record_hash <> s.record_hash", [c for c in _ALL if c != "product_id"], _ALL),
    ),
    "scd1_no_hash": (
        scd1_no_hash,
        _upsert_sql(
            "t.load_ts <> s.load_ts", [*PRODUCT_TRACKED, *_AUDIT], [c for c in _ALL if c != "record_hash"]
        ),
    ),
    "scd1_tracked_test": (scd1_tracked_test, _upsert_sql(_DIFFERS, [c for c in _ALL if c != "product_id"], _ALL)),
    "apply_changes": (apply_change_feed, _FEED_SQL),
    "apply_changes_shuffled": (apply_change_feed_shuffled, _FEED_SQL),
    "transactions_applied": (
        transactions_applied,
        f"""
WITH log AS (
  SELECT *, CAST(floor(epoch(ts) / {3600 * TX_HOURS}) AS BIGINT) AS tx FROM events),
whole AS (
  SELECT tx FROM log GROUP BY tx HAVING count(*) = count(*) FILTER (event_id < {CUTS[-1]})),
upto AS (
  SELECT min(tx) AS horizon FROM log WHERE tx NOT IN (SELECT tx FROM whole) AND event_id < {CUTS[-1]}),
last AS (
  SELECT * FROM log WHERE tx IN (SELECT tx FROM whole) AND tx < coalesce((SELECT horizon FROM upto), 9223372036854775807)
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
SELECT user_id, CAST(floor(value / 20) AS BIGINT) AS slot, event_type, ts FROM last WHERE event_type <> 'error'
""",
    ),
    "change_feed_runs": (change_feed_runs, _RUNS_SQL),
    "apply_changes_replayed": (apply_changes_replayed, _RUNS_SQL),
    "incremental_date_watermark": (
        incremental_date_watermark, "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(ts AS DATE) AS day FROM events"
    ),
}
