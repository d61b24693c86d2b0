"""Version history: merge, replay, rebuild, as-of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import (
    as_of_join,
    correction_spans,
    first_versions,
    scd2_changes,
    scd2_extend,
    scd2_merge,
    scd2_place,
    scd2_rebuild,
)
from tidemark.plans import LoadSpec, Scd2, VersionedTable, run_load, scratch_path, staged
from warehouse_queries.inputs import (
    CLIENT_HISTORY_SQL,
    CLIENT_KEYS,
    CLIENT_MERGE_SQL,
    CLIENT_TRACKED,
    CLIENTS,
    EVENT_HISTORY_SQL,
    FIRST,
    SECOND,
    SYSTEM,
    clients,
    customer_second,
    table,
)

EARLY, LATER = "1995-01-01 00:00:00", "1998-06-01 00:00:00"
TECHNICAL = ["load_ts", "source_system", "record_hash"]


def first_history(spark: SparkSession, sf_dir: str, load_ts: str = FIRST) -> tuple[DataFrame, DataFrame]:
    """The client history after the first snapshot, and the second snapshot as a batch."""
    first, second = clients(spark, sf_dir)
    return first_versions(first.select(*CLIENT_KEYS, *CLIENT_TRACKED, *TECHNICAL), load_ts), second


def scd2_changed_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = first_history(spark, sf_dir)
    return scd2_changes(target, batch, CLIENT_KEYS, CLIENT_TRACKED)


def scd2_merge_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = first_history(spark, sf_dir)
    return scd2_merge(target, batch, CLIENT_KEYS, CLIENT_TRACKED, SECOND)


def scd2_merge_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = first_history(spark, sf_dir)
    return scd2_merge(target, batch, CLIENT_KEYS, CLIENT_TRACKED, SECOND, small_batch=False)


def scd2_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both snapshots through the runner, and the second one once more under another load id."""
    spec = LoadSpec(
        "dds_clients", f"{SYSTEM}.public.clients", "warehouse.dds.dim_clients",
        Scd2(CLIENT_KEYS, CLIENT_TRACKED), CLIENTS,
    )
    target = VersionedTable(spark, scratch_path(spark, "dim-clients"))
    second = customer_second(spark, sf_dir)
    run_load(spec, table(spark, sf_dir, "customer"), target, FIRST)
    run_load(spec, second, target, SECOND)
    run_load(spec, second, target, SECOND, load_id="again")
    return target.read()


def scd2_close_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = first_history(spark, sf_dir)
    return scd2_merge(target, batch, CLIENT_KEYS, CLIENT_TRACKED, SECOND, close_missing=True)


def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_rebuild(table(spark, sf_dir, "events"), ["user_id"], ["event_type"], "ts")


def event_history_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every user's rows split by the hour, without counting them first."""
    return scd2_rebuild(table(spark, sf_dir, "events"), ["user_id"], ["event_type"], "ts", cell="hour")


def _extended(spark: SparkSession, sf_dir: str, small_changes: bool | None) -> DataFrame:
    """History up to a day, then the rest of the log on top of its current rows."""
    events = table(spark, sf_dir, "events")
    day = F.lit("2024-01-20").cast("timestamp_ntz")
    past = staged(scd2_rebuild(events.where(F.col("ts") < day), ["user_id"], ["event_type"], "ts"), "event-history")
    later = events.where(F.col("ts") >= day)
    current = past.where("is_current")
    extended = scd2_extend(current, later, ["user_id"], ["event_type"], "ts", small_changes=small_changes)
    return past.where(~F.col("is_current")).unionByName(extended)


def scd2_extend_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extended(spark, sf_dir, True)


def scd2_extend_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extended(spark, sf_dir, False)


def scd2_late_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log in three parts, each with rows of all times, the last of them first."""
    events, keys, tracked = table(spark, sf_dir, "events"), ["user_id"], ["event_type"]
    parts = [events.where(F.col("event_id") % 3 == n) for n in (2, 0, 1)]
    history, log = scd2_rebuild(parts[0], keys, tracked, "ts"), parts[0]
    for part in parts[1:]:
        history = staged(history, "event-history")
        spans = staged(correction_spans(history, part, keys, "ts"), "spans")
        least = spans.agg(F.min("_low").alias("low"), F.count_if(F.col("_low").isNull()).alias("open")).first()
        since = log if least["open"] or least["low"] is None else log.where(F.col("ts") >= F.lit(least["low"]).cast("timestamp_ntz"))
        history = scd2_place(history, since, part, keys, tracked, "ts", spans=spans)
        log = log.unionByName(part)
    return history


def _order_segments(spark: SparkSession, sf_dir: str, small_dim: bool | None) -> DataFrame:
    target, batch = first_history(spark, sf_dir, EARLY)
    dim = staged(scd2_merge(target, batch, CLIENT_KEYS, CLIENT_TRACKED, LATER), "dim-clients")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("client_id"), "o_orderdate"
    )
    return as_of_join(
        orders, dim, CLIENT_KEYS, "o_orderdate", ["segment_code", "valid_from"], small_dim=small_dim
    )


def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_segments(spark, sf_dir, None)


def scd2_as_of_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_segments(spark, sf_dir, False)


def as_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the state the user was in an hour before: many versions per key."""
    events = table(spark, sf_dir, "events")
    facts = events.select(
        "event_id", "user_id", (F.col("ts") - F.expr("interval 1 hour")).alias("at")
    )
    dim = staged(event_history(spark, sf_dir), "event-history")
    return as_of_join(facts, dim, ["user_id"], "at", ["event_type"], how="inner", cell="hour", small_dim=False)


_HISTORY_AS_OF = CLIENT_HISTORY_SQL.replace(FIRST, EARLY).replace(SECOND, LATER)
_AS_OF = (
    _HISTORY_AS_OF
    + """
SELECT o.o_orderkey, CAST(o.o_custkey AS BIGINT) AS client_id, o.o_orderdate, h.segment_code, h.valid_from
FROM orders o LEFT JOIN history h
  ON o.o_custkey = h.client_id AND h.valid_from <= o.o_orderdate AND o.o_orderdate < h.valid_to
"""
)

QUERIES = {
    "scd2_changes": (
        scd2_changed_clients,
        CLIENT_MERGE_SQL
        + """
SELECT t.client_id, t.full_name AS old_full_name, t.segment_code AS old_segment_code, t.nation_id AS old_nation_id,
       s.full_name AS new_full_name, s.segment_code AS new_segment_code, s.nation_id AS new_nation_id
FROM t JOIN s ON t.client_id = s.client_id
WHERE t.full_name IS DISTINCT FROM s.full_name OR t.segment_code IS DISTINCT FROM s.segment_code
   OR t.nation_id IS DISTINCT FROM s.nation_id
""",
    ),
    "scd2_merge_clients": (scd2_merge_clients, CLIENT_HISTORY_SQL + "SELECT * FROM history"),
    "scd2_merge_shuffled": (scd2_merge_shuffled, CLIENT_HISTORY_SQL + "SELECT * FROM history"),
    "scd2_replay": (scd2_replay, CLIENT_HISTORY_SQL + "SELECT * FROM history"),
    "scd2_close_missing": (
        scd2_close_missing,
        CLIENT_HISTORY_SQL
        + f"""
SELECT client_id, full_name, segment_code, nation_id, load_ts, source_system, record_hash, valid_from,
       CASE WHEN is_current AND client_id NOT IN (SELECT client_id FROM s)
            THEN TIMESTAMP '{SECOND}' ELSE valid_to END AS valid_to,
       is_current AND client_id IN (SELECT client_id FROM s) AS is_current
FROM history
""",
    ),
    "scd2_rebuild_events": (event_history, EVENT_HISTORY_SQL + "SELECT * FROM history"),
    "scd2_rebuild_split": (event_history_split, EVENT_HISTORY_SQL + "SELECT * FROM history"),
    "scd2_late_corrections": (scd2_late_corrections, EVENT_HISTORY_SQL + "SELECT * FROM history"),
    "scd2_extend_events": (scd2_extend_events, EVENT_HISTORY_SQL + "SELECT * FROM history"),
    "scd2_extend_shuffled": (scd2_extend_shuffled, EVENT_HISTORY_SQL + "SELECT * FROM history"),
    "scd2_as_of": (scd2_as_of, _AS_OF),
    "scd2_as_of_sorted": (scd2_as_of_sorted, _AS_OF),
    "as_of_events": (
        as_of_events,
        EVENT_HISTORY_SQL
        + """
SELECT e.event_id, e.user_id, e.ts - INTERVAL 1 HOUR AS "at", h.event_type
FROM events e JOIN history h
  ON e.user_id = h.user_id AND h.valid_from <= e.ts - INTERVAL 1 HOUR AND e.ts - INTERVAL 1 HOUR < h.valid_to
""",
    ),
}
