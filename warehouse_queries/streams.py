"""Streaming loads, run to the end over what has arrived in a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import project
from tidemark.plans import KeyedLog, VersionedTable, scratch_path
from tidemark.streaming import (
    append_stream,
    state_on_disk,
    stream_append,
    stream_incremental,
    stream_keyed_append,
    stream_scd2,
    stream_versions,
    versions_of,
)
from warehouse_queries.inputs import (
    CLIENT_HISTORY_SQL,
    CLIENT_KEYS,
    CLIENT_MERGE_SQL,
    CLIENT_TRACKED,
    CLIENTS,
    FIRST,
    SECOND,
    customer_second,
    table,
)

AFTER = "2026-01-03 00:00:00"


def stream_incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that landed twice, appended once."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "events")
    events = table(spark, sf_dir, "events")
    events.write.parquet(landing)
    events.write.mode("append").parquet(landing)
    arriving = spark.readStream.schema(events.schema).parquet(landing)
    once = stream_incremental(arriving, ["event_id"], "ts", "40 days")
    append_stream(once, out, scratch_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(events.schema).parquet(out)


def stream_append_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with keys looked up in the table: copies may be any time apart."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    target = VersionedTable(spark, scratch_path(spark, "events"))
    events = table(spark, sf_dir, "events")
    for _ in range(2):
        events.write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(events.schema).parquet(landing)
        stream_append(arriving, target, checkpoint, ["event_id"], "ts").awaitTermination()
    return target.read()


def stream_append_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings that overlap by a third, with keys looked up by the summaries of what was appended."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    log = KeyedLog(spark, scratch_path(spark, "events-log"), ["event_id"], "ts")
    events = table(spark, sf_dir, "events")
    for part in (events.where("event_id % 3 <> 0"), events.where("event_id % 3 <> 1")):
        part.write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(events.schema).parquet(landing)
        stream_keyed_append(arriving, log, checkpoint).awaitTermination()
    return log.read().drop("load")


def stream_append_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with checkpoints of their own, one after the other, into one table."""
    target = VersionedTable(spark, scratch_path(spark, "events"))
    events = table(spark, sf_dir, "events")
    for part in (events.where("event_id % 3 = 0"), events.where("event_id % 3 <> 0")):
        landing = scratch_path(spark, "landing")
        part.write.parquet(landing)
        arriving = spark.readStream.schema(events.schema).parquet(landing)
        stream_append(arriving, target, scratch_path(spark, "checkpoint"), ["event_id"], "ts").awaitTermination()
    return target.read()


def stream_scd2_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first snapshot seen twice, then the second as of a time between: what it says of known clients is late."""
    landing, late = scratch_path(spark, "landing"), scratch_path(spark, "late")
    tracked = [rule for rule in CLIENTS if rule.target in (*CLIENT_KEYS, *CLIENT_TRACKED)]
    target, checkpoint = VersionedTable(spark, scratch_path(spark, "dim-clients")), scratch_path(spark, "checkpoint")
    first, second = (project(t, tracked) for t in (table(spark, sf_dir, "customer"), customer_second(spark, sf_dir)))
    for rows, times in ((first, [FIRST, AFTER]), (second, [SECOND])):
        for seen in times:
            landed = rows.withColumn("seen_at", F.lit(seen).cast("timestamp_ntz"))
            landed.write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(landed.schema).parquet(landing)
        stream_scd2(
            arriving, target, checkpoint, CLIENT_KEYS, CLIENT_TRACKED, "seen_at", late_path=late
        ).awaitTermination()
    placed = target.read().select(*CLIENT_KEYS, *CLIENT_TRACKED, "valid_from", "last_seen", F.lit(False).alias("is_late"))
    apart = spark.read.parquet(late).select(
        *CLIENT_KEYS, *CLIENT_TRACKED, F.col("seen_at").alias("valid_from"), F.col("seen_at").alias("last_seen"), F.lit(True).alias("is_late")
    )
    return placed.unionByName(apart)


def stream_scd2_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two client snapshots that land one after the other, merged as they come."""
    landing = scratch_path(spark, "landing")
    tracked = [rule for rule in CLIENTS if rule.target in (*CLIENT_KEYS, *CLIENT_TRACKED)]
    target = VersionedTable(spark, scratch_path(spark, "dim-clients"))
    checkpoint = scratch_path(spark, "checkpoint")
    for rows, seen in ((table(spark, sf_dir, "customer"), FIRST), (customer_second(spark, sf_dir), SECOND)):
        landed = project(rows, tracked).withColumn("seen_at", F.lit(seen).cast("timestamp_ntz"))
        landed.write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(landed.schema).parquet(landing)
        stream_scd2(arriving, target, checkpoint, CLIENT_KEYS, CLIENT_TRACKED, "seen_at").awaitTermination()
    return target.read().drop("last_seen")


PART_DAYS, DELAY_DAYS, SILENT_HOURS = 10, 12, 24


def stream_versions_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' states from a stream that keeps them by key; half of each last day lands with the next part.

    The stream is stopped and started again from its checkpoint before the last part.
    """
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "versions", "checkpoint"))
    events = table(spark, sf_dir, "events")
    begin = F.lit("2024-01-01").cast("date")
    day = F.date_diff(F.col("ts").cast("date"), begin)
    behind = (F.pmod(day, F.lit(PART_DAYS)) == PART_DAYS - 1) & (F.col("event_id") % 2 == 0)
    part = F.least(F.floor(day / PART_DAYS) + behind.cast("int"), F.lit(2))
    for parts in ((0, 1), (2,)):
        for n in parts:
            events.where(part == n).coalesce(1).write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(landing)
        found = stream_versions(arriving, ["user_id"], ["event_type"], "ts", f"{DELAY_DAYS} days", SILENT_HOURS * 3600)
        with state_on_disk(spark):
            query = append_stream(found, out, checkpoint)
        query.awaitTermination()
    return versions_of(spark.read.parquet(out), ["user_id"], ["event_type"])


STREAM_VERSIONS_SQL = f"""
WITH mark AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL {DELAY_DAYS} DAY AS upto FROM events),
seen AS (
  SELECT user_id, event_type, ts, lag(ts) OVER w AS before,
         row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w
           OR ts > lag(ts) OVER w + INTERVAL {SILENT_HOURS} HOUR AS opens
  FROM events, mark WHERE ts <= upto WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts) AS version FROM seen),
versions AS (
  SELECT user_id, version, any_value(event_type) AS event_type, min(ts) AS valid_from,
         max(ts) + INTERVAL {SILENT_HOURS} HOUR AS silent, lead(min(ts)) OVER (PARTITION BY user_id ORDER BY version) AS following
  FROM numbered GROUP BY user_id, version)
SELECT user_id, event_type, valid_from,
       CASE WHEN following <= silent THEN following WHEN following IS NOT NULL OR silent <= upto THEN silent
            ELSE TIMESTAMP '9999-12-31' END AS valid_to,
       following IS NULL AND silent > upto AS is_current
FROM versions, mark
"""

QUERIES = {
    "stream_versions": (stream_versions_events, STREAM_VERSIONS_SQL),
    "stream_append_summaries": (stream_append_summaries, "SELECT * FROM events"),
    "stream_append_restart": (stream_append_restart, "SELECT * FROM events"),
    "stream_scd2_late": (
        stream_scd2_late,
        CLIENT_MERGE_SQL
        + f"""
SELECT client_id, full_name, segment_code, nation_id, TIMESTAMP '{FIRST}' AS valid_from, TIMESTAMP '{AFTER}' AS last_seen,
       FALSE AS is_late FROM t
UNION ALL
SELECT client_id, full_name, segment_code, nation_id, TIMESTAMP '{SECOND}', TIMESTAMP '{SECOND}', FALSE
FROM s WHERE client_id NOT IN (SELECT client_id FROM t)
UNION ALL
SELECT s.client_id, s.full_name, s.segment_code, s.nation_id, TIMESTAMP '{SECOND}', TIMESTAMP '{SECOND}', TRUE
FROM s JOIN t ON s.client_id = t.client_id
WHERE s.full_name IS DISTINCT FROM t.full_name OR s.segment_code IS DISTINCT FROM t.segment_code
   OR s.nation_id IS DISTINCT FROM t.nation_id
""",
    ),
    "stream_incremental": (stream_incremental_events, "SELECT * FROM events"),
    "stream_append": (stream_append_events, "SELECT * FROM events"),
    "stream_scd2": (
        stream_scd2_clients,
        CLIENT_HISTORY_SQL
        + "SELECT client_id, full_name, segment_code, nation_id, valid_from, valid_to, is_current FROM history",
    ),
}
