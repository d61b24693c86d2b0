"""Streaming form of the version-keeping merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.common import BATCH, differs, fits_broadcast, has_null, prefixed, same_keys
from tidemark.operators.history import scd2_extend, scd2_rebuild
from tidemark.operators.incremental import latest_per_key
from tidemark.operators.scd2 import Versions
from tidemark.plans.versioned import VersionedTable
from tidemark.plans.workspace import staging
from tidemark.streaming.incremental import started, stream_id

LAST_SEEN = "last_seen"


def merge_changes(
    table: VersionedTable,
    changes: DataFrame,
    load_id: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    versions: Versions = Versions(),
    carry: Sequence[str] = (),
    late_path: str | None = None,
    cell: str = "auto",
) -> dict:
    """Bring a history table up to date with a batch of timed changes.

    A key may change several times in the batch. Of rows with the same key and time one
    is kept. ``last_seen`` in the table is the time of the last row of a key, changed or not.
    Rows that are not later cannot be placed; those that the current version does not cover
    with the same values are written to ``late_path`` (raising if there is none), and so are
    rows with a NULL key. A load id that was committed is skipped.
    """
    manifest = table.manifest()
    if manifest is not None and load_id in manifest.loads:
        return {}
    time = F.col(ts).cast("timestamp_ntz")
    named = changes.select(*keys, *tracked, *carry, time.alias(ts), time.alias(LAST_SEEN))
    carry = [*carry, LAST_SEEN]
    with staging(latest_per_key(named, [*keys, ts], ts), "changes") as landed:
        unkeyed = landed.where(has_null([*keys, ts]))
        rows = landed.where(~has_null([*keys, ts]))
        buckets = table.touched_buckets(rows, manifest)
        if manifest is None:
            late = unkeyed
            delta = scd2_rebuild(rows, keys, tracked, ts, versions, carry, cell)
        else:
            current = table.current(versions, manifest, buckets)
            start, last = BATCH + versions.valid_from, BATCH + LAST_SEEN
            # Current versions of the changed keys; a small batch is broadcast to find them.
            seen = current.select(*keys, *tracked, versions.valid_from, LAST_SEEN).join(rows.select(*keys), list(keys), "left_semi")
            paired = rows.join(prefixed(seen), same_keys(keys), "left")
            is_late = F.col(start).isNotNull() & (F.col(ts) <= F.col(last))
            replayed = (F.col(ts) >= F.col(start)) & ~differs(tracked)
            late = paired.where(is_late & ~replayed).select(*rows.columns).unionByName(unkeyed)
            fresh = paired.where(~is_late).select(*rows.columns)
            delta = scd2_extend(current, fresh, keys, tracked, ts, versions, carry, cell, fits_broadcast(landed))
        # a version that goes on was last seen when the batch last had its key
        highs = prefixed(rows.groupBy(*keys).agg(F.max(ts).alias(LAST_SEEN)))
        later = F.greatest(LAST_SEEN, BATCH + LAST_SEEN)
        last_seen = F.when(F.col(versions.is_current), later).otherwise(F.col(LAST_SEEN))
        columns = [last_seen.alias(c) if c == LAST_SEEN else F.col(c) for c in delta.columns]
        delta = delta.join(highs, same_keys(keys), "left").select(*columns)
        if not late.isEmpty():
            if late_path is None:
                raise ValueError("changes older than the current version of their key, or without a key")
            late.write.mode("overwrite").parquet(f"{late_path}/load={load_id}")
        stamp = rows.agg(F.max(ts).cast("string")).first()[0] or (manifest.load_ts if manifest else "1970-01-01 00:00:00")
        return table.commit_versions(delta, load_id, stamp, versions, buckets)


def stream_scd2(
    stream: DataFrame,
    table: VersionedTable,
    checkpoint: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    versions: Versions = Versions(),
    carry: Sequence[str] = (),
    late_path: str | None = None,
    cell: str = "auto",
    every: str | None = None,
) -> StreamingQuery:
    """Merge a change stream into a history table, micro-batch by micro-batch.

    The stream's id and the batch number are the load id, so a batch that Spark runs again
    after a failure is applied once. The table has a column ``last_seen``.
    """

    def merge(batch: DataFrame, number: int) -> None:
        load_id = f"{stream_id(batch.sparkSession, checkpoint)}-batch-{number}"
        merge_changes(table, batch, load_id, keys, tracked, ts, versions, carry, late_path, cell)

    return started(stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint), every)
