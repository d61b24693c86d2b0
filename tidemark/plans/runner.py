"""Run one load: extract, project, check, merge, commit."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.audit import add_audit, utc_text
from tidemark.functions.projection import project
from tidemark.operators.changes import apply_changes, deleted_keys
from tidemark.operators.common import has_null
from tidemark.operators.incremental import latest_per_key, unloaded_rows
from tidemark.operators.quality import BatchRefused, refuse_bad_batch
from tidemark.operators.scd1 import default_tracked, scd1_upsert
from tidemark.operators.scd2 import first_versions, scd2_delta
from tidemark.plans.spec import Changes, Full, Incremental, LoadSpec, Scd1, Scd2
from tidemark.plans.versioned import Manifest, VersionedTable
from tidemark.plans.workspace import staging
from tidemark.sinks.mart import export_mart
from tidemark.sources.files import read_incremental
from tidemark.sources.jdbc import Connection, Partitioning, read_jdbc

log = logging.getLogger(__name__)

SOURCE_MARK = "_source_mark"
AUDIT_LOG = (
    "load_id string, target string, strategy string, load_ts string, rows_written long, closed long, opened long, "
    "watermark string"
)


@dataclass(frozen=True)
class LoadResult:
    """What a run did. ``watermark`` is the lower bound of the next run."""

    load_id: str
    figures: dict
    watermark: str | None = None


def extract(
    spark: SparkSession,
    spec: LoadSpec,
    connections: Mapping[str, Connection],
    partitioning: Partitioning | None = None,
) -> DataFrame:
    """The spec's source table over JDBC; ``connections`` are keyed by source system.

    Lazy: the watermark filter of an incremental run is sent to the database with it.
    """
    if spec.source_system not in connections:
        raise KeyError(f"no connection for source system {spec.source_system!r}")
    return read_jdbc(spark, connections[spec.source_system], spec.source_table, partitioning=partitioning)


def export(spec: LoadSpec, df: DataFrame, keep: Sequence[str] = ()) -> None:
    """Write a loaded table to every sink of the spec."""
    for sink in spec.sinks:
        export_mart(df, sink, spec.mapping, spec.primary_keys, keep=keep)


def open_table(spark: SparkSession, spec: LoadSpec, root: str, buckets: int = 0) -> VersionedTable:
    """The spec's target as a table of files under ``root``, partitioned as the spec says, or
    by key buckets for merges that should rewrite only what they touch."""
    if spec.file_format not in ("parquet", "orc"):
        raise ValueError(f"{spec.file_format} tables are in a catalog: use create_or_replace and the MERGE operators")
    if buckets:
        return VersionedTable(spark, root, spec.file_format, bucket_by=spec.primary_keys, buckets=buckets)
    return VersionedTable(spark, root, spec.file_format, spec.partition_by)


def prepare(spec: LoadSpec, source: DataFrame, load_ts: datetime | str, mark: str | None = None) -> DataFrame:
    """Source rows as target rows: mapping, then technical columns. Narrow, no shuffle.

    ``mark`` is a source column that comes along as ``SOURCE_MARK``.
    """
    rows = project(source, spec.mapping, also=[F.col(mark).alias(SOURCE_MARK)] if mark else [])
    op = spec.strategy.op if isinstance(spec.strategy, Changes) else None
    hashed = [name for name in rows.columns if name not in (op, SOURCE_MARK)]
    return add_audit(rows, load_ts, spec.source_system, spec.audit, hashed, spec.primary_keys)


def run_load(
    spec: LoadSpec,
    source: DataFrame,
    table: VersionedTable,
    load_ts: datetime | str,
    lower_bound: datetime | str | None = None,
    load_id: str | None = None,
    audit_log: str | None = None,
) -> LoadResult:
    """Load ``source`` into ``table`` by the spec's strategy, and note it in ``audit_log``.

    The log is a folder of Parquet files with one row for each load that did something. The commit of a load
    holds its figures: a load that died before it was noted is noted when it is run again.
    """
    result = _run(spec, source, table, load_ts, lower_bound, load_id)
    if audit_log is not None:
        known = (result.figures, utc_text(load_ts), result.watermark) if result.figures else None
        if known is None and not _is_noted(source.sparkSession, audit_log, result.load_id):
            known = table.noted_load(result.load_id)
        if known is not None:
            _note(source.sparkSession, audit_log, result.load_id, spec, *known)
    return result


def _is_noted(spark: SparkSession, audit_log: str, load_id: str) -> bool:
    try:
        return not spark.read.schema(AUDIT_LOG).parquet(audit_log).where(F.col("load_id") == load_id).isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def _note(spark: SparkSession, audit_log: str, load_id: str, spec: LoadSpec, figures: dict, load_ts: str | None, watermark: str | None) -> None:
    counts = [figures.get(name) for name in ("rows", "closed", "opened")]
    row = (load_id, spec.target, type(spec.strategy).__name__.lower(), load_ts, *counts, watermark)
    spark.createDataFrame([row], AUDIT_LOG).coalesce(1).write.mode("append").parquet(audit_log)


def _run(
    spec: LoadSpec,
    source: DataFrame,
    table: VersionedTable,
    load_ts: datetime | str,
    lower_bound: datetime | str | None,
    load_id: str | None,
) -> LoadResult:
    """One load, not yet in the log.

    The load id (by default name and load time) makes a run repeatable: one that was
    committed is not applied again. A batch with NULL or repeated keys is refused before
    a merge, and a merge older than the table's last load is refused.
    """
    stamp = utc_text(load_ts)
    load_id = load_id or f"{spec.name}@{stamp}"
    manifest = table.manifest()
    if manifest is not None and load_id in manifest.loads:
        return LoadResult(load_id, {}, manifest.watermark)
    strategy = spec.strategy
    if isinstance(strategy, Full):
        return LoadResult(load_id, table.replace(prepare(spec, source, load_ts), load_id, stamp))
    if isinstance(strategy, Incremental):
        return _incremental(spec, strategy, source, table, manifest, load_ts, stamp, lower_bound, load_id)

    if manifest is not None and manifest.load_ts and datetime.fromisoformat(stamp) < datetime.fromisoformat(manifest.load_ts):
        raise ValueError(f"load time {stamp} is before the table's last load {manifest.load_ts}")
    keys = list(strategy.business_keys)
    rows = prepare(spec, source, load_ts)
    if isinstance(strategy, Changes):
        return LoadResult(load_id, _changes(spec, strategy, rows, table, manifest, stamp, load_id))
    if strategy.latest_by:
        rows = latest_per_key(rows, keys, strategy.latest_by, [rule.target for rule in spec.mapping])
    # Check and merge need the batch more than once: extract it once.
    with staging(rows, spec.name) as batch:
        refuse_bad_batch(batch, keys)
        merge = _scd1 if isinstance(strategy, Scd1) else _scd2
        return LoadResult(load_id, merge(spec, strategy, batch, table, manifest, load_ts, stamp, load_id))


def _changes(
    spec: LoadSpec,
    strategy: Changes,
    rows: DataFrame,
    table: VersionedTable,
    manifest: Manifest | None,
    stamp: str,
    load_id: str,
) -> dict:
    keys = list(strategy.business_keys)
    with staging(rows, spec.name) as feed:
        if not feed.where(has_null(keys)).isEmpty():
            raise BatchRefused("changes with a NULL key")
        buckets = table.touched_buckets(feed, manifest)
        target = feed.drop(strategy.op).limit(0) if manifest is None else table.read(manifest, buckets=buckets)
        # Changes may have been applied before, by a load that ran again or a feed that overlaps it;
        # a row that was deleted since must not come back. Only a key's own last sequence tells: feeds
        # may be late, or tied, for one key and not for another.
        gone = _deleted(spec, strategy, feed, table, manifest, stamp, load_id)
        merged = apply_changes(target, feed, keys, strategy.sequence, strategy.op, strategy.deletes, gone=gone)
        after = manifest.watermark if manifest is not None else None
        kind = feed.schema[strategy.sequence].dataType
        highest = feed.agg(F.greatest(F.max(strategy.sequence), F.lit(after).cast(kind)).cast("string")).first()[0]
        return table.commit_rows(merged, load_id, stamp, buckets, high=highest)


def _deleted(
    spec: LoadSpec,
    strategy: Changes,
    feed: DataFrame,
    table: VersionedTable,
    manifest: Manifest | None,
    stamp: str,
    load_id: str,
) -> DataFrame | None:
    """Keys deleted by loads before, from a table of their own below the target's root, to which the feed's are added.

    It is committed first: what a load that then dies has left there are deletes of the source, which
    stop older writes only. None when nothing was deleted yet.
    """
    keys = list(strategy.business_keys)
    past = VersionedTable(table.spark, f"{table.root}/deleted", table.file_format, bucket_by=table.bucket_by, buckets=table.buckets)
    old = past.manifest()
    buckets = table.touched_buckets(feed, manifest)
    gone = None if old is None else past.read(old, buckets=buckets)
    if not feed.where(F.col(strategy.op).isin(*strategy.deletes)).isEmpty():
        found = deleted_keys(feed, keys, strategy.sequence, strategy.op, strategy.deletes, gone)
        past.commit_rows(found, load_id, stamp, buckets)
    return gone


def _scd1(
    spec: LoadSpec,
    strategy: Scd1,
    batch: DataFrame,
    table: VersionedTable,
    manifest: Manifest | None,
    load_ts: datetime | str,
    stamp: str,
    load_id: str,
) -> dict:
    keys, buckets = list(strategy.business_keys), table.touched_buckets(batch, manifest)
    tracked = list(strategy.tracked) or default_tracked(batch, keys, spec.audit)
    merged = batch if strategy.carry_untracked else batch.select(*keys, *tracked, *spec.audit.columns())
    if manifest is not None:
        target = table.read(manifest, buckets=buckets)
        merged = scd1_upsert(
            target,
            batch,
            keys,
            tracked,
            spec.audit,
            change_test=strategy.change_test,
            carry_untracked=strategy.carry_untracked,
            null_keys=False,
        )
    return table.commit_rows(merged, load_id, stamp, buckets)


def _scd2(
    spec: LoadSpec,
    strategy: Scd2,
    batch: DataFrame,
    table: VersionedTable,
    manifest: Manifest | None,
    load_ts: datetime | str,
    stamp: str,
    load_id: str,
) -> dict:
    keys, buckets = list(strategy.business_keys), table.touched_buckets(batch, manifest)
    if strategy.close_missing and buckets is not None:
        buckets = list(range(table.buckets))  # missing keys can be anywhere
    tracked, versions = list(strategy.tracked), strategy.versions
    if manifest is None:
        first = batch if strategy.carry_untracked else batch.select(*keys, *tracked, *spec.audit.columns())
        delta = first_versions(first, load_ts, versions)
    else:
        current = table.current(versions, manifest, buckets)
        delta = scd2_delta(
            current,
            batch,
            keys,
            tracked,
            load_ts,
            versions,
            spec.audit,
            carry_untracked=strategy.carry_untracked,
            close_missing=strategy.close_missing,
            null_keys=False,
        )
    return table.commit_versions(delta, load_id, stamp, versions, buckets)


def _incremental(
    spec: LoadSpec,
    strategy: Incremental,
    source: DataFrame,
    table: VersionedTable,
    manifest: Manifest | None,
    load_ts: datetime | str,
    stamp: str,
    lower_bound: datetime | str | None,
    load_id: str,
) -> LoadResult:
    if lower_bound is None and manifest is not None:
        lower_bound = manifest.watermark
    if lower_bound is None:
        log.warning("%s: no lower bound, reading the whole source", spec.name)
    source_column = strategy.source_watermark or strategy.watermark
    # The next bound is the source column's own highest value, observed in the rows that were read:
    # the target's may be coarser, and would let rows be read again.
    rows = prepare(spec, read_incremental(source, source_column, lower_bound, strategy.overlap), load_ts, source_column)
    keys, high = list(strategy.business_keys), strategy.watermark
    if strategy.on_repeat == "append":
        figures = table.append(rows, load_id, stamp, SOURCE_MARK, [SOURCE_MARK])
    else:
        with staging(rows, spec.name) as landed:
            if manifest is not None and landed.isEmpty():
                return LoadResult(load_id, {"rows": 0}, manifest.watermark)
            bound, batch = landed.agg(F.max(SOURCE_MARK).cast("string")).first()[0], landed.drop(SOURCE_MARK)
            if strategy.on_repeat == "skip":
                target = batch.limit(0) if manifest is None else table.read(manifest)
                fresh = unloaded_rows(target, batch, keys, high).withColumn(SOURCE_MARK, F.lit(bound))
                figures = table.append(fresh, load_id, stamp, SOURCE_MARK, [SOURCE_MARK])
            else:
                buckets = table.touched_buckets(batch, manifest)
                both = batch if manifest is None else table.read(manifest, buckets=buckets).unionByName(batch)
                latest = latest_per_key(both, keys, high, [rule.target for rule in spec.mapping])
                figures = table.commit_rows(latest, load_id, stamp, buckets, high=bound)
                figures["watermark"] = bound
    return LoadResult(load_id, figures, figures.get("watermark") or (manifest.watermark if manifest else None))
