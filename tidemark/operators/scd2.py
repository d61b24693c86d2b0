"""Merge that keeps every version (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.audit import Audit, instant
from tidemark.operators.common import (
    BATCH,
    differs,
    fits_broadcast,
    has_null,
    like_target,
    prefixed,
    require_columns,
    same_keys,
    unseen_rows,
)


@dataclass(frozen=True)
class Versions:
    """Names of the version columns and the end time of an open version."""

    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    is_current: str = "is_current"
    end_of_time: str = "9999-12-31"

    def columns(self) -> list[str]:
        return [self.valid_from, self.valid_to, self.is_current]

    def open(self, start: datetime | str | Column) -> list[Column]:
        """Version columns of a row that is valid from ``start`` on."""
        return [
            instant(start).alias(self.valid_from),
            instant(self.end_of_time).alias(self.valid_to),
            F.lit(True).alias(self.is_current),
        ]


def current_rows(target: DataFrame, versions: Versions = Versions()) -> DataFrame:
    require_columns(target, versions.columns(), "the target")
    return target.where(F.col(versions.is_current))


def closed_rows(target: DataFrame, versions: Versions = Versions()) -> DataFrame:
    flag = F.col(versions.is_current)
    return target.where(~flag | flag.isNull())


def scd2_changes(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    versions: Versions = Versions(),
) -> DataFrame:
    """Current versions whose tracked values differ in the batch: keys, old_* and new_* values."""
    current = current_rows(target, versions).select(*keys, *tracked)
    joined = current.join(prefixed(batch.select(*keys, *tracked)), same_keys(keys), "inner")
    return joined.where(differs(tracked)).select(
        *keys,
        *[F.col(name).alias(f"old_{name}") for name in tracked],
        *[F.col(BATCH + name).alias(f"new_{name}") for name in tracked],
    )


def scd2_delta(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    load_ts: datetime | str | Column,
    versions: Versions = Versions(),
    audit: Audit = Audit(),
    carry_untracked: bool = False,
    close_missing: bool = False,
    small_batch: bool | None = None,
    null_keys: bool = True,
) -> DataFrame:
    """What becomes of the current versions: kept, closed, and newly opened rows.

    ``current`` holds current versions only; closed history is neither read nor returned.
    A current row whose tracked values changed is closed at ``load_ts`` and a new version
    is opened for its key; a batch key without a current version is opened too; other
    rows stay. ``close_missing`` also closes keys that the batch lacks. Inserted rows get
    keys, tracked and technical columns, and all shared columns with ``carry_untracked``.
    Batch keys must be unique; ``null_keys=False`` states that no key is NULL.

    A large batch takes one full outer join. With a batch that is small enough to
    broadcast (measured when ``small_batch`` is None) the target is not shuffled; a second
    look at its key columns finds the batch's new keys.
    """
    names = current.columns
    technical = [name for name in audit.columns() if name in names]
    taken = [*keys, *tracked, *technical]
    if carry_untracked:
        shared = [name for name in batch.columns if name in names]
        taken += [name for name in shared if name not in (*taken, *versions.columns())]
    if close_missing and isinstance(load_ts, Column):
        raise ValueError("closing missing keys needs one load time for the whole batch")
    require_columns(current, [*taken, *versions.columns()], "the target")
    require_columns(batch, taken, "the batch")

    start = "_start"
    new = batch.select(*taken, instant(load_ts).alias(start))

    def opened(prefix: str) -> list[Column]:
        values = {name: F.col(prefix + name) for name in taken}
        values[versions.valid_from] = F.col(prefix + start)
        values[versions.valid_to] = instant(versions.end_of_time)
        values[versions.is_current] = F.lit(True)
        return [like_target(current, name, values.get(name, F.lit(None))) for name in names]

    def closed(at: Column) -> list[Column]:
        values = {versions.valid_to: at, versions.is_current: F.lit(False)}
        return [like_target(current, name, values.get(name, F.col(name))) for name in names]

    in_target = F.col(keys[0]).isNotNull()
    in_batch = F.col(BATCH + keys[0]).isNotNull()
    changed = in_target & in_batch & differs(tracked)
    end_time = F.coalesce(F.col(BATCH + start), instant(load_ts)) if close_missing else F.col(BATCH + start)
    as_is = F.struct(*[F.col(name) for name in names])
    ending = F.struct(*closed(end_time))
    opening = F.struct(*opened(BATCH))
    rows = F.when(changed, F.array(ending, opening)).when(~in_target, F.array(opening))
    if close_missing:
        rows = rows.when(~in_batch, F.array(ending))
    outcome = F.inline(rows.otherwise(F.array(as_is)))

    keyed = prefixed(new.where(~has_null(keys)) if null_keys else new)
    matchable = current.where(~has_null(keys)) if null_keys else current
    if fits_broadcast(batch) if small_batch is None else small_batch:
        kept = matchable.join(keyed, same_keys(keys), "left").select(outcome)
        delta = kept.unionByName(unseen_rows(matchable, keyed, keys).select(*opened(BATCH)))
    else:
        delta = matchable.join(keyed, same_keys(keys), "full_outer").select(outcome)
    if null_keys:
        # A NULL key matches nothing, so such rows skip the join instead of meeting in one
        # task. On Parquet the extra reads look at row-group statistics only.
        loose = new.where(has_null(keys)).select(*opened(""))
        delta = delta.unionByName(current.where(has_null(keys))).unionByName(loose)
    return delta


def scd2_merge(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    load_ts: datetime | str | Column,
    versions: Versions = Versions(),
    audit: Audit = Audit(),
    **options: bool | None,
) -> DataFrame:
    """Whole target after the merge: closed history as it was, and ``scd2_delta`` of the rest.

    History takes no part in the join; on a table partitioned by the current flag the two
    reads touch different files.
    """
    delta = scd2_delta(
        current_rows(target, versions), batch, keys, tracked, load_ts, versions, audit, **options
    )
    return closed_rows(target, versions).unionByName(delta)


def first_versions(batch: DataFrame, load_ts: datetime | str | Column, versions: Versions = Versions()) -> DataFrame:
    """A target made of one open version per batch row: the first load of a table."""
    return batch.select("*", *versions.open(load_ts))
