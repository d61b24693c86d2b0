"""Changes that come after later ones: history is split and stitched where they belong.

A history can be mended only where it is touched. Of each key that a batch names, the versions from the
last one that began before its first change to the first one that begins after its last change are
taken out and built anew from the log of what was seen in that span; all others stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.common import BATCH, all_of, has_null, like_target, prefixed, require_columns
from tidemark.operators.history import ROWS_PER_TASK, scd2_rebuild
from tidemark.operators.incremental import latest_per_key
from tidemark.operators.scd2 import Versions

LOW, HIGH, END, OPEN, SPAN = "_low", "_high", "_end", "_open", "_span_"


def one_per_time(log: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The log with one row for each key and time, the same one in whatever order the rows came.

    Rows with a NULL key or time are left out.
    """
    return latest_per_key(log.where(~has_null([*keys, ts])), [*keys, ts], ts)


def _matches(keys: Sequence[str]) -> Column:
    return all_of(F.col(key) == F.col(SPAN + key) for key in keys)


def correction_spans(
    history: DataFrame, changes: DataFrame, keys: Sequence[str], ts: str, versions: Versions = Versions()
) -> DataFrame:
    """A row for each key of a batch: the span of history that its changes touch.

    Keys (``_span_*``), the start of the version before the first change and of the one after the last
    change (NULL where there is none), and how the last version of the span ends. A log needs to be read from the least
    ``_low`` on only, if none is NULL.
    """
    start, end, flag = versions.columns()
    time = F.col(ts).cast("timestamp_ntz")
    named = changes.where(~has_null([*keys, ts])).groupBy(*keys).agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    known = prefixed(history.select(*keys, *versions.columns()))
    joined = named.join(known, all_of(F.col(key) == F.col(BATCH + key) for key in keys), "left")
    begun = F.col(BATCH + start)
    before, after = F.when(begun < F.col("_first"), begun), F.when(begun > F.col("_last"), begun)
    spans = joined.groupBy(*keys).agg(
        F.max(before).alias(LOW),
        F.min(after).alias(HIGH),
        F.min_by(F.struct(BATCH + end, BATCH + flag), after).alias("_after"),
        F.max_by(F.col(BATCH + flag), begun).alias("_last_open"),
    )
    closed = F.raise_error(F.lit("the last version of a key was closed: it can not be told when it was gone"))
    is_open = F.when(F.col(HIGH).isNotNull(), F.col("_after")[BATCH + flag]).when(F.coalesce("_last_open", F.lit(True)), F.lit(True)).otherwise(closed)
    return spans.select(*[F.col(key).alias(SPAN + key) for key in keys], LOW, HIGH, F.col("_after")[BATCH + end].alias(END), is_open.alias(OPEN))


def _within(time: Column) -> Column:
    return (F.col(LOW).isNull() | (time >= F.col(LOW))) & (F.col(HIGH).isNull() | (time <= F.col(HIGH)))


def scd2_corrections(
    history: DataFrame,
    log: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    versions: Versions = Versions(),
    carry: Sequence[str] = (),
    cell: str | Column = "auto",
    rows_per_task: int = ROWS_PER_TASK,
    spans: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(versions that go, versions that come) when a batch of changes of any age is put in its place.

    ``log`` holds the rows that the history was built from, without the batch; of it only the touched spans are used,
    so a caller may pass the part from the least ``_low`` of ``correction_spans`` on. Of several rows of a key at
    one time the same one is taken in whatever order they come. Rows with a NULL key or
    time have no place and are left out. A key whose last version was closed without a successor
    makes the job fail, if the batch reaches beyond its last version but one.
    """
    require_columns(changes, [*keys, *tracked, ts, *carry], "the changes")
    spans = correction_spans(history, changes, keys, ts, versions) if spans is None else spans
    start, end, flag = versions.columns()
    replaced = history.join(spans, _matches(keys)).where(_within(F.col(start))).select(*history.columns)

    time = F.col(ts).cast("timestamp_ntz").alias(ts)
    wanted = [*keys, *tracked, *carry, time]
    seen = log.select(*wanted).join(spans, _matches(keys)).where(_within(F.col(ts))).select(*keys, *tracked, *carry, ts)
    rows = one_per_time(seen.unionByName(changes.select(*wanted)), keys, ts)
    rebuilt = scd2_rebuild(rows, keys, tracked, ts, versions, carry, cell, rows_per_task)
    # the last version of a span goes on as the one that followed did
    goes_on = F.col(flag) & F.col(HIGH).isNotNull()
    added = rebuilt.join(spans, _matches(keys)).select(
        *[
            F.when(goes_on, F.col(END)).otherwise(F.col(end)).alias(end) if name == end
            else F.when(goes_on, F.col(OPEN)).otherwise(F.col(flag) & F.col(OPEN)).alias(flag) if name == flag
            else F.col(name)
            for name in rebuilt.columns
        ]
    )
    return replaced, added.select(*[like_target(history, name, F.col(name)) for name in history.columns])


def scd2_place(
    history: DataFrame,
    log: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    versions: Versions = Versions(),
    carry: Sequence[str] = (),
    cell: str | Column = "auto",
    rows_per_task: int = ROWS_PER_TASK,
    spans: DataFrame | None = None,
) -> DataFrame:
    """The history after a batch of changes of any age, as one rebuild of the whole log would give it.

    Versions that no change touches pass through; see ``scd2_corrections``.
    """
    spans = correction_spans(history, changes, keys, ts, versions) if spans is None else spans
    _, added = scd2_corrections(history, log, changes, keys, tracked, ts, versions, carry, cell, rows_per_task, spans)
    start = F.col(versions.valid_from)
    kept = history.join(spans, _matches(keys) & _within(start), "left_anti")
    return kept.select(*history.columns).unionByName(added)
