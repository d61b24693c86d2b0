"""Version history: rebuild it from a change log, check it, and read it as of a time.

All three look at neighbouring rows of a key. One key may hold much of the table, so its rows
are grouped by key *and* a cell of time, and only the few rows at a cell's edges meet
their neighbours in other cells. ``cell="auto"`` counts rows per key first (a job of its own)
and splits only keys with more rows than one task should sort; all other keys take one window,
and so one shuffle of the rows. Naming a calendar cell (minute, hour, day, ...) splits every key
and saves the count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

from tidemark.functions.audit import instant
from tidemark.operators.common import (
    BATCH,
    all_of,
    any_of,
    fits_broadcast,
    has_null,
    like_target,
    prefixed,
    require_columns,
)
from tidemark.operators.scd2 import Versions

CELL = "_cell"
ROWS_PER_TASK = 5_000_000


def position(value: Column, kind: DataType) -> Column:
    """A value of the order column as a number: microseconds of a time, days of a date.

    A TIMESTAMP_NTZ does not go through the session's time zone, where a clock change
    would break the order.
    """
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, TimestampNTZType):
        since = value - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        day, hour, minute, second = (F.extract(F.lit(p), since) for p in ("DAY", "HOUR", "MINUTE", "SECOND"))
        minutes = (day.cast("bigint") * 24 + hour) * 60 + minute
        return minutes * 60_000_000 + (second * 1_000_000).cast("bigint")
    return value.cast("bigint")


def rounded_down(number: Column, width: Column) -> Column:
    return number - F.pmod(number, width)


def cell_of(df: DataFrame, order: str, cell: str | Column) -> Column:
    """The calendar cell of a time: minute, hour, day, week, month, quarter or year.

    A Column is taken as it is and must grow with ``order``.
    """
    if isinstance(cell, Column):
        return cell
    if cell in ("minute", "hour"):
        place = position(F.col(order), df.schema[order].dataType)
        return rounded_down(place, F.lit(60_000_000 if cell == "minute" else 3_600_000_000))
    date = F.col(order).cast("date")
    return date if cell == "day" else F.trunc(date, cell)


def hot_keys(df: DataFrame, keys: Sequence[str], order: str, rows_per_task: int) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows (renamed ``_hot_*``), and how to split them.

    A key is split into cells of equal width, 64 times as many as its rows need if they came
    evenly, so that busy times fit too. A table of n rows has fewer than n / rows_per_task such
    keys; whether they are broadcast is Spark's choice, by their size.
    """
    kind = df.schema[order].dataType
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_from"), F.max(order).alias("_to"))
    start, end = position(F.col("_from"), kind), position(F.col("_to"), kind)
    width = F.greatest(F.lit(1).cast("bigint"), ((end - start) / (F.col("_n") * 64 / max(rows_per_task, 1))).cast("bigint"))
    return found.where(F.col("_n") > rows_per_task).select(
        *[F.col(key).alias("_hot_" + key) for key in keys], start.alias("_from"), width.alias("_width")
    )


def with_cell(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cell: str | Column,
    rows_per_task: int = ROWS_PER_TASK,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Adds the cell column. With ``"auto"`` rows of hot keys are split by time; all rows of
    any other key are in one cell, NULL."""
    if isinstance(cell, Column) or cell != "auto":
        return df.withColumn(CELL, cell_of(df, order, cell))
    hot = hot_keys(df, keys, order, rows_per_task) if hot is None else hot
    marked = df.join(hot, _is_hot(keys), "left")
    place = position(F.col(order), df.schema[order].dataType) - F.col("_from")
    part = F.when(F.col("_width").isNotNull(), rounded_down(place, F.col("_width")))
    return marked.select(*df.columns, part.alias(CELL))


def _is_hot(keys: Sequence[str]) -> Column:
    return all_of(F.col(key).eqNullSafe(F.col("_hot_" + key)) for key in keys)


def _parts(
    df: DataFrame, keys: Sequence[str], order: str, cell: str | Column, rows_per_task: int
) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of keys that one task can hold, and rows of the others with their cell; None for no rows."""
    if isinstance(cell, Column) or cell != "auto":
        return None, with_cell(df, keys, order, cell)
    hot = hot_keys(df, keys, order, rows_per_task)
    if hot.isEmpty():
        return df, None
    split = with_cell(df.join(hot, _is_hot(keys), "left_semi"), keys, order, cell, hot=hot)
    return df.join(hot, _is_hot(keys), "left_anti"), split


def _previous(values: Column, order: str, window: WindowSpec) -> Column:
    """The row before, by time; fails on two rows of a key at one time, whose order nobody knows."""
    first = F.lag(F.lit(True)).over(window).isNull()
    tied = ~first & F.lag(order).over(window).eqNullSafe(F.col(order))
    return F.when(tied, F.raise_error(F.lit("several changes of a key at one time"))).otherwise(F.lag(values).over(window))


def scd2_rebuild(
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    versions: Versions = Versions(),
    carry: Sequence[str] = (),
    cell: str | Column = "auto",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Whole version history from a log of snapshots, the same as merging them one by one.

    ``changes`` has one row per key and time, and the job fails otherwise. Rows that repeat the previous tracked values
    are dropped; each remaining row is a version that ends where the next one starts.
    ``carry`` columns come along from the row that opened the version. A ``cell`` that is
    named should be narrow enough that one key's rows within it fit one task.
    """
    require_columns(changes, [*keys, *tracked, ts, *carry], "the change log")
    log = changes.select(*keys, *tracked, *carry, ts)
    plain, split = _parts(log, keys, ts, cell, rows_per_task)
    made = [_opened(plain, keys, tracked, ts)] if plain is not None else []
    made += [_opened_by_cell(split, keys, tracked, ts)] if split is not None else []
    ends = F.coalesce(F.col("_next").cast("timestamp_ntz"), instant(versions.end_of_time))
    return reduce(DataFrame.unionByName, [rows.select(*log.columns, "_next") for rows in made]).select(
        *keys,
        *tracked,
        *carry,
        F.col(ts).cast("timestamp_ntz").alias(versions.valid_from),
        ends.alias(versions.valid_to),
        F.col("_next").isNull().alias(versions.is_current),
    )


def _opened(log: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str) -> DataFrame:
    """Rows that open a version, and when the next one does (``_next``): one window per key."""
    in_key = Window.partitionBy(*keys).orderBy(ts)
    rows = log.withColumn("_before", _previous(F.struct(*tracked), ts, in_key))
    rows = rows.where(F.col("_before").isNull() | _moved(tracked))
    return rows.withColumn("_next", F.lead(ts).over(in_key))


def _opened_by_cell(log: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str) -> DataFrame:
    """The same for rows with a cell; only rows at a cell's edges meet those of other cells."""
    in_cell = Window.partitionBy(*keys, CELL).orderBy(ts)
    in_key = Window.partitionBy(*keys).orderBy(ts)
    values = F.struct(*tracked)
    rows = log.select(
        "*",
        _previous(values, ts, in_cell).alias("_before"),
        F.lead(F.lit(True)).over(in_cell).isNull().alias("_tail"),
    )
    head = F.col("_before").isNull()
    rows = rows.select("*", head.alias("_head"), (~head & _moved(tracked)).alias("_moved"))

    # Within a cell: keep its first row (not judged yet), its changes and its last row.
    rows = rows.where("_head or _moved or _tail").select(
        "*",
        F.lead(F.when(F.col("_moved"), F.col(ts))).over(in_cell).alias("_next"),
        F.row_number().over(in_cell).alias("_place"),
    )
    done = (F.col("_place") > 2) & F.col("_next").isNotNull()

    # Across cells: at most four rows per cell look at their neighbours in the key.
    edges = rows.where(~done).withColumn("_before", F.lag(values).over(in_key))
    edges = edges.where(F.col("_moved") | (F.col("_head") & (F.col("_before").isNull() | _moved(tracked))))
    edges = edges.withColumn("_next", F.coalesce(F.col("_next"), F.lead(ts).over(in_key)))
    return rows.where(done).unionByName(edges)


def _moved(tracked: Sequence[str]) -> Column:
    return any_of(~F.col(name).eqNullSafe(F.col("_before").getField(name)) for name in tracked)


def scd2_extend(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    versions: Versions = Versions(),
    carry: Sequence[str] = (),
    cell: str | Column = "auto",
    small_changes: bool | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Like ``scd2_delta`` for a log with several changes per key: one pass, any number of versions.

    Every change of a key must be later than its current version's start. When the changes
    are small enough to broadcast, current rows of other keys pass through unshuffled.
    """
    if fits_broadcast(changes) if small_changes is None else small_changes:
        # NULL is a key like others here, as it is in the windows of the other form
        wanted = prefixed(changes.select(*keys))
        same = all_of(F.col(name).eqNullSafe(F.col(BATCH + name)) for name in keys)
        rest = current.join(wanted, same, "left_anti")
        touched = current.join(wanted, same, "left_semi")
        extended = scd2_extend(touched, changes, keys, tracked, ts, versions, carry, cell, False, rows_per_task)
        return rest.select(*current.columns).unionByName(extended)
    start = F.col(versions.valid_from).alias(ts)
    log = current.select(*keys, *tracked, *carry, start).unionByName(
        changes.select(*keys, *tracked, *carry, F.col(ts).cast("timestamp_ntz").alias(ts))
    )
    rebuilt = scd2_rebuild(log, keys, tracked, ts, versions, carry, cell, rows_per_task)
    return rebuilt.select(*[like_target(current, name, F.col(name)) for name in current.columns])


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Sequence[str],
    cell: str | Column = "auto",
    tie_break: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Adds ``_following``: a struct of the next row's columns within the key, NULL at the end."""
    in_cell = Window.partitionBy(*keys, CELL).orderBy(order, *tie_break)
    in_key = Window.partitionBy(*keys).orderBy(order, *tie_break)
    values = F.struct(*columns)
    plain, split = _parts(df, keys, order, cell, rows_per_task)
    plain = None if plain is None else plain.withColumn("_following", F.lead(values).over(in_key))
    if split is None:
        return plain
    rows = split.select(
        "*",
        F.lead(values).over(in_cell).alias("_following"),
        F.lag(F.lit(True)).over(in_cell).isNull().alias("_head"),
    )
    inner = ~F.col("_head") & F.col("_following").isNotNull()
    edges = rows.where(~inner).withColumn(
        "_following", F.coalesce(F.col("_following"), F.lead(values).over(in_key))
    )
    # A cell's first row with a follower in its own cell is only there to be found by others.
    found = rows.where(inner).unionByName(edges).drop(CELL, "_head")
    return found if plain is None else plain.unionByName(found)


def check_scd2(
    dim: DataFrame,
    keys: Sequence[str],
    versions: Versions = Versions(),
    cell: str | Column = "auto",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Faults of a history table: keys, valid_from (NULL for faults of a whole key), issue.

    Issues: ``empty_interval`` (a version ends no later than it starts), ``overlap`` and
    ``gap`` (against the next version of the key), ``no_current`` and ``several_current``.
    """
    start, end, flag = versions.columns()
    rows = with_next(dim.select(*keys, start, end, flag), keys, start, [start], cell, [end], rows_per_task)
    following = F.col("_following").getField(start)
    issues = F.array_compact(
        F.array(
            F.when(F.col(end) <= F.col(start), F.lit("empty_interval")),
            F.when(following < F.col(end), F.lit("overlap")),
            F.when(following > F.col(end), F.lit("gap")),
        )
    )
    per_row = rows.select(*keys, F.col(start), F.explode(issues).alias("issue"))
    open_versions = F.sum(F.when(F.col(flag), 1).otherwise(0))
    per_key = (
        dim.groupBy(*keys)
        .agg(open_versions.alias("_open"))
        .where("_open <> 1")
        .select(
            *keys,
            F.lit(None).cast(dim.schema[start].dataType).alias(start),
            F.when(F.col("_open") == 0, F.lit("no_current")).otherwise(F.lit("several_current")).alias("issue"),
        )
    )
    return per_row.unionByName(per_key)


def as_of_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    versions: Versions = Versions(),
    how: str = "left",
    cell: str | Column = "auto",
    small_dim: bool | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Each fact row with ``columns`` of the version valid at its time (valid_from <= ts < valid_to).

    Keys have the same names on both sides; versions of a key must not overlap. A
    dimension small enough to broadcast joins without moving the facts. Otherwise facts
    and versions are sorted together by time, in cells of a key, and each cell is given
    the version that was valid when it began.
    """
    start, end, _ = versions.columns()
    dim = dim.where(~has_null([*keys, start]))
    if how not in ("left", "inner"):
        raise ValueError("an as-of join is left or inner")
    shared = [name for name in columns if name in fact.columns]
    if shared:
        raise ValueError(f"the facts have columns of the same name: {shared}")
    small = fits_broadcast(dim) if small_dim is None else small_dim
    if small:
        side = dim.select(
            *[F.col(k).alias("_dim_" + k) for k in keys], *[F.col(c).alias("_dim_" + c) for c in [start, end]], *columns
        )
        condition = (F.col("_dim_" + start) <= F.col(ts)) & (F.col(ts) < F.col("_dim_" + end))
        for key in keys:
            condition = condition & (F.col(key) == F.col("_dim_" + key))
        return fact.join(side, condition, how).select(*fact.columns, *columns)

    version = F.struct(*dict.fromkeys([start, end, *columns]))
    no_version = F.lit(None).cast(dim.select(version.alias("v")).schema["v"].dataType)
    body = F.struct(*fact.columns)
    no_body = F.lit(None).cast(fact.select(body.alias("b")).schema["b"].dataType)
    time = F.col(ts).cast("timestamp_ntz")
    facts = fact.select(
        *keys, time.alias("_at"), F.lit(1).alias("_kind"), body.alias("_fact"), no_version.alias("_version")
    )
    opened = dim.select(
        *keys, F.col(start).cast("timestamp_ntz").alias("_at"), F.lit(0).alias("_kind"), no_body.alias("_fact"),
        version.alias("_version"),
    )

    both = facts.select(*keys, "_at").unionByName(opened.select(*keys, "_at"))
    hot = hot_keys(both, keys, "_at", rows_per_task)  # used with "auto" only
    facts = with_cell(facts, keys, "_at", cell, hot=hot)
    opened = with_cell(opened, keys, "_at", cell, hot=hot)

    # One row per key and cell: its last version, and the one carried in from earlier cells.
    # Keys that are not split have one cell (NULL) and nothing to carry.
    cells = (
        facts.where(F.col(CELL).isNotNull()).select(
            *keys, CELL, F.lit(None).cast("timestamp_ntz").alias("_at"), no_version.alias("_version"),
            F.lit(True).alias("_wanted"),
        ).distinct()
        .unionByName(opened.select(*keys, CELL, "_at", "_version", F.lit(False).alias("_wanted")))
        .where(F.col(CELL).isNotNull())
        .groupBy(*keys, CELL)
        .agg(F.max_by("_version", "_at").alias("_version"), F.max("_wanted").alias("_wanted"))
    )
    earlier = Window.partitionBy(*keys).orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cells.withColumn("_version", F.last("_version", ignorenulls=True).over(earlier))
        .where(F.col("_wanted") & F.col("_version").isNotNull())
        .select(
            *keys, F.lit(None).cast("timestamp_ntz").alias("_at"), F.lit(0).alias("_kind"),
            no_body.alias("_fact"), "_version", CELL,
        )
    )
    rows = facts.unionByName(opened).unionByName(carried)
    so_far = (
        Window.partitionBy(*keys, CELL)
        .orderBy(F.col("_at").asc_nulls_first(), "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = rows.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).where("_kind = 1")
    valid = F.col("_at") < F.col("_version").getField(end)
    if how == "inner":
        matched = matched.where(valid)
    return matched.select(
        "_fact.*", *[F.when(valid, F.col("_version").getField(name)).alias(name) for name in columns]
    )

