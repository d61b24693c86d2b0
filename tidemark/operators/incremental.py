"""Incremental loads: append, latest row per key, next watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.common import (
    BATCH,
    fits_broadcast,
    has_null,
    prefixed,
    require_columns,
    same_keys,
    unseen_rows,
)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str, tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the highest ``order``.

    Ties go to the highest ``tie_break`` values (by default a hash of the row), so the
    choice is the same in every run. ``row_number() = 1`` makes Spark cut each key to one row *before*
    the shuffle (WindowGroupLimit), so a key that holds much of the table sends at most
    one row per map task.
    """
    require_columns(df, [*keys, order], "the input")
    ties = [F.col(name) for name in tie_break] if tie_break else [F.xxhash64(*df.columns)]
    newest = Window.partitionBy(*keys).orderBy(*[column.desc_nulls_last() for column in [F.col(order), *ties]])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def incremental_append(
    target: DataFrame,
    batch: DataFrame,
    dedupe_keys: Sequence[str] | None = None,
    watermark: str | None = None,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Target with the slice appended, as a DataFrame.

    Without ``dedupe_keys`` rows are simply appended, so a replayed slice is there twice.
    With them the newest row per key (by ``watermark``) is kept, over old and new rows.
    """
    appended = target.unionByName(batch, allowMissingColumns=True)
    if not dedupe_keys:
        return appended
    if watermark is None:
        raise ValueError("keeping the latest row per key needs a watermark column")
    return latest_per_key(appended, dedupe_keys, watermark, tie_break)


def unloaded_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str, small_batch: bool | None = None
) -> DataFrame:
    """The batch's rows whose key the target lacks, one (the latest) per key.

    Appending these makes an insert-only table safe to replay without rewriting it. A
    small batch does not shuffle the target. Rows with a NULL key match nothing and stay.
    """
    latest = prefixed(latest_per_key(batch.where(~has_null(keys)), keys, order))
    if fits_broadcast(batch) if small_batch is None else small_batch:
        unseen = unseen_rows(target, latest, keys)
    else:
        # distinct: keys of an append-only table repeat, and Spark cannot split this side of the join
        unseen = latest.join(target.select(*keys).distinct(), same_keys(keys), "left_anti")
    rows = unseen.select(*[F.col(BATCH + name).alias(name) for name in batch.columns])
    return rows.unionByName(batch.where(has_null(keys)))


def next_watermark(df: DataFrame, watermark: str) -> DataFrame:
    """One row with the highest watermark of the slice; NULL when the slice is empty."""
    return df.agg(F.max(watermark).alias("next_watermark"))
