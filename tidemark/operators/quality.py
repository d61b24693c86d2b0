"""Data quality checks. Each returns the offences, or counts of them, as a DataFrame.

Checks over keys count per key with a partial aggregate before the shuffle, so a key that
holds much of the table costs one row per map task. Checks over columns are one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.common import has_null, require_columns


class BatchRefused(ValueError):
    """A batch that must not be merged."""


def rows_per_column(totals: DataFrame, figures: Mapping[str, Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Turn one wide row of totals into a row per entry of ``figures``."""
    made = [
        F.struct(F.lit(label).alias("column_name"), *[F.col(c).alias(n) for c, n in zip(columns, names)])
        for label, columns in figures.items()
    ]
    return totals.select(F.inline(F.array(*made)))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts. NULL is a value like any other."""
    require_columns(df, keys, "the table")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def check_references(
    child: DataFrame, foreign_key: Sequence[str], parent: DataFrame, primary_key: Sequence[str]
) -> DataFrame:
    """Foreign keys without a parent row, with their row counts.

    The child is cut to one row per key before the join. Keys with a NULL refer to
    nothing and are left out; ``check_not_null`` counts them.
    """
    used = (
        child.where(~has_null(foreign_key)).groupBy(*foreign_key).agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parent.select(*[F.col(pk).alias("_pk_" + fk) for pk, fk in zip(primary_key, foreign_key, strict=True)])
    condition = [F.col(fk) == F.col("_pk_" + fk) for fk in foreign_key]
    return used.join(known, condition, "left_anti")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, and how many are NULL."""
    require_columns(df, columns, "the table")
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_nulls_{c}") for c in columns]
    )
    return rows_per_column(totals, {c: ("_rows", f"_nulls_{c}") for c in columns}, ("row_count", "null_count"))


def check_lengths(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Per column: its limit, the longest value, and how many values are longer than the limit."""
    require_columns(df, limits, "the table")
    figures: list = []
    for name, limit in limits.items():
        length = F.length(F.col(name))
        figures += [
            F.lit(limit).cast("bigint").alias(f"_limit_{name}"),
            F.max(length).cast("bigint").alias(f"_longest_{name}"),
            F.count_if(length > limit).alias(f"_over_{name}"),
        ]
    parts = ("_limit_", "_longest_", "_over_")
    return rows_per_column(
        df.agg(*figures),
        {name: tuple(part + name for part in parts) for name in limits},
        ("max_length", "longest", "too_long"),
    )


def check_write_conflicts(feeds: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Keys that more than one feed writes, with the number of feeds and of rows."""
    tagged = None
    for name, feed in feeds.items():
        one = feed.select(*keys, F.lit(name).alias("_feed"))
        tagged = one if tagged is None else tagged.unionByName(one)
    if tagged is None:
        raise ValueError("no feeds given")
    written = [F.max(F.when(F.col("_feed") == name, 1).otherwise(0)) for name in feeds]
    feeds_per_key = sum(written[1:], written[0])
    return (
        tagged.groupBy(*keys)
        .agg(feeds_per_key.alias("feed_count"), F.count(F.lit(1)).alias("row_count"))
        .where("feed_count > 1")
    )


def batch_faults(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: batch rows, rows with a NULL key, and keys that occur more than once."""
    per_key = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    no_null = ~has_null(keys)
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(no_null, 0).otherwise(F.col("_n"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(no_null & (F.col("_n") > 1)).alias("repeated_keys"),
    )


def refuse_bad_batch(batch: DataFrame, keys: Sequence[str]) -> None:
    """Raise ``BatchRefused`` when a key is NULL or occurs twice: a merge would not be defined."""
    faults = batch_faults(batch, keys).first()
    if faults["null_key_rows"] or faults["repeated_keys"]:
        raise BatchRefused(
            f"{faults['null_key_rows']} rows with a NULL key, {faults['repeated_keys']} keys that occur more than once"
        )
