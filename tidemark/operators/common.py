"""Small expressions shared by the load operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH = "_batch_"


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions, F.lit(True))


def has_null(columns: Sequence[str]) -> Column:
    return any_of(F.col(name).isNull() for name in columns)


def prefixed(df: DataFrame, prefix: str = BATCH) -> DataFrame:
    """The same frame with every column renamed, so a join has no ambiguous names."""
    return df.select(*[F.col(name).alias(prefix + name) for name in df.columns])


def same_keys(keys: Sequence[str], prefix: str = BATCH) -> Column:
    """Key equality between a frame and a ``prefixed`` one; a NULL key matches nothing."""
    return all_of(F.col(name) == F.col(prefix + name) for name in keys)


def differs(columns: Sequence[str], prefix: str = BATCH) -> Column:
    """Null-safe change test: any of the columns is not the same on both sides."""
    return any_of(~F.col(name).eqNullSafe(F.col(prefix + name)) for name in columns)


def unseen_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], prefix: str = BATCH) -> DataFrame:
    """Rows of a small ``prefixed`` batch whose key the target lacks.

    The target's key columns are first cut down to the batch's keys, so that only a set as
    small as the batch takes part in the anti join.
    """
    wanted = batch.select(*[F.col(prefix + name) for name in keys])
    seen = target.select(*keys).join(wanted, same_keys(keys, prefix), "left_semi")
    return batch.join(seen, same_keys(keys, prefix), "left_anti")


def like_target(target: DataFrame, name: str, value: Column) -> Column:
    return value.cast(target.schema[name].dataType).alias(name)


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's own size estimate lets this frame be broadcast in this session.

    Only picks the shape of a merge. No broadcast hint is given: the join itself stays
    Catalyst's choice, under the same limit, with a sort-merge join beyond it.
    """
    try:
        state = df.sparkSession._jsparkSession.sessionState()
        limit = int(state.conf().autoBroadcastJoinThreshold())
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # a Spark Connect client sees no plan statistics
        return False
    return size <= limit
