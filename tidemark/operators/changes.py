"""Apply an ordered feed of inserts, updates and deletes to a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.common import (
    BATCH,
    all_of,
    fits_broadcast,
    has_null,
    like_target,
    prefixed,
    require_columns,
    same_keys,
    unseen_rows,
)
from tidemark.operators.incremental import latest_per_key

PAST = "past_"


def deleted_keys(
    feed: DataFrame, keys: Sequence[str], sequence: str, op: str, deletes: Sequence[str] = ("D",), gone: DataFrame | None = None
) -> DataFrame:
    """(keys, sequence) of each key's last delete, in the feed or among those ``gone`` before."""
    found = feed.where(F.col(op).isin(*deletes) & ~has_null(keys)).select(*keys, sequence)
    if gone is not None:
        found = gone.select(*keys, sequence).unionByName(found.select(*[like_target(gone, name, F.col(name)) for name in found.columns]))
    return found.groupBy(*keys).agg(F.max(sequence).alias(sequence))


def apply_changes(
    target: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    sequence: str,
    op: str,
    deletes: Sequence[str] = ("D",),
    small_feed: bool | None = None,
    after: object = None,
    gone: DataFrame | None = None,
) -> DataFrame:
    """Target after the feed: per key its last change decides.

    A delete removes the row; any other operation overwrites it or inserts it. When the
    target keeps ``sequence`` as a column, changes that are not newer than the stored row
    are ignored; a NULL sequence is older than any other, as within a feed. A deleted row leaves no sequence
    behind: for a feed that may hold changes which were applied before, ``gone`` has the keys deleted so far
    and the sequences of their deletes, as ``deleted_keys`` gives them, and writes to such a key that are not
    newer are ignored, so that an old change cannot bring a deleted row back. Other keys are not touched by it.
    ``after`` does that without the keys, for a feed that is in order over all keys: changes up to
    it are ignored, whatever their key. Rows of the feed with a NULL key
    have no row to apply to and are refused by ``check_not_null`` beforehand.

    As in the other merges, a feed small enough to broadcast does not shuffle the target.
    """
    values = [name for name in target.columns if name in feed.columns]
    require_columns(target, keys, "the target")
    require_columns(feed, [*keys, sequence, op], "the feed")
    wanted = list(dict.fromkeys([*values, sequence, op]))
    if after is not None:
        feed = feed.where(F.col(sequence) > F.lit(after).cast(feed.schema[sequence].dataType))
    last = prefixed(latest_per_key(feed.select(*wanted).where(~has_null(keys)), keys, sequence))
    if gone is not None:
        past = prefixed(gone.select(*keys, sequence), PAST)
        same = all_of(F.col(BATCH + name) == F.col(PAST + name) for name in keys)
        # A delete is let through, as the row may still be there after a load that died.
        write = ~F.coalesce(F.col(BATCH + op).isin(*deletes), F.lit(False))
        known = F.coalesce(F.col(BATCH + sequence) <= F.col(PAST + sequence), F.col(BATCH + sequence).isNull())
        last = last.join(past, same & write & known, "left_anti")
    matchable = target.where(~has_null(keys))

    in_feed = F.col(BATCH + keys[0]).isNotNull()
    in_target = F.col(keys[0]).isNotNull()
    newer = F.lit(True)
    if sequence in target.columns:
        newer = F.coalesce(F.col(sequence) < F.col(BATCH + sequence), F.col(sequence).isNull())
    applies = in_feed & (~in_target | newer)
    deleted = F.coalesce(F.col(BATCH + op).isin(*deletes), F.lit(False))

    def written(take: Column) -> list[Column]:
        return [
            F.when(take, like_target(target, name, F.col(BATCH + name))).otherwise(F.col(name)).alias(name)
            if name in values
            else F.col(name)
            for name in target.columns
        ]

    if fits_broadcast(feed) if small_feed is None else small_feed:
        joined = matchable.join(last, same_keys(keys), "left")
        merged = joined.where(~(applies & deleted)).select(*written(applies))
        fresh = unseen_rows(matchable, last, keys).where(~deleted)
        merged = merged.unionByName(
            fresh.select(
                *[
                    like_target(target, name, F.col(BATCH + name) if name in values else F.lit(None))
                    for name in target.columns
                ]
            )
        )
    else:
        joined = matchable.join(last, same_keys(keys), "full_outer")
        merged = joined.where(~(applies & deleted)).select(*written(applies))
    return merged.unionByName(target.where(has_null(keys)))
