"""Change feeds with images of a row before and after, applied by whole transactions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import apply_changes
from tidemark.operators.common import all_of, any_of, require_columns
from tidemark.operators.history import ROWS_PER_TASK, with_next

ORDER, OP = "_order", "_op"
REMOVED, WRITTEN = "D", "W"


@dataclass(frozen=True)
class FeedColumns:
    """Columns of a feed: the transaction, the place of its commit among all, the changes it has, the
    place of a change within it, and the row before and after (NULL where there is none)."""

    transaction: str = "tx"
    commit: str = "commit"
    size: str = "size"
    place: str = "place"
    before: str = "before"
    after: str = "after"

    def all(self) -> list[str]:
        return [self.transaction, self.commit, self.size, self.place, self.before, self.after]


def transaction_states(feed: DataFrame, names: FeedColumns = FeedColumns()) -> DataFrame:
    """A row for each transaction: its commit, changes announced and arrived, and whether it is whole.

    Changes that were delivered twice count once. Counts are summed before the shuffle, so a transaction
    that holds much of the feed is no heavier than others.
    """
    once = feed.select(names.transaction, names.commit, names.size, names.place).dropDuplicates([names.transaction, names.place])
    counted = once.groupBy(names.transaction).agg(
        F.min(names.commit).alias(names.commit), F.max(names.size).alias("announced"), F.count(names.place).alias("arrived")
    )
    return counted.withColumn("is_whole", F.coalesce(F.col("announced") <= F.col("arrived"), F.lit(False)))


def commit_horizon(states: DataFrame, names: FeedColumns = FeedColumns()) -> DataFrame:
    """One row: the commit from which on nothing may be applied yet, that of the first transaction which is not whole.

    NULL if all are. A transaction whose commit is not known holds up everything (``blocked``).
    """
    missing = ~F.col("is_whole")
    return states.agg(
        F.min(F.when(missing, F.col(names.commit))).alias("horizon"),
        F.coalesce(F.bool_or(missing & F.col(names.commit).isNull()), F.lit(False)).alias("blocked"),
    )


def split_feed(feed: DataFrame, names: FeedColumns = FeedColumns()) -> tuple[DataFrame, DataFrame]:
    """(changes that can be applied, changes that wait) of a feed.

    Transactions are taken in the order of their commits up to the first that is not whole; what follows may
    build on it and waits as well. Each change comes once, however often it was delivered. A feed without
    transactions that miss something is taken wholly. Changes without a transaction or commit always wait.
    """
    require_columns(feed, names.all(), "the feed")
    once = feed.dropDuplicates([names.transaction, names.place])
    first = commit_horizon(transaction_states(feed, names), names).first()  # one row
    ready = F.col(names.transaction).isNotNull() & F.col(names.commit).isNotNull() & F.lit(not first["blocked"])
    if first["horizon"] is not None:
        ready = ready & (F.col(names.commit) < F.lit(first["horizon"]).cast(feed.schema[names.commit].dataType))
    return once.where(ready), once.where(~ready)


def row_changes(feed: DataFrame, keys: Sequence[str], names: FeedColumns = FeedColumns()) -> DataFrame:
    """(columns of the row, ``_order``, ``_op``): what the feed does to keys, in the order of commits.

    An update that changes the key removes the old one and then writes the new one; a change
    without an image after it removes, one without either does nothing.
    """
    before, after = F.col(names.before), F.col(names.after)
    moved = after.isNull() | any_of(~before[key].eqNullSafe(after[key]) for key in keys)

    def step(part: int, image: Column, op: str) -> Column:
        order = F.struct(F.col(names.commit).alias("commit"), F.col(names.place).alias("place"), F.lit(part).alias("part"))
        return F.struct(image.alias("row"), order.alias("order"), F.lit(op).alias("op"))

    steps = F.array_compact(
        F.array(F.when(before.isNotNull() & moved, step(0, before, REMOVED)), F.when(after.isNotNull(), step(1, after, WRITTEN)))
    )
    each = feed.select(F.explode(steps).alias("step"))
    return each.select("step.row.*", F.col("step.order").alias(ORDER), F.col("step.op").alias(OP))


def apply_transactions(
    target: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    names: FeedColumns = FeedColumns(),
    small_feed: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(target after the whole transactions of the feed, changes that wait for more to arrive).

    The waiting changes are passed in again, together with what arrives later. Of each key its last change
    decides, in the order of commits and of places within a transaction; as no transaction is
    applied in part, the target is at all times as the source was after some commit.
    """
    ready, waiting = split_feed(feed, names)
    return apply_changes(target, row_changes(ready, keys, names), keys, ORDER, OP, (REMOVED,), small_feed), waiting


def broken_chains(
    target: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    names: FeedColumns = FeedColumns(),
    cell: str = "auto",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Keys whose changes do not follow from each other: keys, commit, issue.

    What a change says was there before must be what the change before it left, or the target's row.
    ``not_there``: the feed changes or removes a row that is not there; ``already_there``: it inserts one that is;
    ``other_values``: the row there is another. A key with very many changes is split by place (``cell``).
    """
    columns = [name for name in target.columns]
    order = F.struct(F.col(names.commit).cast("long").alias("c"), F.col(names.place).cast("long").alias("p"))
    before, after = F.col(names.before), F.col(names.after)
    # what a key had before and has after each change that concerns it
    moved = all_of([before.isNotNull(), after.isNotNull(), any_of(~before[k].eqNullSafe(after[k]) for k in keys)])
    none = F.lit(None).cast(feed.schema[names.after].dataType)
    whole = F.struct(F.coalesce(before, after).alias("at"), before.alias("was"), after.alias("is"))
    left = F.struct(before.alias("at"), before.alias("was"), none.alias("is"))
    come = F.struct(after.alias("at"), none.alias("was"), after.alias("is"))
    effects = F.when(moved, F.array(left, come)).otherwise(F.array(whole))
    each = feed.where(before.isNotNull() | after.isNotNull()).select(order.alias("o"), F.col(names.commit).alias("_commit"), F.explode(effects).alias("e"))

    def marked(image: Column) -> Column:
        return F.when(image.isNotNull(), F.xxhash64(*[image[c] for c in columns]))

    steps = each.select(*[F.col("e.at")[k].alias(k) for k in keys], "o", "_commit", marked(F.col("e.was")).alias("_was"), marked(F.col("e.is")).alias("_is"))
    start = F.struct(F.lit(None).cast("long").alias("c"), F.lit(None).cast("long").alias("p"))
    there = target.select(*keys, start.alias("o"), F.lit(None).cast(feed.schema[names.commit].dataType).alias("_commit"), F.lit(None).cast("long").alias("_was"), F.xxhash64(*columns).alias("_is"))
    touched = there.join(steps.select(*keys).distinct(), list(keys), "left_semi")
    rows = touched.unionByName(steps).select("*", F.coalesce(F.col("o.c"), F.lit(-(2**62))).alias("_c"), F.coalesce(F.col("o.p"), F.lit(-1)).alias("_p"))
    linked = with_next(rows, keys, "_c", ["_was", "_commit"], cell, ["_p"], rows_per_task)
    following = F.col("_following")
    later = linked.where(following.isNotNull()).select(*keys, following["_commit"].alias(names.commit), F.col("_is").alias("have"), following["_was"].alias("say"))
    # a key's first change, if the target has no row of it, must be an insert
    firsts = steps.join(target.select(*keys), list(keys), "left_anti").groupBy(*keys).agg(F.min_by(F.struct("_commit", "_was"), "o").alias("f"))
    first = firsts.select(*keys, F.col("f._commit").alias(names.commit), F.lit(None).cast("long").alias("have"), F.col("f._was").alias("say"))
    issue = (
        F.when(F.col("have").isNull() & F.col("say").isNotNull(), "not_there")
        .when(F.col("have").isNotNull() & F.col("say").isNull(), "already_there")
        .when(F.col("have") != F.col("say"), "other_values")
    )
    return later.unionByName(first).select(*keys, names.commit, issue.alias("issue")).where("issue is not null")
