"""Reconciliation that descends only where two tables differ.

Both sides are summed up by ranges of the first key column; ranges with equal sums are equal and are not looked at again.
Those that differ are cut into finer ones, which only need the rows in them, so that filters reach the
files; at the end the keys of a few small ranges are compared one by one. What travels from a side on the way is one
row of sums for each range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, IntegerType, LongType, ShortType, TimestampNTZType, TimestampType

from tidemark.functions.audit import record_hash
from tidemark.operators.common import all_of
from tidemark.operators.history import position
from tidemark.operators.reconcile import _PARTS, _hash_parts, reconcile

FANOUT, LEAF_ROWS, MOST_RANGES, MOST_FILTERS = 64, 10_000, 4096, 64
PLACE, RANGE = "_place", "_range"
ORDERED = (ByteType, ShortType, IntegerType, LongType, DateType, TimestampType, TimestampNTZType)


@dataclass(frozen=True)
class Ranges:
    """Ranges of one width of the places of keys, by their numbers; None is that of NULL keys."""

    origin: int
    width: int
    numbers: tuple[int | None, ...]

    def intervals(self) -> list[tuple[int, int]]:
        """(first, last) place of neighbouring ranges together."""
        found: list[list[int]] = []
        for n in sorted(n for n in self.numbers if n is not None):
            if found and found[-1][1] == n - 1:
                found[-1][1] = n
            else:
                found.append([n, n])
        return [(self.origin + a * self.width, self.origin + (b + 1) * self.width - 1) for a, b in found]


def place_of(df: DataFrame, keys: Sequence[str]) -> Column:
    """Where a key lies: its first column as a number, or a hash of it where the column has no distances."""
    kind = df.schema[keys[0]].dataType
    return position(F.col(keys[0]), kind) if isinstance(kind, ORDERED) else F.when(F.col(keys[0]).isNotNull(), F.shiftrightunsigned(F.xxhash64(keys[0]), 2))


def number_of(origin: int, width: int) -> Column:
    """The number of the range in which a place lies."""
    return F.expr(f"({PLACE} - {origin} - pmod({PLACE} - {origin}, {width})) div {width}")


def in_ranges(df: DataFrame, keys: Sequence[str], ranges: Ranges) -> DataFrame:
    """The rows in the ranges. Up to ``MOST_FILTERS`` intervals of a whole number are conditions on the column itself,
    which Spark hands to the files."""
    intervals = ranges.intervals()
    kind = df.schema[keys[0]].dataType
    plain = isinstance(kind, (ByteType, ShortType, IntegerType, LongType))
    place = F.col(keys[0]) if plain else place_of(df, keys)
    if len(intervals) <= MOST_FILTERS:
        inside = reduce(lambda a, b: a | b, [place.between(low, high) for low, high in intervals], F.lit(False))
    else:
        marked = df.withColumn(PLACE, place.cast("long"))
        inside = number_of(ranges.origin, ranges.width).isin([n for n in ranges.numbers if n is not None])
        return marked.where(inside | (F.lit(None in ranges.numbers) & F.col(PLACE).isNull())).drop(PLACE)
    return df.where(inside | F.col(keys[0]).isNull()) if None in ranges.numbers else df.where(inside)


def range_sums(df: DataFrame, keys: Sequence[str], compared: Sequence[str], origin: int, width: int, hash_column: str | None = None) -> DataFrame:
    """(range, rows, sums of record hashes) of a table: all that another side needs to compare itself with it."""
    mark = F.col(hash_column) if hash_column else record_hash(list(compared), version=2)
    marked = df.select(place_of(df, keys).cast("long").alias(PLACE), mark.alias("_hash")).select(number_of(origin, width).alias(RANGE), *_hash_parts("_hash"))
    return marked.groupBy(RANGE).agg(F.count("*").alias("rows"), *[F.sum(p).alias(p) for p in _PARTS])


def unequal_ranges(source: DataFrame, target: DataFrame) -> DataFrame:
    """(range, rows of the larger side) where the sums of two sides differ."""
    rows = source.withColumn("_sign", F.lit(1)).unionByName(target.withColumn("_sign", F.lit(-1)))
    both = rows.groupBy(RANGE).agg(
        F.max("rows").alias("rows"), F.sum(F.col("rows") * F.col("_sign")).alias("_more"), *[F.sum(F.col(p) * F.col("_sign")).alias(p) for p in _PARTS]
    )
    return both.where(~all_of([F.col("_more") == 0, *[F.col(p) == 0 for p in _PARTS]])).select(RANGE, "rows")


def descend(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    compared: Sequence[str] | None = None,
    fanout: int = FANOUT,
    leaf_rows: int = LEAF_ROWS,
    hash_column: str | None = None,
) -> Ranges:
    """The ranges of keys in which two tables differ, none with more than ``leaf_rows`` rows a side if it can be cut.

    One pass over both tables, then one over what differs for each level. It goes no deeper when ranges become more
    than ``MOST_RANGES``: then nearly all differs, and comparing key by key costs no more.
    """
    compared = list(compared or source.columns)
    ends = [df.select(place_of(df, keys).alias("p")).agg(F.min("p").alias("a"), F.max("p").alias("b"), F.count("*").alias("n")).first() for df in (source, target)]  # one row each
    low = min((e["a"] for e in ends if e["a"] is not None), default=0)
    high = max((e["b"] for e in ends if e["b"] is not None), default=0)
    width = 1
    while width * fanout < high - low + 1:
        width *= fanout
    ranges, within = None, (source, target)
    while True:
        sums = [range_sums(df, keys, compared, low, width, hash_column) for df in within]
        found = unequal_ranges(*sums).collect()  # MOST_RANGES times the fanout at most
        ranges = Ranges(low, width, tuple(r[RANGE] for r in found))
        large = [r for r in found if r[RANGE] is not None and r["rows"] > leaf_rows]
        if not large or width == 1 or len(found) > MOST_RANGES:
            return ranges
        width //= fanout
        within = tuple(in_ranges(df, keys, ranges) for df in (source, target))


def reconcile_by_ranges(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    compared: Sequence[str] | None = None,
    hash_column: str | None = None,
    fanout: int = FANOUT,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The keys that ``reconcile`` does not call equal, found without sending keys of ranges that are.

    For tables that are nearly equal, as copies are. Equal sums mean equal rows, short of a 126-bit collision.
    """
    compared = list(compared or source.columns)
    ranges = descend(source, target, keys, compared, fanout, leaf_rows, hash_column)
    left, right = (in_ranges(df, keys, ranges) for df in (source, target))
    return reconcile(left, right, keys, compared, hash_column).where("status <> 'equal'")
