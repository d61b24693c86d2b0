"""All minimal sets of columns that tell the rows of a table apart."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE_ROWS, AT_ONCE = 20_000, 16
#: one in so many values is looked at first, the rest in so many parts; hashes that come twice and are compared at once
SHARE, PARTS, HITS = 64, 4, 1000
SMALL = 1_000_000
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def complete_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns without NULLs: only these can be part of a key."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()  # one row
    return [c for c in columns if not nulls[c]]


def hashed_sample(df: DataFrame, columns: Sequence[str], rows: int) -> np.ndarray:
    """About ``rows`` rows as hashes of their values, chosen by a hash of the row: the same in every run.

    Equal rows are chosen together, so a table of repeated rows is refuted at once; a row that is
    repeated very often comes twice only.
    """
    total = df.count()
    share = min(1.0, rows / max(total, 1))
    place = F.pmod(F.xxhash64(*columns), F.lit(1 << 31))
    chosen = df.select(*columns).where(place < int(share * (1 << 31)))
    some = chosen.groupBy(*columns).agg(F.least(F.count("*"), F.lit(2)).alias("_n"))
    found = some.select(*[F.xxhash64(c).alias(c) for c in columns], "_n").limit(4 * rows).collect()  # bounded
    values = np.array([[r[c] for c in columns] for r in found], dtype=np.int64).reshape(len(found), len(columns))
    return np.repeat(values, [r["_n"] for r in found], axis=0)


def repeats(sample: np.ndarray, places: Sequence[int]) -> bool:
    """Whether two rows of the sample agree in the columns."""
    return len(np.unique(sample[:, list(places)], axis=0)) < len(sample)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files go with its end, so that those of many passes do not add up."""
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN, before)


def refuted(df: DataFrame, sets: Sequence[tuple[str, ...]], share: int) -> set[tuple[str, ...]]:
    """Those of the sets of which two rows agree, as far as one in ``share`` of the values of each set shows.

    A value is chosen by its own hash, so rows that agree in a set are looked at together or not at all.
    """
    marks = []
    for n, s in enumerate(sets):
        mark = F.struct(F.lit(n).alias("n"), F.xxhash64(*s).alias("a"), F.xxhash64(F.lit(7), *s).alias("b"))
        marks.append(F.when(F.pmod(F.xxhash64(*s), F.lit(share)) == 0, mark))
    each = df.select(F.explode(F.array(*marks)).alias("mark")).where("mark IS NOT NULL").groupBy("mark").count().where("count > 1")
    return {sets[r["n"]] for r in each.select("mark.n").distinct().collect()}  # a row a set


def is_unique(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether no two rows agree in the columns, by all rows, a part of the hashes at a time.

    Each row sends one hash. Values behind hashes that come twice are compared themselves.
    """
    value = F.xxhash64(*columns)
    for part in range(PARTS):
        hashes = df.select(value.alias("a")).where(F.pmod(F.shiftright("a", 8), F.lit(PARTS)) == part)
        # dealt out before they are counted: counting first would only fill and spill maps of single hashes
        twice = hashes.repartition("a").groupBy("a").count().where("count > 1")
        some = [r["a"] for r in twice.select("a").limit(HITS + 1).collect()]  # bounded
        if not some:
            continue
        suspects = df.where(value.isin(some[:HITS])) if len(some) <= HITS else df
        if not suspects.groupBy(*columns).count().where("count > 1").isEmpty():
            return False
    return True


def verified(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """Those of the sets that tell all rows apart.

    A share of the values refutes most others, ``AT_ONCE`` sets in a pass; what is left is looked up in all
    rows, set by set. So no pass shuffles more than about a part of one column of hashes. Of a table of up to
    ``SMALL`` rows all values are looked at at once.
    """
    found = set(sets)
    small = df.count() <= SMALL
    with shuffles_removed(df.sparkSession):
        for at in range(0, len(sets), AT_ONCE):
            found -= refuted(df, sets[at : at + AT_ONCE], 1 if small else SHARE)
        return {s for s in sets if s in found and (small or is_unique(df, s))}


def minimal_keys(df: DataFrame, columns: Sequence[str] | None = None, most_columns: int = 3, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(columns, n_columns): the sets of up to ``most_columns`` complete columns that are unique and lose that with any column less.

    Sets are gone through by size. One that holds a key already found is none of them; one that repeats within a
    bounded sample repeats in the table; only what is left is looked up in the whole table.
    ``columns`` are joined by commas, in the table's order. An empty table has all single columns.
    """
    spark = df.sparkSession
    columns = list(columns or df.columns)
    usable = complete_columns(df, columns)
    sample = hashed_sample(df, usable, sample_rows) if usable else np.zeros((0, 0), dtype=np.int64)
    keys: list[tuple[str, ...]] = []
    for size in range(1, most_columns + 1):
        fresh = [c for c in combinations(usable, size) if not any(set(k) <= set(c) for k in keys)]
        open_ = [c for c in fresh if not repeats(sample, [usable.index(x) for x in c])]
        proven = verified(df, open_)
        keys += [c for c in open_ if c in proven]
    return spark.createDataFrame([(",".join(k), len(k)) for k in keys], "columns string, n_columns int")
