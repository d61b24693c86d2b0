"""Compare a source with a target by key and record hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.audit import record_hash
from tidemark.operators.common import all_of

STATUSES = ("missing", "extra", "changed", "equal")


def reconcile(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    compared: Sequence[str] | None = None,
    hash_column: str | None = None,
) -> DataFrame:
    """Per key: rows on each side and a status.

    ``missing``: only in the source; ``extra``: only in the target; ``equal``: the same
    rows on both sides; ``changed``: otherwise. Rows are compared by the hash of
    ``compared`` (default: all columns of the source) or by a stored ``hash_column``.

    Both sides are stacked and summed up per key, not joined: one shuffle of a few numbers
    per key and map task, with repeated keys compared as whole groups instead of pairing
    their rows. NULL keys form one group.
    """
    compared = list(compared or source.columns)

    def side(df: DataFrame, sign: int) -> DataFrame:
        mark = F.col(hash_column) if hash_column else record_hash(compared, version=2)
        marked = df.select(*keys, mark.alias("_hash"))
        return marked.select(*keys, F.lit(sign).cast("bigint").alias("_sign"), *_hash_parts("_hash"))

    rows = side(source, 1).unionByName(side(target, -1))
    per_key = rows.groupBy(*keys).agg(
        F.count_if(F.col("_sign") == 1).alias("source_rows"),
        F.count_if(F.col("_sign") == -1).alias("target_rows"),
        *[F.sum(F.col("_sign") * F.col(part)).alias(part) for part in _PARTS],
    )
    same = all_of([F.col("source_rows") == F.col("target_rows"), *[F.col(part) == 0 for part in _PARTS]])
    status = (
        F.when(F.col("target_rows") == 0, "missing")
        .when(F.col("source_rows") == 0, "extra")
        .when(same, "equal")
        .otherwise("changed")
    )
    return per_key.select(*keys, "source_rows", "target_rows", status.alias("status"))


_PARTS = tuple(f"_part_{i}" for i in range(6))


def _hash_parts(name: str) -> list[Column]:
    """Six 21-bit numbers of a record hash. Their sums over a key's rows do not depend on
    order, fit a BIGINT for four million million rows of one key, and differ, short of a
    126-bit collision, when the rows do."""
    parts = []
    for seed in (1, 2):
        number = F.xxhash64(F.lit(seed), F.col(name))
        parts += [F.shiftrightunsigned(number, bits).bitwiseAND(F.lit(0x1FFFFF)) for bits in (1, 22, 43)]
    return [part.alias(alias) for part, alias in zip(parts, _PARTS)]


def reconcile_summary(compared: DataFrame) -> DataFrame:
    """Keys per status of a ``reconcile`` result; one row with a count for each status."""
    return compared.agg(*[F.count_if(F.col("status") == status).alias(f"{status}_keys") for status in STATUSES])
