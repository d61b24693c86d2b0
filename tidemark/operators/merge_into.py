"""The same merges as MERGE statements, for catalogs whose tables support them.

Plain Parquet and ORC tables do not; there the DataFrame forms are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.audit import Audit
from tidemark.operators.common import all_of, any_of
from tidemark.operators.scd1 import default_tracked
from tidemark.operators.scd2 import Versions


def scd1_merge_into(
    batch: DataFrame, table: str, keys: Sequence[str], tracked: Sequence[str] = (), audit: Audit = Audit()
) -> None:
    """Merge a batch into a catalog table in place, as ``scd1_upsert`` does."""
    tracked = list(tracked) or default_tracked(batch, keys, audit)
    assigned = [*tracked, *audit.columns()]
    marker = audit.record_hash or audit.load_ts
    name = table.split(".")[-1]
    same = all_of(F.col(f"{name}.{k}") == F.col(f"batch.{k}") for k in keys)
    (
        batch.alias("batch")
        .mergeInto(table, same)
        .whenMatched(F.col(f"{name}.{marker}") != F.col(f"batch.{marker}"))
        .update({c: F.col(f"batch.{c}") for c in assigned})
        .whenNotMatched()
        .insert({c: F.col(f"batch.{c}") for c in [*keys, *assigned]})
        .merge()
    )


def scd2_merge_into(
    batch: DataFrame,
    table: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    load_ts: datetime | str,
    versions: Versions = Versions(),
    audit: Audit = Audit(),
) -> None:
    """Close changed versions, then insert open ones; safe to run again after a crash."""
    name = table.split(".")[-1]
    start, end, flag = versions.columns()
    rows = batch.select("*", *versions.open(load_ts)).alias("batch")
    same = all_of(F.col(f"{name}.{k}") == F.col(f"batch.{k}") for k in keys) & F.col(f"{name}.{flag}")
    changed = any_of(~F.col(f"{name}.{c}").eqNullSafe(F.col(f"batch.{c}")) for c in tracked)
    rows.mergeInto(table, same).whenMatched(changed).update(
        {end: F.col(f"batch.{start}"), flag: F.lit(False)}
    ).merge()
    inserted = [*keys, *tracked, *versions.columns(), *audit.columns()]
    rows.mergeInto(table, same).whenNotMatched().insert({c: F.col(f"batch.{c}") for c in inserted}).merge()
