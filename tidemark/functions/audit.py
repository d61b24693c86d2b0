"""Technical columns: load time, source system, record hash, surrogate key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_SEPARATOR = "||"


@dataclass(frozen=True)
class Audit:
    """Names of the technical columns; None switches a column off."""

    load_ts: str = "load_ts"
    source_system: str = "source_system"
    record_hash: str | None = "record_hash"
    surrogate_key: str | None = None

    def columns(self) -> list[str]:
        """Audit columns that a load overwrites on an update."""
        names = [self.load_ts, self.source_system, self.record_hash, self.surrogate_key]
        return [name for name in names if name]


def utc_text(value: datetime | str) -> str:
    """A time as text, in UTC; a time without a zone is taken as UTC already."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value.isoformat(sep=" ")


def instant(value: datetime | str | Column) -> Column:
    """A run's constant time as TIMESTAMP_NTZ in UTC, independent of the session zone."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(utc_text(value)).cast("timestamp_ntz")


def record_hash(columns: Sequence[str], version: int = 1) -> Column:
    """SHA-256 over the columns' text, in the order given.

    Version 1 turns NULL into an empty string and joins with a double bar, so NULL and
    '' look the same, and so do ('a||b', 'c') and ('a', 'b||c'). Version 2 writes each
    value with its length and marks NULLs, so different rows give different texts.
    """
    texts = [F.col(name).cast("string") for name in columns]
    if version == 1:
        return F.sha2(F.concat_ws(HASH_SEPARATOR, *[F.coalesce(text, F.lit("")) for text in texts]), 256)
    if version == 2:
        parts = [
            F.when(text.isNull(), F.lit("~")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))
            for text in texts
        ]
        return F.sha2(F.concat(*parts), 256)
    raise ValueError(f"unknown hash version {version}")


def surrogate_key(keys: Sequence[str]) -> Column:
    """A key that depends on the business key only, so a retried task gives the same one."""
    return record_hash(keys, version=2)


def add_audit(
    df: DataFrame,
    load_ts: datetime | str | Column,
    source_system: str,
    audit: Audit = Audit(),
    hashed: Sequence[str] | None = None,
    keys: Sequence[str] = (),
    hash_version: int = 1,
) -> DataFrame:
    """Add the technical columns in one projection. All columns of ``df`` are hashed by default."""
    added = [instant(load_ts).alias(audit.load_ts), F.lit(source_system).alias(audit.source_system)]
    if audit.record_hash:
        added.append(record_hash(hashed or df.columns, hash_version).alias(audit.record_hash))
    if audit.surrogate_key:
        if not keys:
            raise ValueError("a surrogate key needs business keys")
        added.append(surrogate_key(keys).alias(audit.surrogate_key))
    return df.select("*", *added)
