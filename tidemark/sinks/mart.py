"""Export of mart tables to files or to an external database."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidemark.functions.projection import ColumnMap
from tidemark.sources.jdbc import JDBC_KINDS, secret

WRITE_MODES = ("overwrite", "append")
SINK_KINDS = ("greenplum", "clickhouse")
BATCH_ROWS = 10_000


@dataclass(frozen=True)
class MartSink:
    """An external table. User and password may be ``env:NAME`` or ``file:/path``."""

    name: str
    kind: str
    jdbc_url: str
    schema: str
    table: str
    user: str
    password: str = field(repr=False)
    write_mode: str = "overwrite"

    def __post_init__(self) -> None:
        if self.kind not in SINK_KINDS:
            raise ValueError(f"unknown sink kind {self.kind!r}")
        if self.write_mode not in WRITE_MODES:
            raise ValueError(f"unknown write mode {self.write_mode!r}")


def mart_columns(
    df: DataFrame, mapping: Sequence[ColumnMap], keep: Sequence[str] = ()
) -> DataFrame:
    """Mapped columns only; technical and version columns stay behind unless kept."""
    return df.select(*[rule.target for rule in mapping], *keep)


def distributed(df: DataFrame, primary_keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows spread by the hash of the first primary key, as a distributed database stores them.

    A rebalance, not a plain repartition: a value of the first key column that holds much
    of the mart is split over several tasks.
    """
    if not primary_keys:
        raise ValueError("distribution needs a primary key")
    size = [partitions] if partitions else []
    return df.hint("rebalance", *size, primary_keys[0])


def ordered(df: DataFrame, primary_keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in primary-key order: ranges over tasks, sorted within. Not one global sort task."""
    if not primary_keys:
        raise ValueError("sort order needs a primary key")
    ranged = (
        df.repartitionByRange(partitions, *primary_keys) if partitions else df.repartitionByRange(*primary_keys)
    )
    return ranged.sortWithinPartitions(*primary_keys)


def laid_out(df: DataFrame, kind: str, primary_keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    return (distributed if kind == "greenplum" else ordered)(df, primary_keys, partitions)


def export_files(
    df: DataFrame,
    path: str,
    mapping: Sequence[ColumnMap],
    kind: str,
    primary_keys: Sequence[str],
    mode: str = "overwrite",
    file_format: str = "parquet",
    partitions: int | None = None,
    keep: Sequence[str] = (),
) -> None:
    """Write a mart as files in the layout the external database wants."""
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}")
    rows = laid_out(mart_columns(df, mapping, keep), kind, primary_keys, partitions)
    rows.write.format(file_format).mode(mode).save(path)


def table_layout(kind: str, primary_keys: Sequence[str]) -> str:
    """What Spark appends to CREATE TABLE when the external table does not exist yet."""
    if kind == "greenplum":
        return f"DISTRIBUTED BY ({primary_keys[0]})"
    return f"ENGINE = MergeTree ORDER BY ({', '.join(primary_keys)})"


def sink_options(sink: MartSink, primary_keys: Sequence[str]) -> dict[str, str]:
    """Options for ``format("jdbc")``; an overwrite empties the table and keeps its definition."""
    return {
        "url": sink.jdbc_url,
        "driver": JDBC_KINDS[sink.kind][1],
        "dbtable": f"{sink.schema}.{sink.table}",
        "user": secret(sink.user),
        "password": secret(sink.password),
        "batchsize": str(BATCH_ROWS),
        "truncate": "true",
        "createTableOptions": table_layout(sink.kind, primary_keys),
    }


def export_mart(
    df: DataFrame,
    sink: MartSink,
    mapping: Sequence[ColumnMap],
    primary_keys: Sequence[str],
    connections: int = 16,
    keep: Sequence[str] = (),
) -> None:
    """Write a mart to its external table, over at most ``connections`` connections."""
    rows = laid_out(mart_columns(df, mapping, keep), sink.kind, primary_keys, connections)
    rows.write.format("jdbc").options(**sink_options(sink, primary_keys)).mode(sink.write_mode).save()
