"""Tables of external databases, read and written over JDBC."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Database kind -> JDBC address prefix and driver class.
JDBC_KINDS = {
    "postgres": ("jdbc:postgresql", "org.postgresql.Driver"),
    "greenplum": ("jdbc:postgresql", "org.postgresql.Driver"),
    "clickhouse": ("jdbc:clickhouse", "com.clickhouse.jdbc.ClickHouseDriver"),
}
FETCH_SIZE = 10_000


@dataclass(frozen=True)
class Connection:
    """Where a database is. User and password may be ``env:NAME`` or ``file:/path``."""

    kind: str
    host: str
    port: int
    database: str
    user: str
    password: str = field(repr=False)
    jdbc_options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in JDBC_KINDS:
            raise ValueError(f"unknown database kind {self.kind!r}")

    @property
    def url(self) -> str:
        return f"{JDBC_KINDS[self.kind][0]}://{self.host}:{self.port}/{self.database}"


@dataclass(frozen=True)
class Partitioning:
    """Splits a JDBC read into ``num_partitions`` ranges of a numeric, date or time column."""

    column: str
    lower: str | int
    upper: str | int
    num_partitions: int


def secret(value: str) -> str:
    """Resolve ``env:NAME`` and ``file:/path``; any other text is the value itself."""
    if value.startswith("env:"):
        name = value.removeprefix("env:")
        if name not in os.environ:
            raise KeyError(f"environment variable {name} is not set")
        return os.environ[name]
    if value.startswith("file:"):
        with open(value.removeprefix("file:"), encoding="utf-8") as handle:
            return handle.readline().strip()
    if value.startswith("vault:"):
        raise NotImplementedError("vault references are not supported")
    return value


def jdbc_options(
    connection: Connection,
    table: str,
    fetch_size: int = FETCH_SIZE,
    partitioning: Partitioning | None = None,
) -> dict[str, str]:
    """Options for ``format("jdbc")``; the connection's own options come last and win."""
    options = {
        "url": connection.url,
        "driver": JDBC_KINDS[connection.kind][1],
        "dbtable": table,
        "user": secret(connection.user),
        "password": secret(connection.password),
        "fetchsize": str(fetch_size),
    }
    if partitioning is not None:
        options |= {
            "partitionColumn": partitioning.column,
            "lowerBound": str(partitioning.lower),
            "upperBound": str(partitioning.upper),
            "numPartitions": str(partitioning.num_partitions),
        }
    return options | {name: str(value) for name, value in connection.jdbc_options.items()}


def read_jdbc(
    spark: SparkSession,
    connection: Connection,
    table: str,
    fetch_size: int = FETCH_SIZE,
    partitioning: Partitioning | None = None,
) -> DataFrame:
    """A database table. Without ``partitioning`` one task reads all of it.

    Filter the result as usual (``read_incremental``): Spark sends the filter and the
    column list to the database.
    """
    return spark.read.format("jdbc").options(**jdbc_options(connection, table, fetch_size, partitioning)).load()
