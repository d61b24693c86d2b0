"""Writing warehouse tables: full replacement, append, partitions and buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

TABLE_FORMATS = ("parquet", "orc", "iceberg")


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one partition value together, in files of even size.

    Without this every task writes a file per value it meets. Spark's rebalance also
    splits a value that holds much of the table over several tasks and joins small ones.
    """
    return partitionable(df, partition_by).hint("rebalance", *partition_by) if partition_by else df


def partitionable(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Fails on an empty string in a partition column: a folder name cannot tell it from NULL."""
    texts = [name for name in partition_by if isinstance(df.schema[name].dataType, StringType)]
    message = "an empty string in partition column "
    return df.withColumns(
        {name: F.when(F.col(name) == "", F.raise_error(F.lit(message + name))).otherwise(F.col(name)) for name in texts}
    )


def _writer(df: DataFrame, file_format: str, mode: str, partition_by: Sequence[str]) -> DataFrameWriter:
    if file_format not in TABLE_FORMATS:
        raise ValueError(f"unknown table format {file_format!r}")
    writer = df.write.format(file_format).mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def full_load(df: DataFrame, path: str, file_format: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace everything at ``path``; the path is created if absent.

    Static, whatever the session says: partitions that ``df`` has no rows for go as well. Readers
    of the old files fail meanwhile; ``VersionedTable.replace`` keeps them readable.
    """
    writer = _writer(balanced(df, partition_by), file_format, "overwrite", partition_by)
    writer.option("partitionOverwriteMode", "static").save(path)


def append(df: DataFrame, path: str, file_format: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Add the rows to the table at ``path``."""
    _writer(balanced(df, partition_by), file_format, "append", partition_by).save(path)


def append_with_watermark(
    df: DataFrame, path: str, watermark: str, file_format: str = "parquet", partition_by: Sequence[str] = ()
) -> object:
    """Append, and return the highest watermark written (None if there were no rows).

    The maximum is observed while the rows are written, so the source is read once.
    """
    seen = Observation()
    rows = observe(balanced(df, partition_by), seen, {"watermark": F.max(watermark)})
    _writer(rows, file_format, "append", partition_by).save(path)
    return seen.get["watermark"]


def observe(df: DataFrame, observation: Observation, figures: dict[str, Column]) -> DataFrame:
    """Take figures while ``df`` is written. Keep it last, after any shuffle: a task of the
    writing stage counts once, however often it is retried."""
    return df.observe(observation, *[column.alias(name) for name, column in figures.items()])


def full_load_table(
    df: DataFrame,
    table: str,
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    path: str | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Replace a catalog table.

    Buckets on the business keys, sorted within, let later merges and joins on these keys
    read the table without shuffling it.
    """
    options = {**(properties or {}), **({"path": path} if path else {})}
    writer = _writer(balanced(df, partition_by), file_format, "overwrite", partition_by).options(**options)
    if bucket_by:
        if buckets < 1:
            raise ValueError("give the number of buckets")
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(table)


def create_or_replace(
    df: DataFrame,
    table: str,
    file_format: str = "iceberg",
    partition_by: Sequence[str] = (),
    properties: dict[str, str] | None = None,
) -> None:
    """Replace a table of a catalog that can swap tables atomically."""
    writer = balanced(df, partition_by).writeTo(table).using(file_format)
    for name, value in (properties or {}).items():
        writer = writer.tableProperty(name, value)
    if partition_by:
        writer = writer.partitionedBy(*[F.col(name) for name in partition_by])
    writer.createOrReplace()
