"""File tables and the incremental slice."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FILE_FORMATS = ("parquet", "orc", "csv", "json")


def read_table(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Full snapshot of a file table. CSV and JSON need a schema: inferring one costs a whole scan."""
    if file_format not in FILE_FORMATS:
        raise ValueError(f"unknown file format {file_format!r}")
    if schema is None and file_format in ("csv", "json"):
        raise ValueError(f"{file_format} needs a schema")
    reader = spark.read.format(file_format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_incremental(
    df: DataFrame,
    watermark: str,
    lower_bound: datetime | str | int | Column | None,
    overlap: str | None = None,
) -> DataFrame:
    """Rows with ``watermark > lower_bound``; everything on a first run (no bound).

    The comparison is against a constant of the column's own type, so Catalyst pushes it
    into Parquet, ORC and JDBC scans. ``overlap`` (an interval such as ``'1 day'``) reads
    that much before the bound again, for rows that arrive late with an older watermark;
    combine it with a keyed append, which drops what is there already.
    """
    if lower_bound is None:
        return df
    column_type = df.schema[watermark].dataType
    bound = lower_bound if isinstance(lower_bound, Column) else F.lit(lower_bound)
    bound = bound.cast(column_type)
    if overlap is not None:
        bound = (bound - F.expr(f"interval {overlap}")).cast(column_type)
    return df.where(F.col(watermark) > bound)
