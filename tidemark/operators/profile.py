"""Learn a table from its data: column profile, key candidates, canonical types."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.projection import ColumnMap
from tidemark.functions.types import cast_type, column_type_name
from tidemark.operators.common import has_null
from tidemark.operators.quality import rows_per_column

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def profile_table(
    df: DataFrame, columns: Sequence[str] | None = None, distinct: str = "exact", timestamp_type: str = "TIMESTAMP"
) -> DataFrame:
    """Per column: canonical type, rows, NULLs, distinct values, lowest and highest value as text.

    ``distinct`` is ``"exact"`` (values are shuffled once), ``"approx"`` (a sketch in the
    same pass, for very large tables) or ``"none"``.
    """
    columns = list(columns or df.columns)
    figures: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for name in columns:
        ordered = not isinstance(df.schema[name].dataType, (*_NESTED, T.BinaryType))
        value = F.col(name)
        figures += [
            F.count_if(value.isNull()).alias(f"_nulls_{name}"),
            (F.min(value).cast("string") if ordered else F.lit(None).cast("string")).alias(f"_min_{name}"),
            (F.max(value).cast("string") if ordered else F.lit(None).cast("string")).alias(f"_max_{name}"),
            F.lit(column_type_name(df.schema[name].dataType, timestamp_type)).alias(f"_type_{name}"),
        ]
        if distinct == "approx":
            figures.append(F.approx_count_distinct(_comparable(df, name)).alias(f"_distinct_{name}"))
        elif distinct != "exact":
            figures.append(F.lit(None).cast("bigint").alias(f"_distinct_{name}"))
    names = ["column_type", "row_count", "null_count", "min_value", "max_value"]
    parts = {name: [f"_type_{name}", "_rows", f"_nulls_{name}", f"_min_{name}", f"_max_{name}"] for name in columns}
    if distinct != "exact":
        names.append("distinct_count")
        parts = {name: [*part, f"_distinct_{name}"] for name, part in parts.items()}
        return rows_per_column(df.agg(*figures), parts, names)
    plain = rows_per_column(df.agg(*figures), parts, names)
    # Exact counts go column by column: one aggregate over all of them would multiply rows by columns.
    counted = reduce(DataFrame.unionByName, [_distinct_values(df, name) for name in columns])
    return plain.join(counted, "column_name")  # both sides have one row per column


def _distinct_values(df: DataFrame, name: str) -> DataFrame:
    values = df.select(_comparable(df, name).alias("value")).distinct()
    return values.agg(F.count("value").alias("distinct_count")).select(F.lit(name).alias("column_name"), "distinct_count")


def _comparable(df: DataFrame, name: str) -> Column:
    """Maps cannot be grouped on; their JSON text can."""
    return F.to_json(name) if isinstance(df.schema[name].dataType, T.MapType) else F.col(name)


def key_candidates(df: DataFrame, candidates: Sequence[Sequence[str]]) -> DataFrame:
    """Per candidate column set: rows, distinct values, rows with a NULL, and whether it is a key.

    Each candidate reads its own columns only.
    """

    def measure(columns: Sequence[str]) -> DataFrame:
        groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
        no_null = ~has_null(columns)
        totals = groups.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
            F.count_if(no_null).alias("distinct_count"),
            F.coalesce(F.sum(F.when(no_null, 0).otherwise(F.col("_n"))), F.lit(0)).alias("null_rows"),
        )
        is_key = (F.col("null_rows") == 0) & (F.col("distinct_count") == F.col("row_count"))
        return totals.select(F.lit(",".join(columns)).alias("columns"), "*", is_key.alias("is_key"))

    return reduce(DataFrame.unionByName, [measure(columns) for columns in candidates])


def draft_mapping(df: DataFrame, keys: Sequence[str] = (), timestamp_type: str = "TIMESTAMP") -> list[ColumnMap]:
    """The mapping a first full load would use: every column copied, in its canonical type."""
    drafts = []
    for field in df.schema.fields:
        type_name = column_type_name(field.dataType, timestamp_type)
        target = field.name.lower()
        if isinstance(field.dataType, _NESTED):
            drafts.append(
                ColumnMap(target, type_name, source=f"`{field.name}`", transform="to_json($)", pk=field.name in keys)
            )
        else:
            drafts.append(ColumnMap(target, type_name, source=f"`{field.name}`", pk=field.name in keys))
    return drafts


def canonicalise(df: DataFrame, timestamp_type: str = "TIMESTAMP") -> DataFrame:
    """The table in canonical types; arrays, maps and structs become JSON text."""
    return df.select(
        *[
            (F.to_json(f.name) if isinstance(f.dataType, _NESTED) else F.col(f.name))
            .cast(cast_type(column_type_name(f.dataType, timestamp_type)))
            .alias(f.name)
            for f in df.schema.fields
        ]
    )
