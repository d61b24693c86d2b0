"""The small set of column types that warehouse tables are declared in."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Database type name -> canonical type name. Any other name is STRING.
DATABASE_TYPES = {
    "smallint": "SMALLINT",
    "integer": "INT",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "real": "FLOAT",
    "double precision": "DOUBLE",
    "numeric": "DECIMAL(38,9)",
    "text": "STRING",
    "uuid": "STRING",
    "date": "DATE",
    "timestamp without time zone": "TIMESTAMP",
    "timestamp with time zone": "TIMESTAMP",
    "json": "STRING",
    "jsonb": "STRING",
    "bytea": "BINARY",
}

# Short names that drivers report for the same types.
SHORT_NAMES = {
    "int2": "smallint",
    "int4": "integer",
    "int": "integer",
    "int8": "bigint",
    "bool": "boolean",
    "float4": "real",
    "float8": "double precision",
    "decimal": "numeric",
    "timestamp": "timestamp without time zone",
    "timestamptz": "timestamp with time zone",
    "varchar": "character varying",
    "char": "character",
    "bpchar": "character",
}

_SIZED = re.compile(r"^\s*([a-z0-9 ]+?)\s*(?:\(\s*(\d+)\s*(?:,\s*\d+\s*)?\))?\s*$", re.IGNORECASE)


def canonical_name(database_type: str, length: int | None = None) -> str:
    """Canonical type name for a database type, e.g. ``character varying`` and 120."""
    match = _SIZED.match(database_type)
    if not match:
        return "STRING"
    base = " ".join(match.group(1).lower().split())
    base = SHORT_NAMES.get(base, base)
    if base in ("character varying", "character"):
        size = length or match.group(2)
        return f"VARCHAR({size})" if size else "STRING"
    return DATABASE_TYPES.get(base, "STRING")


def column_type_name(data_type: T.DataType, timestamp_type: str = "TIMESTAMP") -> str:
    """Canonical type name for a column of a DataFrame."""
    if isinstance(data_type, (T.ByteType, T.ShortType)):
        return "SMALLINT"
    if isinstance(data_type, T.IntegerType):
        return "INT"
    if isinstance(data_type, T.LongType):
        return "BIGINT"
    if isinstance(data_type, T.BooleanType):
        return "BOOLEAN"
    if isinstance(data_type, T.FloatType):
        return "FLOAT"
    if isinstance(data_type, T.DoubleType):
        return "DOUBLE"
    if isinstance(data_type, T.DecimalType):
        return "DECIMAL(38,9)"
    if isinstance(data_type, T.DateType):
        return "DATE"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return timestamp_type
    if isinstance(data_type, T.BinaryType):
        return "BINARY"
    if isinstance(data_type, (T.VarcharType, T.CharType)):
        return f"VARCHAR({data_type.length})"
    return "STRING"


def declared_length(type_name: str) -> int | None:
    """The n of VARCHAR(n) or CHAR(n), else None."""
    match = re.match(r"^\s*(?:var)?char(?:acter)?(?:\s+varying)?\s*\(\s*(\d+)\s*\)\s*$", type_name, re.IGNORECASE)
    return int(match.group(1)) if match else None


def cast_type(type_name: str) -> str:
    """The type to cast to. Spark keeps VARCHAR(n) values whole, so they are plain STRING."""
    return "STRING" if declared_length(type_name) is not None else type_name


def text_pattern(type_name: str) -> str | None:
    """A pattern that all text castable to the type matches, and most other text does not.

    It looks at the letters and digits only; what surrounds them is left to the cast.
    """
    base = type_name.split("(")[0].strip().upper()
    if base in ("TINYINT", "SMALLINT", "INT", "INTEGER", "BIGINT", "LONG", "SHORT", "BYTE"):
        return "^[^A-Za-z]*[0-9][^A-Za-z]*$"
    if base in ("DECIMAL", "DEC", "NUMERIC"):
        return r"^[^\p{Nd}A-Za-z]*\p{Nd}"  # decimals may be written in any script's digits
    if base in ("FLOAT", "REAL", "DOUBLE"):
        return "^[^0-9A-Za-z]*([0-9]|[Nn][Aa][Nn]|[Ii][Nn][Ff])"
    if base in ("DATE", "TIMESTAMP", "TIMESTAMP_NTZ", "TIMESTAMP_LTZ"):
        return "^[^0-9A-Za-z]*T?[0-9]"
    if base == "BOOLEAN":
        return "^[^0-9A-Za-z]*([TtFfYyNn01])"
    return None
