"""Column mappings: one rule per target column, applied in a single select."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.types import cast_type, declared_length, text_pattern

# Fixed value: how target columns may be named.
_TARGET_NAME = re.compile(r"^[a-z_][a-z0-9_]*$")


@dataclass(frozen=True)
class ColumnMap:
    """How one target column is made.

    Either ``source`` (copied as is), ``source`` with ``transform`` (a Spark SQL
    fragment in which ``$`` stands for the source column), or ``expression`` (any
    Spark SQL expression over the source columns). ``null_default`` is a SQL literal
    used where the value is NULL; it is applied before the cast.
    """

    target: str
    type: str
    source: str | None = None
    transform: str | None = None
    expression: str | None = None
    null_default: str | None = None
    pk: bool = False
    description: str | None = None

    def __post_init__(self) -> None:
        if not _TARGET_NAME.match(self.target):
            raise ValueError(f"bad target column name {self.target!r}")
        if self.expression is not None and (self.source or self.transform):
            raise ValueError(f"{self.target}: expression excludes source and transform")
        if self.expression is None and not self.source:
            raise ValueError(f"{self.target}: source or expression is required")

    def source_sql(self) -> str:
        """The value before default and cast, as Spark SQL."""
        if self.expression is not None:
            return self.expression
        if self.transform is not None:
            return self.transform.replace("$", self.source)
        return self.source

    def value_sql(self, text: bool = False) -> str:
        """The value before its cast. A default for a string is text too: in ANSI mode
        ``coalesce(string, 0)`` would turn the strings into numbers, and fail on them."""
        if self.null_default is None:
            return self.source_sql()
        default = f"cast({self.null_default} as string)" if text else self.null_default
        return f"coalesce({self.source_sql()}, {default})"

    def to_sql(self, strict: bool = False, text: bool = False) -> str:
        """The whole rule as Spark SQL; a failed cast is NULL unless ``strict``.

        ``text`` says that the value is a string. A failing ``try_cast`` throws and catches
        an exception for its row, some 50 times the cost of one that succeeds, so text that
        cannot be a number, date or flag is sorted out by a pattern first.
        """
        value, kind = self.value_sql(text), cast_type(self.type)
        if strict:
            return f"cast({value} as {kind})"
        pattern = text_pattern(kind) if text else None
        if pattern is None:
            return f"try_cast({value} as {kind})"
        pattern = pattern.replace("\\", "\\\\")  # as a SQL literal
        return f"case when {value} rlike '{pattern}' then try_cast({value} as {kind}) end"


ANSI = "spark.sql.ansi.enabled"


@contextmanager
def lenient(spark: SparkSession, strict: bool = False) -> Iterator[None]:
    """Within it, expressions are analysed so that bad values give NULL instead of failing.

    An expression keeps what held when it was analysed, so the setting is needed only while a
    projection is made, not while it runs; it is put back at the end.
    """
    before = spark.conf.get(ANSI)
    spark.conf.set(ANSI, "true" if strict else "false")
    try:
        yield
    finally:
        spark.conf.set(ANSI, before)


def project(df: DataFrame, mapping: Sequence[ColumnMap], strict: bool = False, also: Sequence[Column] = ()) -> DataFrame:
    """Apply a mapping. A narrow projection, so the scan reads mapped columns only.

    A bad value in a transform, an expression or a cast gives NULL, unless ``strict``. ``also``
    are further columns to select next to the mapped ones.
    """
    with lenient(df.sparkSession, strict):
        return df.select(*mapped_columns(df, mapping, strict), *also)


def mapped_columns(df: DataFrame, mapping: Sequence[ColumnMap], strict: bool = False) -> list[Column]:
    """The columns that ``project`` selects, for use next to others."""
    check_mapping(mapping)
    values = df.select(*[F.expr(rule.source_sql()).alias(rule.target) for rule in mapping]).schema
    return [
        F.expr(rule.to_sql(strict, isinstance(value.dataType, StringType))).alias(rule.target)
        for rule, value in zip(mapping, values)
    ]


def check_mapping(mapping: Sequence[ColumnMap]) -> None:
    if not mapping:
        raise ValueError("a mapping needs at least one column")
    targets = [rule.target for rule in mapping]
    repeated = sorted({name for name in targets if targets.count(name) > 1})
    if repeated:
        raise ValueError(f"target columns mapped more than once: {repeated}")


def declared_lengths(mapping: Sequence[ColumnMap]) -> dict[str, int]:
    """Length limits that VARCHAR(n) mappings declare; input for ``check_lengths``."""
    limits = {rule.target: declared_length(rule.type) for rule in mapping}
    return {name: limit for name, limit in limits.items() if limit is not None}
