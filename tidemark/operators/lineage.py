"""Lineage and run audit taken from the loaded rows themselves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.audit import Audit, instant
from tidemark.functions.projection import ColumnMap, lenient, mapped_columns
from tidemark.operators.common import BATCH, prefixed, same_keys
from tidemark.operators.quality import rows_per_column
from tidemark.operators.reconcile import reconcile
from tidemark.operators.scd2 import Versions


def column_edges(mapping: Sequence[ColumnMap]) -> list[tuple[str, str]]:
    """(source column, target column) of every rule that names a source."""
    return [(rule.source, rule.target) for rule in mapping if rule.source is not None]


def column_lineage_audit(
    source: DataFrame, target: DataFrame, mapping: Sequence[ColumnMap], keys: Sequence[str]
) -> DataFrame:
    """Per mapped column: rows compared, rows where the target is not what the mapping gives now,
    and rows where the mapping turned a value into NULL.

    ``keys`` are target columns, unique on both sides. Free expressions name no source
    column and give no row.
    """
    rules = [rule for rule in mapping if rule.source is not None]
    with lenient(source.sparkSession):
        made = {rule.target: column for rule, column in zip(mapping, mapped_columns(source, mapping))}
        expected = source.select(
            *[made[key] for key in keys],
            *[made[rule.target].alias(f"_value_{rule.target}") for rule in rules],
            *[F.expr(rule.source).isNull().alias(f"_empty_{rule.target}") for rule in rules],
        )
    kept = target.select(*keys, *[F.col(rule.target).alias(f"_kept_{rule.target}") for rule in rules])
    joined = kept.join(prefixed(expected), same_keys(keys), "inner")
    figures = [F.count(F.lit(1)).alias("_rows")]
    for rule in rules:
        value = F.col(f"{BATCH}_value_{rule.target}")
        figures += [
            F.count_if(~F.col(f"_kept_{rule.target}").eqNullSafe(value)).alias(f"_off_{rule.target}"),
            F.count_if(value.isNull() & ~F.col(f"{BATCH}_empty_{rule.target}")).alias(f"_lost_{rule.target}"),
            F.lit(rule.source).alias(f"_source_{rule.target}"),
        ]
    return rows_per_column(
        joined.agg(*figures),
        {r.target: (f"_source_{r.target}", "_rows", f"_off_{r.target}", f"_lost_{r.target}") for r in rules},
        ("source_column", "rows_compared", "mismatches", "nulls_produced"),
    ).withColumnRenamed("column_name", "target_column")


def dataset_lineage(loads: Mapping[str, DataFrame], watermark: str | None = None, audit: Audit = Audit()) -> DataFrame:
    """Per upstream system, downstream table and load: rows, first and last watermark.

    ``loads`` names the loaded tables; where rows came from, and when, is in their
    technical columns.
    """

    def one(name: str, df: DataFrame) -> DataFrame:
        figures = [F.count(F.lit(1)).alias("row_count")]
        if watermark is not None:
            figures += [F.min(watermark).alias("first_watermark"), F.max(watermark).alias("last_watermark")]
        return (
            df.groupBy(F.col(audit.source_system).alias("upstream"), F.col(audit.load_ts).alias("load_ts"))
            .agg(*figures)
            .withColumn("downstream", F.lit(name))
        )

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in loads.items()])


def lineage_events(edges: DataFrame, mappings: Mapping[str, Sequence[ColumnMap]]) -> DataFrame:
    """One JSON document per edge of ``dataset_lineage``, with the column edges of the downstream table."""
    documents = F.create_map(
        *[
            part
            for name, mapping in mappings.items()
            for part in (
                F.lit(name),
                F.array(
                    *[
                        F.struct(F.lit(source).alias("source"), F.lit(target).alias("target"))
                        for source, target in column_edges(mapping)
                    ]
                ),
            )
        ]
    )
    event = F.struct(*[F.col(c) for c in sorted(edges.columns)], documents[F.col("downstream")].alias("columns"))
    return edges.select("downstream", "upstream", "load_ts", F.to_json(event).alias("event"))


def run_audit(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    load_ts: datetime | str,
    versions: Versions | None = None,
    audit: Audit = Audit(),
) -> DataFrame:
    """One row of counts for a run: inserted, updated, closed, unchanged.

    With ``versions`` (history tables) the counts come from ``after`` alone: the run
    closed the versions that end at its time and opened those that start at it; a key in
    both was updated. Without, keys of both states are compared by record hash.
    """
    time = instant(load_ts)
    if versions is not None:
        flag = F.coalesce(F.col(versions.is_current), F.lit(False))
        closed = ~flag & (F.col(versions.valid_to) == time)
        opened = flag & (F.col(versions.valid_from) == time)
        per_key = (
            after.where(closed | flag)
            .groupBy(*keys)
            .agg(
                F.count_if(closed).alias("_closed"),
                F.count_if(opened).alias("_opened"),
                F.count_if(flag & ~opened).alias("_kept"),
            )
        )
        both = F.least("_closed", "_opened")
        figures = per_key.agg(
            F.coalesce(F.sum(F.col("_opened") - both), F.lit(0)).alias("inserted"),
            F.coalesce(F.sum(both), F.lit(0)).alias("updated"),
            F.coalesce(F.sum("_closed"), F.lit(0)).alias("closed"),
            F.coalesce(F.sum("_kept"), F.lit(0)).alias("unchanged"),
        )
    else:
        compared = reconcile(before, after, keys, hash_column=audit.record_hash)
        figures = compared.agg(
            F.count_if(F.col("status") == "extra").alias("inserted"),
            F.count_if(F.col("status") == "changed").alias("updated"),
            F.count_if(F.col("status") == "missing").alias("closed"),
            F.count_if(F.col("status") == "equal").alias("unchanged"),
        )
    return figures.select(time.alias("load_ts"), "*")
