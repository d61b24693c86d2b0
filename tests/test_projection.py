from __future__ import annotations

import hashlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import (
    Audit,
    ColumnMap,
    add_audit,
    canonical_name,
    declared_length,
    declared_lengths,
    instant,
    project,
    record_hash,
)


def test_rules_render_as_sql():
    copied = ColumnMap("id", "BIGINT", source="src_id")
    assert copied.to_sql(strict=True) == "cast(src_id as BIGINT)"
    assert copied.to_sql() == "try_cast(src_id as BIGINT)"
    email = ColumnMap("email", "VARCHAR(120)", source="email", transform="lower(trim($))", null_default="''")
    assert email.to_sql(strict=True) == "cast(coalesce(lower(trim(email)), '') as STRING)"
    total = ColumnMap("total", "DECIMAL(18,2)", expression="price * quantity")
    assert total.to_sql(strict=True) == "cast(price * quantity as DECIMAL(18,2))"


@pytest.mark.parametrize(
    "bad",
    [
        {"target": "Id", "type": "INT", "source": "id"},
        {"target": "1d", "type": "INT", "source": "id"},
        {"target": "id", "type": "INT"},
        {"target": "id", "type": "INT", "source": "id", "expression": "id + 1"},
        {"target": "id", "type": "INT", "transform": "$ + 1", "expression": "id + 1"},
    ],
)
def test_contradictory_rules_are_refused(bad):
    with pytest.raises(ValueError):
        ColumnMap(**bad)


def test_mapping_needs_unique_targets(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        project(df, [])
    with pytest.raises(ValueError):
        project(df, [ColumnMap("a", "INT", source="id"), ColumnMap("a", "INT", source="id")])


def test_failed_casts_are_null_and_defaults_come_first(spark):
    values = ["12", " 7 ", "-3", "abc", "1x", "", None, "99999999999"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rules = [
        ColumnMap("n", "INT", source="v"),
        ColumnMap("d", "INT", source="v", null_default="'0'"),
    ]
    rows = [tuple(r) for r in project(df, rules).collect()]
    assert rows == [(12, 12), (7, 7), (-3, -3), (None, None), (None, None), (None, None), (None, 0), (None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        project(df, rules, strict=True).collect()


@pytest.mark.parametrize(
    "kind, values",
    [
        ("BIGINT", ["1", "+2", "-3 ", "\t4", "1.5", "1e3", "x", "5L", "", "９"]),
        ("DECIMAL(18,2)", ["1", "1.555", "-.5", "1e3", "E3", "x1", "", "NaN"]),
        ("DOUBLE", ["1", "1e3", "NaN", "Infinity", "-inf", "x", "", ".5", "1d"]),
        ("DATE", ["2024-01-31", "2024-1-1", "2024", " 2024-01-01 ", "x", "", "2024-13-01", "epoch"]),
        ("TIMESTAMP_NTZ", ["2024-01-31 10:00:00", "2024-01-31T10:00:00.5", "x", "", "10:00"]),
        ("BOOLEAN", ["true", "T", "yes", "Y", "1", "0", "no", "off", "x", "", " false "]),
    ],
)
def test_text_guard_never_changes_a_cast(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v string")
    guarded = project(df, [ColumnMap("x", kind, source="v")])
    plain = df.select(F.expr(f"try_cast(v as {kind}) as x"))
    assert [str(r.x) for r in guarded.collect()] == [str(r.x) for r in plain.collect()]


def test_projection_is_narrow_and_pruned(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = project(df, [ColumnMap("id", "BIGINT", source="o_orderkey")])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_audit_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x")], "id int, a string, b string")
    out = add_audit(df, "2026-01-01T03:00:00+03:00", "shop", Audit(surrogate_key="sk"), keys=["id"])
    assert out.columns == ["id", "a", "b", "load_ts", "source_system", "record_hash", "sk"]
    first, second = out.orderBy("id").collect()
    assert first.load_ts == datetime(2026, 1, 1)
    assert first.source_system == "shop"
    assert first.record_hash == hashlib.sha256(b"1||||x").hexdigest()
    assert second.record_hash == hashlib.sha256(b"2||||x").hexdigest()
    assert first.sk != second.sk
    bare = add_audit(df, "2026-01-01", "shop", Audit(record_hash=None))
    assert bare.columns == ["id", "a", "b", "load_ts", "source_system"]
    with pytest.raises(ValueError):
        add_audit(df, "2026-01-01", "shop", Audit(surrogate_key="sk"))


def test_hash_versions(spark):
    df = spark.createDataFrame([(None, "c"), ("", "c"), ("a||b", "c"), ("a", "b||c")], "x string, y string")
    one = [r[0] for r in df.select(record_hash(["x", "y"])).collect()]
    two = [r[0] for r in df.select(record_hash(["x", "y"], 2)).collect()]
    assert one[0] == one[1] and one[2] == df.select(record_hash(["x", "y"])).collect()[2][0]
    assert hashlib.sha256(b"a||b||c").hexdigest() == one[2] == one[3]
    assert len(set(two)) == 4
    with pytest.raises(ValueError):
        record_hash(["x"], 3)


def test_instant_takes_text_and_zoned_times(spark):
    zoned = datetime(2026, 1, 1, 12, tzinfo=timezone.utc)
    row = spark.range(1).select(instant("2026-01-01 12:00:00").alias("a"), instant(zoned).alias("b")).first()
    assert row.a == row.b == datetime(2026, 1, 1, 12)


def test_type_names():
    assert canonical_name("bigint") == "BIGINT"
    assert canonical_name("BIGINT") == "BIGINT"
    assert canonical_name("numeric") == canonical_name("NUMERIC(18, 2)") == "DECIMAL(38,9)"
    assert canonical_name("character varying", 120) == canonical_name("VARCHAR(120)") == "VARCHAR(120)"
    assert canonical_name("character varying") == "STRING"
    assert canonical_name("timestamp with time zone") == "TIMESTAMP"
    assert canonical_name("jsonb") == canonical_name("ltree") == canonical_name("integer[]") == "STRING"
    assert declared_length("VARCHAR(20)") == 20
    assert declared_length("STRING") is None
    rules = [ColumnMap("a", "VARCHAR(3)", source="x"), ColumnMap("b", "INT", source="x")]
    assert declared_lengths(rules) == {"a": 3}


def test_sized_text_is_kept_whole(spark):
    df = spark.createDataFrame([("abcdef",)], "v string")
    out = project(df, [ColumnMap("v", "VARCHAR(3)", source="v")])
    assert out.schema["v"].dataType == T.StringType()
    assert out.first().v == "abcdef"


def test_default_of_a_string_does_not_turn_it_into_a_number(spark):
    df = spark.createDataFrame([("5",), ("x",), (None,)], "v string")
    out = project(df, [ColumnMap("n", "INT", source="v", null_default="0")])
    assert [r.n for r in out.collect()] == [5, None, 0]
