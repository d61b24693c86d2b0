from tidemark.functions.audit import Audit, add_audit, instant, record_hash, surrogate_key
from tidemark.functions.projection import ColumnMap, declared_lengths, project
from tidemark.functions.types import canonical_name, cast_type, column_type_name, declared_length

__all__ = [
    "Audit",
    "ColumnMap",
    "add_audit",
    "canonical_name",
    "cast_type",
    "column_type_name",
    "declared_length",
    "declared_lengths",
    "instant",
    "project",
    "record_hash",
    "surrogate_key",
]
