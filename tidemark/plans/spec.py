"""What one warehouse load is: source, target, strategy, mapping and technical columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from typing import Any

from tidemark.functions.audit import Audit
from tidemark.functions.projection import ColumnMap, check_mapping
from tidemark.operators.scd2 import Versions
from tidemark.sinks.mart import MartSink
from tidemark.sources.jdbc import Connection

LAYERS = ("stg", "ods", "dds", "dm")
# How sources and loads may be named.
_SOURCE_REF = re.compile(r"^[a-z0-9_]+(\.[a-z0-9_]+){2}$")
_LOAD_NAME = re.compile(r"^[a-z][a-z0-9_]*$")


@dataclass(frozen=True)
class Full:
    """Replace the target."""


@dataclass(frozen=True)
class Incremental:
    """Append rows newer than the last watermark.

    ``watermark`` is a target column; ``source_watermark`` the source column behind it,
    by default of the same name. ``on_repeat`` says what happens to a business key that is
    there already: ``"append"`` adds the row next to the old one, ``"skip"`` leaves the old
    one (for rows that never change), ``"latest"`` keeps the one with the highest
    watermark, which rewrites the table, or its touched buckets.
    """

    business_keys: Sequence[str]
    watermark: str
    source_watermark: str | None = None
    on_repeat: str = "append"
    overlap: str | None = None


@dataclass(frozen=True)
class Scd1:
    """Update changed rows in place, insert new ones. No tracked columns means all but the keys.

    A batch with repeated keys is refused, unless ``latest_by`` names the column whose
    highest value picks the row to take.
    """

    business_keys: Sequence[str]
    tracked: Sequence[str] = ()
    latest_by: str | None = None
    change_test: str = "hash"
    carry_untracked: bool = False


@dataclass(frozen=True)
class Scd2:
    """Keep every version of the tracked columns. Repeated keys are treated as in ``Scd1``."""

    business_keys: Sequence[str]
    tracked: Sequence[str]
    versions: Versions = Versions()
    latest_by: str | None = None
    carry_untracked: bool = False
    close_missing: bool = False


@dataclass(frozen=True)
class Changes:
    """Apply a feed of inserts, updates and deletes: per key the row with the highest
    ``sequence`` decides. ``op`` is mapped like any column, and not stored."""

    business_keys: Sequence[str]
    sequence: str
    op: str
    deletes: Sequence[str] = ("D",)


Strategy = Full | Incremental | Scd1 | Scd2 | Changes


@dataclass(frozen=True)
class LoadSpec:
    """One load. Checked on creation, so an operator never sees a contradictory one."""

    name: str
    source: str
    target: str
    strategy: Strategy
    mapping: Sequence[ColumnMap]
    audit: Audit = Audit()
    layer: str = "stg"
    file_format: str = "parquet"
    partition_by: Sequence[str] = ()
    sinks: Sequence[MartSink] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        if not _LOAD_NAME.match(self.name):
            raise ValueError(f"bad load name {self.name!r}")
        if not _SOURCE_REF.match(self.source):
            raise ValueError(f"source must be system.schema.table, not {self.source!r}")
        if self.layer not in LAYERS:
            raise ValueError(f"unknown layer {self.layer!r}")
        check_mapping(self.mapping)
        targets = {rule.target for rule in self.mapping}
        strategy = self.strategy
        if not isinstance(strategy, Full):
            self._known("business keys", strategy.business_keys, targets)
            if not strategy.business_keys:
                raise ValueError("this strategy needs business keys")
        if isinstance(strategy, Incremental):
            self._known("the watermark", [strategy.watermark], targets)
            if strategy.on_repeat not in ("append", "skip", "latest"):
                raise ValueError(f"unknown on_repeat {strategy.on_repeat!r}")
        if isinstance(strategy, Changes):
            self._known("sequence and op", [strategy.sequence, strategy.op], targets)
        if isinstance(strategy, (Scd1, Scd2)):
            self._known("tracked columns", strategy.tracked, targets)
            self._known("latest_by", [strategy.latest_by] if strategy.latest_by else [], targets)
        if isinstance(strategy, Scd2):
            if not strategy.tracked:
                raise ValueError("version history needs tracked columns")
            taken = sorted(targets & set(strategy.versions.columns()))
            if taken:
                raise ValueError(f"version columns must not be mapped: {taken}")

    def _known(self, what: str, names: Sequence[str], targets: set[str]) -> None:
        missing = [name for name in names if name not in targets]
        if missing:
            raise ValueError(f"{what} not among the mapped columns: {missing}")

    @property
    def source_system(self) -> str:
        return self.source.split(".", 1)[0]

    @property
    def source_table(self) -> str:
        return self.source.split(".", 1)[1]

    @property
    def primary_keys(self) -> list[str]:
        """Business keys where the strategy has them, else the columns marked ``pk``."""
        keys = getattr(self.strategy, "business_keys", ())
        return list(keys) or [rule.target for rule in self.mapping if rule.pk]


def load_spec(document: Mapping[str, Any]) -> LoadSpec:
    """A ``LoadSpec`` from a parsed entity document (metadata, source, target, load, mapping, ...)."""
    _only(document, "document", "apiVersion", "kind", "metadata", "source", "target", "load", "mapping", "audit",
          "schedule", "sinks")
    if document.get("kind", "Entity") != "Entity":
        raise ValueError(f"unsupported kind {document['kind']!r}")
    metadata, target, load = document["metadata"], document["target"], dict(document["load"])
    _only(metadata, "metadata", "name", "layer", "description", "owner", "tags")
    _only(document["source"], "source", "ref")
    _only(target, "target", "catalog", "schema", "table", "format", "location", "partition_by", "properties")
    audit = document.get("audit", {})
    _only(audit, "audit", "load_ts_column", "source_system_column", "record_hash_column", "surrogate_key_column")
    rules = []
    for rule in document["mapping"]:
        _only(rule, "mapping", *[f.name for f in fields(ColumnMap)])
        rules.append(ColumnMap(**rule))
    return LoadSpec(
        name=metadata["name"],
        layer=metadata["layer"],
        source=document["source"]["ref"],
        target=".".join([target.get("catalog", "warehouse"), target["schema"], target["table"]]),
        file_format=target.get("format", "iceberg"),
        partition_by=tuple(target.get("partition_by", ())),
        strategy=_strategy(load),
        mapping=tuple(rules),
        audit=Audit(
            load_ts=audit.get("load_ts_column", "load_ts"),
            source_system=audit.get("source_system_column", "source_system"),
            record_hash=audit.get("record_hash_column", "record_hash"),
            surrogate_key=audit.get("surrogate_key_column"),
        ),
        sinks=tuple(_sink(sink) for sink in document.get("sinks", ())),
    )


def load_connection(document: Mapping[str, Any]) -> tuple[str, Connection]:
    """Source system name and ``Connection`` from a parsed source document."""
    _only(document, "document", "apiVersion", "kind", "name", "description", "connection")
    _only(document["connection"], "connection", *[f.name for f in fields(Connection)])
    return document["name"], Connection(**document["connection"])


def _strategy(load: dict[str, Any]) -> Strategy:
    kind = load.pop("strategy")
    if kind == "full":
        _only(load, "load")
        return Full()
    keys = tuple(load.get("business_keys", ()))
    if kind == "incremental":
        _only(load, "load", "business_keys", "watermark_column")
        return Incremental(keys, load["watermark_column"])
    if kind == "scd1":
        _only(load, "load", "business_keys", "tracked_columns")
        return Scd1(keys, tuple(load.get("tracked_columns", ())))
    if kind == "scd2":
        _only(load, "load", "business_keys", "tracked_columns", "effective_from", "effective_to", "current_flag",
              "end_of_time")
        names = {"effective_from": "valid_from", "effective_to": "valid_to", "current_flag": "is_current",
                 "end_of_time": "end_of_time"}
        versions = Versions(**{ours: str(load[theirs]) for theirs, ours in names.items() if theirs in load})
        return Scd2(keys, tuple(load.get("tracked_columns", ())), versions)
    raise ValueError(f"unknown strategy {kind!r}")


def _sink(sink: Mapping[str, Any]) -> MartSink:
    _only(sink, "sink", *[f.name for f in fields(MartSink)])
    return MartSink(**sink)


def _only(values: Mapping[str, Any], where: str, *known: str) -> None:
    unknown = sorted(set(values) - set(known))
    if unknown:
        raise ValueError(f"unknown fields in {where}: {unknown}")
