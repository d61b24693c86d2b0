"""A table of plain files that loads can replace, extend or merge into safely.

Spark cannot overwrite files that it is reading, and replacing a folder is not atomic. So
each load writes a new segment, and then one small manifest that lists the paths the table
is made of. Readers follow the newest manifest: a load that dies half-way leaves the table
as it was. Closed history is listed again, never rewritten. With key buckets, a merge also
reads and rewrites only those buckets that its batch has keys in.

Every segment has a name of its own, and a manifest is only written while the one that its load
began from is the newest: of two writers at once one fails, and neither undoes the other's load.

Layout: ``<root>/data/segment=<n>-<id>/[column=value/]part-*`` and ``<root>/manifest/<n>/``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.audit import instant
from tidemark.operators.scd2 import Versions
from tidemark.sinks.tables import balanced, observe, partitionable

SEGMENT = "segment"
BUCKET = "key_bucket"
_MANIFEST = (
    "number long, loads array<string>, load_ts string, watermark string, schema string, buckets string, "
    "paths array<string>, figures string"
)


class ConcurrentLoad(RuntimeError):
    """Another load was committed to the table since this one began; run this one again."""


@dataclass(frozen=True)
class Manifest:
    """One state of a table: its files, and the loads that went into it."""

    number: int
    loads: tuple[str, ...]
    load_ts: str | None
    watermark: str | None
    schema: StructType
    paths: tuple[str, ...]


class VersionedTable:
    """One table under ``root``. Of writers at the same time one succeeds; the others raise ``ConcurrentLoad``.

    ``partition_by`` suits tables that are replaced or appended to. ``bucket_by`` with a
    number of ``buckets`` suits tables that are merged into by these keys. History tables
    are always partitioned by their current flag, first.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        file_format: str = "parquet",
        partition_by: Sequence[str] = (),
        bucket_by: Sequence[str] = (),
        buckets: int = 0,
    ) -> None:
        if bool(bucket_by) != (buckets > 0):
            raise ValueError("bucket columns and a number of buckets go together")
        if bucket_by and partition_by:
            raise ValueError("a table is partitioned by values or by key buckets, not both")
        self.spark = spark
        self.root = root.rstrip("/")
        self.file_format = file_format
        self.partition_by = list(partition_by)
        self.bucket_by = list(bucket_by)
        self.buckets = buckets
        self._seen: dict = {}

    # reading

    def manifest(self) -> Manifest | None:
        """The newest manifest; None before the first load."""
        numbers = [int(name) for name in self._names("manifest") if name.isdigit()]
        for number in sorted(numbers, reverse=True):  # the newest one may be the remains of a commit that died
            found = self.spark.read.schema(_MANIFEST).json(f"{self.root}/manifest/{number}").first()
            if found is not None:
                if found["buckets"] != self._bucketing():
                    raise ValueError(f"the table was written with buckets {found['buckets']}, not {self._bucketing()}")
                schema = StructType.fromJson(json.loads(found["schema"]))
                return Manifest(
                    number, tuple(found["loads"]), found["load_ts"], found["watermark"], schema, tuple(found["paths"])
                )
        return None

    def has_load(self, load_id: str) -> bool:
        """Whether a load of this id was committed; lets a retried load do nothing."""
        manifest = self.manifest()
        return manifest is not None and load_id in manifest.loads

    def noted_load(self, load_id: str) -> tuple[dict, str | None, str | None] | None:
        """(figures, load time, watermark) of a load as its commit noted them; None if it is not there."""
        states = self.spark.read.schema(_MANIFEST).json(f"{self.root}/manifest/*")
        found = states.where((F.element_at("loads", -1) == load_id) & F.col("figures").isNotNull()).orderBy("number").first()
        return (json.loads(found["figures"]), found["load_ts"], found["watermark"]) if found else None

    def expired_paths(self) -> list[str]:
        """Paths that older states used and the newest one does not: safe to delete once no
        reader follows an older manifest."""
        newest = self.manifest()
        if newest is None:
            return []
        older = self.spark.read.schema(_MANIFEST).json(f"{self.root}/manifest/*")
        used = older.select(F.explode("paths").alias("path")).distinct().collect()  # paths, not data
        return sorted(f"{self.root}/data/{row.path}" for row in used if row.path not in newest.paths)

    def read(
        self, manifest: Manifest | None = None, part: str | None = None, buckets: Sequence[int] | None = None
    ) -> DataFrame:
        """The table, as one scan over its files.

        ``part`` (``column=value``) and ``buckets`` keep only the paths that have them.
        """
        manifest = manifest or self.manifest()
        if manifest is None:
            raise ValueError(f"no table at {self.root}")
        paths = [p for p in manifest.paths if part is None or part in p.split("/")]
        if buckets is not None:
            paths = [p for p in paths if _bucket_of(p) in buckets]
        if not paths:
            return self.spark.createDataFrame([], manifest.schema)
        base = f"{self.root}/data"
        reader = self.spark.read.format(self.file_format).schema(manifest.schema).option("basePath", base)
        return reader.load([f"{base}/{path}" for path in paths]).select(*manifest.schema.names)

    def current(
        self,
        versions: Versions = Versions(),
        manifest: Manifest | None = None,
        buckets: Sequence[int] | None = None,
    ) -> DataFrame:
        """Current rows of a history table: reads just their files."""
        manifest = manifest or self.manifest()
        self._only_history(manifest, versions)
        return self.read(manifest, f"{versions.is_current}=true", buckets)

    def _bucketing(self) -> str:
        return json.dumps([self.buckets, *self.bucket_by])

    @staticmethod
    def _only_history(manifest: Manifest | None, versions: Versions) -> None:
        flags = {f"{versions.is_current}=true", f"{versions.is_current}=false"}
        if manifest is not None and not all(flags & set(path.split("/")) for path in manifest.paths):
            raise ValueError("the table was not written as a history table")

    def bucket(self) -> Column:
        """The bucket of a row, by the same hash that Spark shuffles by."""
        return F.pmod(F.hash(*self.bucket_by), F.lit(self.buckets))

    def _tasks_hold_buckets(self) -> bool:
        """Whether the tasks of a merge hold whole buckets, or parts of one bucket each: so if
        one of the numbers of shuffle partitions and of buckets divides the other. Otherwise
        rows are brought together before writing, as each task would write to many buckets."""
        settings = self.spark.conf
        initial = settings.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        partitions = int(initial or settings.get("spark.sql.shuffle.partitions"))
        return partitions % self.buckets == 0 or self.buckets % partitions == 0

    def touched_buckets(self, batch: DataFrame, manifest: Manifest | None = None) -> list[int] | None:
        """Buckets that a batch has keys in; None for a table without buckets."""
        if not self.bucket_by:
            return None
        types = {name: batch.schema[name].dataType for name in self.bucket_by}
        if manifest is not None:  # equal keys of different types have different hashes
            types = {name: manifest.schema[name].dataType for name in self.bucket_by}
        keys = batch.select(*[F.col(name).cast(kind).alias(name) for name, kind in types.items()])
        found = keys.select(self.bucket().alias(BUCKET)).distinct().collect()  # at most ``buckets`` rows
        return sorted(row[BUCKET] for row in found)

    def _names(self, folder: str) -> list[str]:
        """Names of what lies in a folder of the table; none if it does not exist."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return [found.getPath().getName() for found in files.listStatus(path)] if files.exists(path) else []

    def _bucket_paths(self, folder: str) -> list[str]:
        """Buckets that were written; one whose rows all went away has no folder."""
        names = sorted(name for name in self._names(f"data/{folder}") if name.startswith(BUCKET + "="))
        return [f"{folder}/{name}" for name in names]

    # writing

    def replace(
        self,
        df: DataFrame,
        load_id: str,
        load_ts: str | None = None,
        watermark: str | None = None,
        hidden: Sequence[str] = (),
    ) -> dict:
        """Make ``df`` the whole table. Returns the figures observed while writing.

        ``hidden`` columns are there for the figures, and are not written.
        """
        self._no_buckets()
        old = self.manifest()
        folder, figures = self._write(df, old, self._figures(watermark), self.partition_by, hidden=hidden)
        loads = (*(old.loads if old else ()), load_id)
        schema = df.drop(*hidden).schema
        self._commit(old, loads, load_ts, figures.get("watermark"), schema, (folder,))
        return figures

    def append(
        self,
        df: DataFrame,
        load_id: str,
        load_ts: str | None = None,
        watermark: str | None = None,
        hidden: Sequence[str] = (),
    ) -> dict:
        """Add ``df`` to the table; a load id that is there already adds nothing.

        Columns that the table lacks are added to it, NULL in older rows. A column that ``df``
        lacks, or has with another type, is refused.
        """
        self._no_buckets()
        old = self.manifest()
        if old is None:
            return self.replace(df, load_id, load_ts, watermark, hidden)
        if load_id in old.loads:
            return {}
        if any("/" in path for path in old.paths):
            raise ValueError("a history table is merged into; it is not appended to")
        schema = self._widened(old.schema, df.drop(*hidden).schema)
        rows = df.select(*schema.names, *hidden)
        folder, figures = self._write(rows, old, self._figures(watermark), self.partition_by, hidden=hidden)
        paths = (*old.paths, folder) if figures["rows"] else old.paths
        high = figures.get("watermark") or old.watermark
        self._commit(old, (*old.loads, load_id), load_ts or old.load_ts, high, schema, paths)
        return figures

    @staticmethod
    def _widened(old: StructType, new: StructType) -> StructType:
        there = {field.name: field.dataType for field in new}
        wrong = [f.name for f in old if f.name not in there or there[f.name] != f.dataType]
        if wrong:
            raise ValueError(f"columns {wrong} of the table are missing, or have another type")
        return StructType([*old.fields, *[field for field in new if field.name not in old.names]])

    def _no_buckets(self) -> None:
        if self.bucket_by:
            raise ValueError("a table with key buckets is merged into; it is not replaced or appended to")

    def commit_rows(
        self,
        merged: DataFrame,
        load_id: str,
        load_ts: str,
        buckets: Sequence[int] | None = None,
        watermark: str | None = None,
        high: str | None = None,
    ) -> dict:
        """Take in the outcome of an in-place merge of the given buckets (all rows if there are none).

        ``watermark`` names the column whose highest value is kept as the table's; ``high`` is that
        value where the rows do not have it.
        """
        if not self.bucket_by and high is None:
            return self.replace(merged, load_id, load_ts, watermark)
        old = self.manifest()
        loads = (*(old.loads if old else ()), load_id)
        if not self.bucket_by:
            folder, figures = self._write(merged, old, self._figures(None), self.partition_by)
            self._commit(old, loads, load_ts, high, merged.schema, (folder,))
            return figures
        rows = merged.withColumn(BUCKET, self.bucket())
        shuffle = old is None or not self._tasks_hold_buckets()
        folder, figures = self._write(rows, old, self._figures(watermark), [BUCKET], shuffle)
        high = high or figures.get("watermark") or (old.watermark if old else None)
        kept = [p for p in old.paths if _bucket_of(p) not in (buckets or ())] if old else []
        new = self._bucket_paths(folder)
        self._commit(old, loads, load_ts, high, merged.schema, tuple(kept + new))
        return figures

    def commit_versions(
        self,
        delta: DataFrame,
        load_id: str,
        load_ts: str,
        versions: Versions = Versions(),
        buckets: Sequence[int] | None = None,
    ) -> dict:
        """Take in the outcome of a history merge (``scd2_delta``) of the given buckets.

        Rows are written by current flag. The open ones become the current rows of their
        buckets; the closed ones are added to the history, whose older files stay as they
        are. Returns counts of rows written, current, closed and opened.
        """
        flag = versions.is_current
        old = self.manifest()
        self._only_history(old, versions)
        figures = {
            **self._figures(None),
            "current": F.count_if(F.col(flag)),
            "closed": F.count_if(~F.col(flag)),
            "opened": F.count_if(F.col(flag) & (F.col(versions.valid_from) == instant(load_ts))),
        }
        rows, values = delta, [name for name in self.partition_by if name != flag]
        if self.bucket_by:
            rows, values = delta.withColumn(BUCKET, self.bucket()), [BUCKET]
        shuffle = bool(values) and (old is None or not self.bucket_by or not self._tasks_hold_buckets())
        folder, found = self._write(rows, old, figures, [flag, *values], shuffle=shuffle)
        history, current = f"{folder}/{flag}=false", f"{folder}/{flag}=true"
        paths = list(old.paths) if old else []
        if self.bucket_by:
            replaced = set(buckets or ())
            paths = [p for p in paths if f"{flag}=false" in p.split("/") or _bucket_of(p) not in replaced]
            paths += self._bucket_paths(current)
        else:
            paths = [p for p in paths if f"{flag}=false" in p.split("/")]
            paths += [current] if found["current"] else []
        paths += [history] if found["closed"] else []
        loads = (*(old.loads if old else ()), load_id)
        self._commit(old, loads, load_ts, None, delta.schema, tuple(paths))
        return found

    @staticmethod
    def _figures(watermark: str | None) -> dict[str, Column]:
        figures = {"rows": F.count(F.lit(1))}
        if watermark:
            figures["watermark"] = F.max(watermark).cast("string")
        return figures

    def _write(
        self,
        df: DataFrame,
        old: Manifest | None,
        figures: dict[str, Column],
        partition_by: Sequence[str],
        shuffle: bool | None = None,
        hidden: Sequence[str] = (),
    ) -> tuple[str, dict]:
        """Write a new segment; its folder and figures. Rows are brought together by partition
        unless the tasks of a merge hold few partitions each anyway."""
        folder = f"{SEGMENT}={(old.number if old else 0) + 1}-{uuid.uuid4().hex}"
        by_value = partition_by == self.partition_by if shuffle is None else shuffle
        seen = Observation()
        dealt = balanced(df, partition_by) if by_value else partitionable(df, partition_by)
        rows = observe(dealt, seen, figures).drop(*hidden)
        writer = rows.write.format(self.file_format).mode("error")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(f"{self.root}/data/{folder}")
        self._seen = seen.get
        return folder, self._seen

    def _commit(
        self,
        old: Manifest | None,
        loads: Sequence[str],
        load_ts: str | None,
        watermark: str | None,
        schema: StructType,
        paths: Sequence[str],
    ) -> None:
        newest = self.manifest()
        if (newest.number if newest else None) != (old.number if old else None):
            raise ConcurrentLoad(f"{self.root} changed since this load began")
        # Past the remains of commits that died; two writers that got here choose the same number,
        # and the second one finds the folder there.
        number = max([0, *(int(name) for name in self._names("manifest") if name.isdigit())]) + 1
        row = (number, list(loads), load_ts, watermark, schema.json(), self._bucketing(), list(paths), json.dumps(self._seen, default=str))
        one = self.spark.createDataFrame([row], _MANIFEST).coalesce(1)
        try:
            one.write.mode("error").json(f"{self.root}/manifest/{number}")
        except AnalysisException as error:
            raise ConcurrentLoad(f"{self.root} changed since this load began") from error


def _bucket_of(path: str) -> int | None:
    for step in path.split("/"):
        if step.startswith(BUCKET + "="):
            return int(step.split("=")[1])
    return None
