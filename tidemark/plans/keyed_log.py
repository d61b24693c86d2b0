"""An insert-only table whose loads find out by key summaries which earlier loads to look at."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.incremental import unloaded_rows
from tidemark.operators.key_summary import BITS_PER_KEY, possible_parts, summarise_keys, words_for
from tidemark.plans.workspace import staging

LOAD = "load"
SUMMARY = "words long, word long, bits long, load string"
NOTED = "rows long, words long, load string"


class KeyedLog:
    """A folder with the rows of each load, a summary of each load's keys, and a note of each that is whole.

    All three are tables that Spark partitions by load. The note is written last and is one row, so
    readers see a load wholly or not at all; what a load that died has left is overwritten when it is done again.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: str, bits_per_key: int = BITS_PER_KEY):
        self.spark, self.path, self.keys, self.order, self.bits_per_key = spark, path.rstrip("/"), list(keys), order, bits_per_key

    def _of(self, table: str, load_id: str) -> str:
        return f"{self.path}/{table}/{LOAD}={load_id}"

    def notes(self) -> DataFrame:
        """(rows, words, load) of the loads that are whole."""
        try:
            return self.spark.read.schema(NOTED).parquet(f"{self.path}/notes")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], NOTED)

    def read(self, loads: Sequence[str] | None = None) -> DataFrame | None:
        """The rows of the table, or of some loads, with the load of each; None while there are none."""
        loads = [r[LOAD] for r in self.notes().select(LOAD).collect()] if loads is None else loads  # one row a load
        if not loads:
            return None
        paths = [self._of("rows", x) for x in loads]
        schema = self.spark.read.parquet(paths[0]).schema
        return self.spark.read.schema(StructType(schema.fields).add(LOAD, "string")).option("basePath", f"{self.path}/rows").parquet(*paths)

    def loads_to_look_at(self, batch: DataFrame) -> list[str]:
        """The loads whose summary has a key of the batch."""
        notes = self.notes().select("words", LOAD).collect()  # one row a load
        if not notes:
            return []
        paths = [self._of("keys", r[LOAD]) for r in notes]
        summaries = self.spark.read.schema(SUMMARY).option("basePath", f"{self.path}/keys").parquet(*paths)
        found = possible_parts(summaries, [r["words"] for r in notes], batch, self.keys, [LOAD])
        return sorted(r[LOAD] for r in found.select(LOAD).distinct().collect())  # one row a load at most

    def append(self, batch: DataFrame, load_id: str) -> dict:
        """Adds the rows whose key the table lacks, the latest of each; rows without a key are all added.

        Only loads whose summary has a key of the batch are read, and of them only the keys. A load id that
        is whole already is skipped.
        """
        if "/" in load_id or not load_id:
            raise ValueError("a load id names a folder")
        if not self.notes().where(F.col(LOAD) == load_id).isEmpty():
            return {}
        with staging(batch, "arrived") as rows:
            looked_at = self.loads_to_look_at(rows)
            earlier = self.read(looked_at)
            target = rows.limit(0) if earlier is None else earlier.drop(LOAD)
            fresh = unloaded_rows(target, rows, self.keys, self.order)
            fresh.write.mode("overwrite").parquet(self._of("rows", load_id))
            written = self.spark.read.schema(rows.schema).parquet(self._of("rows", load_id))
            count = written.count()
            words = words_for(count, self.bits_per_key)
            summary = summarise_keys(written, self.keys, words)
            # by word, so that a small batch skips most of the file by its statistics
            summary.repartitionByRange(max(1, words >> 20), "word").sortWithinPartitions("word").write.mode("overwrite").parquet(self._of("keys", load_id))
        note = self.spark.range(1).select(F.lit(count).cast("long").alias("rows"), F.lit(words).cast("long").alias("words"))
        note.coalesce(1).write.mode("overwrite").parquet(self._of("notes", load_id))
        return {"rows": count, "looked_at": looked_at}
