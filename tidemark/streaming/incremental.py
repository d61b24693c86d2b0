"""Streaming form of the incremental load: append each key once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.operators.incremental import unloaded_rows
from tidemark.plans.keyed_log import KeyedLog
from tidemark.plans.versioned import VersionedTable
from tidemark.plans.workspace import staging


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint; batch numbers start anew with each."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def started(writer: DataStreamWriter, every: str | None) -> StreamingQuery:
    """Start a stream: work off what has arrived and stop, or go on ``every`` interval."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stream_incremental(
    stream: DataFrame, keys: Sequence[str], ts: str, delay: str, splits: int = 64
) -> DataFrame:
    """The stream with repeated keys removed, as long as copies are at most ``delay`` apart.

    State is kept per key until the watermark passes, so it does not grow with the table.
    Spark drops rows that arrive more than ``delay`` behind the newest; where none may be
    lost, use ``stream_append``, which looks keys up in the table itself. Copies are first removed among rows that came in through the same input split, then
    among the rest: many copies of one key spread over ``splits`` state entries instead of
    all going to one task. ``splits=1`` does it in one step.
    """
    # The watermark needs a TIMESTAMP; the row's own time is not changed by it.
    rows = stream.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", delay)
    if splits > 1:
        rows = rows.withColumn("_split", F.pmod(F.spark_partition_id(), F.lit(splits)))
        rows = rows.dropDuplicatesWithinWatermark([*keys, "_split"]).drop("_split")
    return rows.dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")


def stream_append(
    stream: DataFrame,
    table: VersionedTable,
    checkpoint: str,
    keys: Sequence[str],
    order: str,
    every: str | None = None,
) -> StreamingQuery:
    """Append rows of new keys to a table, micro-batch by micro-batch.

    However late a copy comes, it finds its key in the table. The stream's id and the batch
    number are the load id, so a batch that Spark runs again after a failure is appended once.
    """

    def add(batch: DataFrame, number: int) -> None:
        manifest, load_id = table.manifest(), f"{stream_id(batch.sparkSession, checkpoint)}-batch-{number}"
        if manifest is not None and load_id in manifest.loads:
            return
        with staging(batch, "arrived") as rows:
            target = rows.limit(0) if manifest is None else table.read(manifest)
            table.append(unloaded_rows(target, rows, keys, order), load_id)

    return started(stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint), every)


def stream_keyed_append(stream: DataFrame, log: KeyedLog, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append rows of new keys to a keyed log, micro-batch by micro-batch.

    However late a copy comes, the summaries lead to the load that has its key. The stream's id and the batch
    number are the load id, so a batch that Spark runs again is appended once.
    """
    def add(batch: DataFrame, number: int) -> None:
        log.append(batch, f"{stream_id(batch.sparkSession, checkpoint)}-batch-{number}")

    return started(stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint), every)


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Append what arrives. The checkpoint remembers where it got to."""
    writer = stream.writeStream.format(file_format).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return started(writer.option("path", path), every)
