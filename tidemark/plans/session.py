"""Session settings for large loads."""

from __future__ import annotations

MEGABYTE = 1024 * 1024
TASK_MEGABYTES = 256


def shuffle_partitions(shuffled_gigabytes: float, task_megabytes: int = TASK_MEGABYTES) -> int:
    """Partitions that keep a task's share of the largest shuffle near ``task_megabytes``."""
    return max(8, -(-int(shuffled_gigabytes * 1024) // task_megabytes))


def cluster_settings(shuffled_gigabytes: float, task_megabytes: int = TASK_MEGABYTES) -> dict[str, str]:
    """Settings to build a session with; the caller adds ``spark.checkpoint.dir``.

    Starts from many small partitions and lets adaptive execution join them up to
    ``task_megabytes``, split skewed ones, and broadcast what turns out small.
    """
    task_bytes = str(task_megabytes * MEGABYTE)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": task_bytes,
        "spark.sql.shuffle.partitions": str(shuffle_partitions(shuffled_gigabytes, task_megabytes)),
        "spark.sql.files.maxPartitionBytes": task_bytes,
        # A merge writes current and closed rows from each task: two open files, no sort.
        "spark.sql.maxConcurrentOutputFileWriters": "4",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        # State of streaming loads on disk instead of executor heap.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        # Blocks of executors that are taken away move to others instead of being recomputed.
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
    }
