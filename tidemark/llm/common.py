"""What the operators of this subpackage share: cuts of lineage, components, Arrow batches of texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session without one gets its own, as in tests."""
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None)
    if not folder and not context.getCheckpointDir() and not context.master.startswith("local["):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="shared-"))
    return (folder or context.getCheckpointDir()).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows from here on come from a reliable checkpoint, for small frames that several steps read."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written once as Parquet under the shared folder and read back.

    The shuffle files behind them are removed then, as nothing will read them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the undirected edges (u, v): nodes have the same root when a path joins them.

    Each round sends every node to its smallest neighbour and replaces the edges by those between
    the nodes sent to, so at least half the nodes of a component go; rounds grow with the logarithm
    of the component. Nothing is gathered: a node with very many edges is one partly aggregated
    minimum, and the joins have one row per node on one side, so adaptive execution splits the other.
    """
    rounds = []
    links = cut(edges.select("u", "v").where("u <> v").distinct())
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = cut(both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("root")))
        rounds.append(step)
        there = step.select(F.col("u").alias("v"), F.col("root").alias("v_root"))
        moved = links.join(step, "u").join(there, "v").select(
            F.least("root", "v_root").alias("u"), F.greatest("root", "v_root").alias("v")
        )
        links = cut(moved.where("u <> v").distinct())
    if not rounds:
        return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = rounds[0].select(F.col("u").alias("node"), "root")
    for step in rounds[1:]:
        later = step.select(F.col("u").alias("root"), F.col("root").alias("next"))
        found = found.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def whole_partition(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """The columns of a partition's rows, for partitions whose size the shuffle before bounds."""
    table = list(batches)
    if not table:
        return []
    return [
        np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in table])
        for i in range(table[0].num_columns)
    ]


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values spread over all bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
