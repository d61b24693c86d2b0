"""The shared folder for tables that a plan writes on its way."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session, where driver and executors share a disk, may do without.
    """
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path of its own under the shared folder."""
    return f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back.

    For rows that several steps need: the source is read once, all steps see the same
    rows, a lost executor costs no second extract, and the size is known from the files.
    """
    return _written(df, scratch_path(df.sparkSession, name))


@contextmanager
def staging(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like ``staged``, for use within a load: the files are removed at its end."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        yield _written(df, path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
