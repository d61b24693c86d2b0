"""A corpus made ready for training: five stages, each a function of (spark, docs, sf_dir).

Toxic documents go, one document of each near-duplicate group stays, documents that hold benchmark items
go, secrets are masked in what is left, and the last stage gives the token ids. ``run`` writes each stage's
rows and the next one reads them. Trained models, fingerprints and tokenizers are beyond SQL,
so ``ORACLE_SQL`` is None; ``tests/llm`` has a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import encode
from tidemark.llm.common import staged
from tidemark.llm.decontaminate import decontaminated
from tidemark.llm.secrets import redacted
from tidemark.llm.simhash import one_of_each_group
from tidemark.llm.toxicity import train, without_toxic


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, trained on the labelled ones, does not call toxic."""
    return without_toxic(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id."""
    return one_of_each_group(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets and linked parts of credentials replaced by a mark; n_chars is that of the new text."""
    return redacted(docs).withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of all documents."""
    ids = encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("bpe", tokenise),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
