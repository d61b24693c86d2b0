"""The driver's queries over the operators of this subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.alignment import alignment_digests
from tidemark.llm.bpe import round_trip_digests
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.language import identify
from tidemark.llm.pieces import round_trip_digests as piece_digests
from tidemark.llm.pii import personal_data_query
from tidemark.llm.prefixes import TRIE_SQL, prefix_trie
from tidemark.llm.secrets import secrets_query
from tidemark.llm.simhash import simhash_query
from tidemark.llm.suffixes import suffix_query
from tidemark.llm.topk import TOP_K_SQL, top_k
from tidemark.llm.toxicity import severity, train
from tidemark.llm.warc import WARC_SQL, warc_query


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return personal_data_query(documents(spark, sf_dir))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    return secrets_query(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs = documents(spark, sf_dir)
    return severity(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    return identify(documents(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in the documents."""
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_query(documents(spark, sf_dir))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return round_trip_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the strings of 100 bytes that start earlier."""
    return suffix_query(documents(spark, sf_dir))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    return warc_query(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces and decoded text of every document, as digests."""
    return piece_digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document, with corpus-wide counts."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment_digests(documents(spark, sf_dir), *paths)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


REGISTERED: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_pii": (op1_pii, None),
    "op2_secrets": (op2_secrets, None),
    "op3_toxicity": (op3_toxicity, None),
    "op4_language": (op4_language, None),
    "op5_decontaminate": (op5_decontaminate, None),
    "op6_topk": (op6_topk, TOP_K_SQL),
    "op7_simhash": (op7_simhash, None),
    "op8_bpe": (op8_bpe, None),
    "op9_suffix": (op9_suffix, None),
    "op10_warc": (op10_warc, WARC_SQL),
    "op11_sentencepiece": (op11_sentencepiece, None),
    "op12_alignment": (op12_alignment, None),
    "op13_trie": (op13_trie, TRIE_SQL),
}
