"""Small summaries of the keys that a part of a table holds, tested before any key is read.

A summary is a Bloom filter of 64-bit words, as rows (word, bits): each key sets ``BITS`` bits of one word.
It is made by one aggregation with bitwise OR, which Spark does before the shuffle as well, so a key that fills
the table costs one row for each task. Summaries have a power of two of words; of two the larger can be folded to
the size of the smaller, and then they are merged by OR. A key that a summary lacks is not there; one that it has
may not be, about once in a thousand keys at 16 bits a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.common import has_null

BITS = 5
BITS_PER_KEY = 16
WORD, MASK, FOUND = "word", "bits", "words"


def words_for(keys: int, bits_per_key: int = BITS_PER_KEY) -> int:
    """Words of a summary of so many keys: a power of two."""
    return 1 << (max(1, -(-keys * bits_per_key // 64)) - 1).bit_length()


def word_of(keys: Sequence[str], words: int | Column) -> Column:
    """The word of a key; that of a summary with half the words is the same less its highest bit."""
    size = F.lit(words).cast("long") if isinstance(words, int) else words.cast("long")
    return F.xxhash64(*keys).bitwiseAND(size - 1)


def mask_of(keys: Sequence[str]) -> Column:
    """The bits that a key sets in its word."""
    hashed = F.xxhash64(F.lit(17), *keys)
    places = [F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def summarise_keys(df: DataFrame, keys: Sequence[str], words: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, words, word, bits) of the keys of each part; NULL keys, which match nothing, are left out."""
    named = df.where(~has_null(keys)).select(*by, word_of(keys, words).alias(WORD), mask_of(keys).alias(MASK))
    return named.groupBy(*by, WORD).agg(F.bit_or(MASK).alias(MASK)).select(*by, F.lit(words).cast("long").alias(FOUND), WORD, MASK)


def merge_summaries(summaries: DataFrame, words: int, by: Sequence[str] = ()) -> DataFrame:
    """One summary (of each ``by``) of ``words`` words, no more than any of them has, that holds what each of them holds."""
    folded = summaries.select(*by, F.col(WORD).bitwiseAND(F.lit(words - 1).cast("long")).alias(WORD), MASK)
    return folded.groupBy(*by, WORD).agg(F.bit_or(MASK).alias(MASK)).select(*by, F.lit(words).cast("long").alias(FOUND), WORD, MASK)


def possible_parts(summaries: DataFrame, sizes: Sequence[int], batch: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by, keys): in which parts each key of a batch may be. ``sizes`` are the numbers of words that occur.

    A key looks up one word for each size, so only words that the batch's keys hash to are compared.
    """
    wanted = batch.where(~has_null(keys)).select(*keys).distinct()
    each = wanted.select(*keys, mask_of(keys).alias("_mask"), F.explode(F.array(*[F.lit(s).cast("long") for s in sorted(set(sizes))])).alias("_words"))
    each = each.withColumn("_word", word_of(keys, F.col("_words")))
    marks = summaries.select(*by, FOUND, WORD, MASK)
    same = (F.col(FOUND) == F.col("_words")) & (F.col(WORD) == F.col("_word"))
    return each.join(marks, same & (F.col(MASK).bitwiseAND(F.col("_mask")) == F.col("_mask"))).select(*by, *keys)
