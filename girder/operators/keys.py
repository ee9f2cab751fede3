"""Lookups of keys that come as a table of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import first_matches

#: Bits of the filter for each key, and bits that a key sets in its word.
BITS, SET = 16, 4
#: Words of 64 bits that a filter has at most: it is broadcast, as 16 MB of hashes and bits.
WORDS = 1 << 20
#: With fewer bits for a key than this a filter of WORDS lets nearly all rows pass, and isn't made.
LEAST_BITS = 4


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words).cast("long"))


def _bits(key: Column) -> Column:
    """A word with the bits that a key sets."""
    spread = F.xxhash64(key, F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(spread, 6 * i).bitwiseAND(63).cast("int")) for i in range(SET)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def flagged(rows: DataFrame, key: Column, keys: DataFrame, other: Column) -> DataFrame:
    """rows with __maybe: false only where the key is surely not among keys.

    A Bloom filter is made of the keys, each in one word of 64 bits, as a table of at most WORDS words. That table is
    broadcast, so its size is bounded whatever the number of keys; the keys never are.
    """
    n = keys.count()
    words = max(1, min(WORDS, -(-n * BITS // 64)))
    if n * LEAST_BITS > words * 64:
        return rows.withColumn("__maybe", F.lit(True))
    table = keys.where(other.isNotNull()).groupBy(_word(other, words).alias("__word")).agg(F.bit_or(_bits(other)).alias("__bits"))
    met = rows.join(F.broadcast(table), _word(key, words) == F.col("__word"), "left")
    return met.withColumn("__maybe", F.coalesce(F.col("__bits").bitwiseAND(_bits(key)) == _bits(key), F.lit(False))).drop("__word", "__bits")


def prefiltered(rows: DataFrame, key: Column, keys: DataFrame, other: Column) -> DataFrame:
    """The rows whose key may be among keys, before anything is shuffled."""
    return flagged(rows, key, keys, other).where("__maybe").drop("__maybe")


def first_of_each(requests: DataFrame, key: Column, rows: DataFrame, row_key: Column, order: Column) -> DataFrame:
    """__key and the columns of the least row in order, for each key of requests that some row has.

    key: what requests are compared as. Rows pass the filter in the scan, the rest are reduced to
    one for each key in each task before they are shuffled, so neither a key of very many rows nor one that is asked for
    very often makes a task larger than others.
    """
    asked = requests.select(key.alias("__asked")).where("__asked IS NOT NULL")
    possible = first_matches(prefiltered(rows, row_key, asked, F.col("__asked")), row_key, order)
    return possible.join(asked.distinct(), F.col("__key") == F.col("__asked"), "left_semi")


def answered(requests: DataFrame, key: Column, hits: DataFrame) -> DataFrame:
    """Every request, in as many rows as it has, with its hit or nulls."""
    return requests.join(hits, key == F.col("__key"), "left").drop("__key")
