"""A filter of fixed size that tells which rows of a large table may have a partner in a smaller one, before anything is shuffled.

The keys of the smaller side set bits of one row that all tasks get (at most 16 MB, whatever the data; 2 MB up to 260,000 keys). Rows whose
bit isn't set have no partner. The join itself stays exact: where the keys are so many that most bits are set, it only gets more rows to do.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter, at least and at most, and bits a key.
LEAST, MOST, EACH = 1 << 24, 1 << 27, 64


def bits_for(keys: int) -> int:
    return min(MOST, max(LEAST, 1 << max(0, keys * EACH - 1).bit_length()))


def key_bits(keys: DataFrame, hashed: Column, n_keys: int) -> DataFrame:
    """One row ``bits`` (an array of 64-bit words) with a bit for the hash of each key."""
    size = bits_for(n_keys)
    at = F.pmod(hashed, F.lit(size))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_at").bitwiseAND(63).cast("int"))
    words = keys.select(at.alias("_at")).select(F.expr("shiftright(_at, 6)").alias("id"), bit.alias("b"))
    # An empty word for each place makes the row full without a join.
    none = keys.sparkSession.range(size // 64).select("id", F.lit(0).cast("long").alias("b"))
    every = words.unionByName(none).groupBy("id").agg(F.bit_or("b").alias("b")).select(F.struct("id", "b").alias("w"))
    return every.agg(F.transform(F.sort_array(F.collect_list("w")), lambda w: w["b"]).alias("bits"))


def may_match(rows: DataFrame, hashed: Column, bits: DataFrame, n_keys: int) -> DataFrame:
    """The rows whose key may be among the keys of ``bits``."""
    at = F.pmod(hashed, F.lit(bits_for(n_keys)))
    word = F.get(F.col("_bits"), F.call_function("shiftright", at, F.lit(6)).cast("int"))
    sent = rows.crossJoin(F.broadcast(bits.withColumnRenamed("bits", "_bits")))  # one row of fixed size
    return sent.where(F.call_function("shiftright", word, at.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1).drop("_bits")


class Bits:
    """The same filter for workers' Python: whether a string may be among the keys, hashed as ``xxhash64`` does."""

    def __init__(self, bits: DataFrame):
        self.words = np.array(bits.first()["bits"], np.int64)
        self.size = len(self.words) * 64

    def __contains__(self, text: str) -> bool:
        h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
        at = (h - (1 << 64) if h >> 63 else h) % self.size
        return bool((int(self.words[at >> 6]) >> (at & 63)) & 1)
