"""Joins with derived key sets.

A key set (duplicated keys, orphan keys) is written to the shared folder first. Its size is then
known from its files, and Catalyst broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold``
of real bytes; beyond that the join shuffles and AQE splits skewed partitions. A written set is
computed once, survives lost executors and is shared by all plans that use it.

Where the join would shuffle many rows for few that match, ``Marks`` tell which rows need not go there.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehold.sources.scratch import materialise


def key_set(df: DataFrame) -> DataFrame:
    return materialise(df, "keys")


def join_keyset(big: DataFrame, keys: DataFrame, cond, how: str = "left") -> DataFrame:
    """Join ``big`` with a key set; ``cond(big, keys)`` gives the join condition."""
    return big.join(keys, cond(big, keys), how)


# a bitmap has 8 to 16 bits a key, in blocks of 1024 words; never more than 32 MB, beyond that it tells less but nothing wrong
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28


@dataclass(frozen=True)
class Marks:
    """A bitmap over hashes of a key set, small enough to broadcast. A key has two bits in one block; where
    one of them is not set, it is not in the set; else it may be."""
    blocks: DataFrame   # _block, _words
    bits: int

    @staticmethod
    def over(keys: DataFrame, column: str) -> Marks:
        """``keys`` has to be written; it is read twice."""
        spark = keys.sparkSession
        bits = min(max(1 << (8 * keys.count()).bit_length(), LEAST_BITS), MOST_BITS)
        block, one, two = _place(F.xxhash64(column), bits)
        both = keys.select(block.alias("_block"), (one + F.shiftleft(two, 16)).alias("_bits"))
        # every word of every block, as a negative number
        words = spark.range(bits // 64).select(F.shiftright("id", 10).alias("_block"), (-1 - F.col("id") % 1024).alias("_bits"))
        dealt = both.unionByName(words).repartition("_block")
        set_bits = F.expr("""explode(CASE WHEN _bits < 0 THEN array(named_struct('word', -1 - _bits, 'ones', 0L))
            ELSE transform(array(_bits & 65535, shiftright(_bits, 16)), x -> named_struct('word', shiftright(x, 6), 'ones', shiftleft(1L, int(x & 63)))) END)""")
        ones = dealt.select("_block", set_bits.alias("_set")).groupBy("_block", F.col("_set.word").alias("_word")).agg(F.bit_or("_set.ones").alias("_ones"))
        blocks = ones.groupBy("_block").agg(F.sort_array(F.collect_list(F.struct("_word", "_ones"))).alias("_words"))
        return Marks(key_set(blocks.select("_block", F.col("_words._ones").alias("_words"))), bits)

    def on(self, df: DataFrame, key: str, flag: str = "_may") -> DataFrame:
        """``df`` with ``flag``: whether its key may be in the set; false for null."""
        block, *places = _place(F.xxhash64(df[key]), self.bits)
        held = df.join(F.broadcast(self.blocks), block == F.col("_block"), "left")
        one, two = (F.bit_get(F.element_at("_words", (F.shiftright(x, 6) + 1).cast("int")), x.bitwiseAND(F.lit(63)).cast("int")) == 1 for x in places)
        return held.select(*df.columns, (df[key].isNotNull() & F.coalesce(one & two, F.lit(False))).alias(flag))


def _place(hashed: Column, bits: int) -> tuple[Column, Column, Column]:
    """The block of a hash and the two bits that it has there, from different parts of it."""
    part = lambda shift, mask: F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit(mask).cast("long"))
    return part(16, bits // 65536 - 1), part(0, 65535), part(48, 65535)
