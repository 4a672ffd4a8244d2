"""Sieves: Bloom filters as tables, which Spark builds, joins, stores and extends like any other.

A key falls into one block of 32,768 bits and sets some bits there, so a sieve is a table of ``block`` and ``bits``, and testing a key is
one equi-join by block. Two sieves of as many blocks are joined by OR, which is how each batch extends the stored one. A key that was put
in always passes; another one passes by chance, one in some hundred while a sieve holds no more keys than it was made for.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the bits of a bitmap that Spark's bitmap functions build.
BLOCK_BITS = 32_768
BITS_PER_KEY = 12
HASHES = 6
# A sieve up to this size is sent to all tasks.
BROADCAST_BLOCKS = 16_384


def blocks_for(keys: int) -> int:
    """How many blocks keep chance passes rare for that many keys; room for twice as many is left."""
    return max(1, math.ceil(2 * keys * BITS_PER_KEY / BLOCK_BITS))


def _block(key: Column, blocks: Column | int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks) if isinstance(blocks, int) else blocks)


def _positions(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(BLOCK_BITS)) for k in range(HASHES)]


def sieve(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """``block``, ``blocks`` (of the whole sieve) and ``bits`` over the filled values of ``column``; bits are gathered before the shuffle."""
    key = F.col(column)
    bits = keys.filter(key.isNotNull()).select(_block(key, blocks).alias("block"), F.explode(F.array(*_positions(key))).alias("position"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("position").alias("bits")).select("block", F.lit(blocks).alias("blocks"), "bits")


def united(*sieves: DataFrame) -> DataFrame:
    """One sieve for the keys of all; they must have the same number of blocks."""
    every = reduce(DataFrame.unionByName, sieves)
    return every.groupBy("block", "blocks").agg(F.bitmap_or_agg("bits").alias("bits")).select("block", "blocks", "bits")


def n_blocks(of: DataFrame) -> int | None:
    """The number of blocks that a sieve was made with; None if no key was ever put in."""
    row = of.agg(F.min("blocks").alias("least"), F.max("blocks").alias("most")).first()
    if row["least"] != row["most"]:
        raise ValueError("sieves of different sizes cannot be united")
    return row["most"]


def fill(of: DataFrame) -> float:
    """The share of bits that are set; from a half on a sieve should be built anew with more blocks."""
    row = of.agg(F.sum(F.bitmap_count("bits")).alias("n"), F.max("blocks").alias("blocks")).first()
    return (row["n"] or 0) / (BLOCK_BITS * (row["blocks"] or 1))


def with_keys(of: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The sieve with the keys of another table put in."""
    return united(of, sieve(keys, column, n_blocks(of) or 1))


def sifted(df: DataFrame, column: str, of: DataFrame, broadcast_bytes: int | None = None) -> DataFrame:
    """Rows whose key may have been put in, and rows without a key.

    A sieve of up to 64 MB is broadcast; a larger one is joined by block, over which keys are spread by hash, and the hot keys' rows by the skew join.
    """
    blocks = n_blocks(of) or 1
    key = F.col(column)
    small = blocks <= (BROADCAST_BLOCKS if broadcast_bytes is None else broadcast_bytes * 8 // BLOCK_BITS)
    bits = of.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    marked = df.withColumn("_of", _block(key, blocks))
    joined = marked.join(F.broadcast(bits) if small else bits, F.col("_of") == F.col("_block"), "left")

    def holds(position: Column) -> Column:
        byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (position % 8).cast("int")) == 1

    passes = reduce(and_, [holds(p) for p in _positions(key)])
    return joined.filter(key.isNull() | F.coalesce(passes, F.lit(False))).select(*df.columns)
