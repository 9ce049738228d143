"""Bloom filters as tables of bitmaps, by Spark's bitmap functions.

A key is 128 bits of digest in two columns: the first names its block (one bitmap, one row), the
second the bits it sets there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: bits in one bitmap of Spark's bitmap functions.
BLOCK_BITS = 32_768
# Bits that a key sets in its block.
PROBES = 8


def blocks_for(keys: int, bits_per_key: int) -> int:
    """A power of two of blocks that gives each key at least so many bits."""
    return 1 << max(0, -(-keys * bits_per_key // BLOCK_BITS) - 1).bit_length()


def block_of(first: str, blocks: int) -> Column:
    """The block of a key whose digest begins with column ``first``."""
    return F.pmod(F.col(first), F.lit(blocks))


def _bit(second: str, i: int | str) -> str:
    return f"(({second} & 32767) + {i} * ((shiftright({second}, 15) & 32767) | 1)) % {BLOCK_BITS}"


def _bits(second: str) -> str:
    return f"transform(sequence(0, {PROBES - 1}), i -> {_bit(second, 'i')})"


def bitmaps(keys: DataFrame, first: str, second: str, blocks: int) -> DataFrame:
    """(``block``, ``bitmap``) of all keys.

    A key moves to its block's task as it is: bitmaps made before would be as many as tasks times blocks.
    """
    placed = keys.select(block_of(first, blocks).alias("block"), F.col(second).alias("_second")).repartition("block")
    bits = [f"_bit_{i}" for i in range(PROBES)]
    each = placed.select("block", *[F.expr(_bit("_second", i)).alias(b) for i, b in enumerate(bits)])
    made = each.groupBy("block").agg(F.array(*map(F.bitmap_construct_agg, bits)).alias("made"))
    return made.select("block", F.explode("made").alias("bitmap")).groupBy("block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def maybe_in(bitmap: str, second: str) -> Column:
    """Whether a bitmap has all bits of a key; true for every key that went in, and now and then for others."""
    byte = f"bigint(conv(hex(substring({bitmap}, int(p div 8) + 1, 1)), 16, 10))"
    return F.expr(f"forall({_bits(second)}, p -> getbit({byte}, int(p % 8)) = 1)")
