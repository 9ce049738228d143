"""Bitmaps of keys: each key's bits are set, and a key moves once."""

import re

from pyspark.sql import functions as F

from stratafold.operators.bloom import BLOCK_BITS, PROBES, bitmaps, block_of, maybe_in

BLOCKS = 8


def keys_of(spark, low, high):
    return spark.range(low, high, 1, 6).select(F.xxhash64("id").alias("d0"), F.xxhash64(F.lit(1), "id").alias("d1"))


def plain_bits(d1):
    first, step = d1 & 32767, ((d1 >> 15) & 32767) | 1
    return {(first + i * step) % BLOCK_BITS for i in range(PROBES)}


def test_bitmaps_hold_the_bits_of_their_keys_and_no_others(spark):
    keys = keys_of(spark, 0, 500)
    want = {}
    for r in keys.select(block_of("d0", BLOCKS).alias("block"), "d1").collect():
        want.setdefault(r.block, set()).update(plain_bits(r.d1))
    got = {r.block: {i for i in range(BLOCK_BITS) if r.bitmap[i // 8] >> (i % 8) & 1} for r in bitmaps(keys.unionByName(keys), "d0", "d1", BLOCKS).collect()}
    assert got == want
    assert bitmaps(keys.limit(0), "d0", "d1", BLOCKS).collect() == []


def test_keys_that_went_in_may_be_in(spark):
    filters = bitmaps(keys_of(spark, 0, 3000), "d0", "d1", BLOCKS)
    placed = lambda keys: keys.withColumn("block", block_of("d0", BLOCKS)).join(filters, "block").filter(maybe_in("bitmap", "d1")).count()
    assert placed(keys_of(spark, 0, 3000)) == 3000
    assert placed(keys_of(spark, 10_000, 11_000)) < 20


def test_keys_are_shuffled_not_bitmaps_of_each_task(spark):
    plan = bitmaps(keys_of(spark, 0, 500), "d0", "d1", BLOCKS)._jdf.queryExecution().executedPlan().toString()
    shuffled = plan[plan.index("Exchange hashpartitioning") :]
    assert len(re.findall("Exchange ", plan)) == 1
    assert "Generate" not in shuffled and "Aggregate" not in shuffled
