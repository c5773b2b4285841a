"""Which periods of a table may hold a key: Bloom filters as rows of a table, made and asked by Spark.

A period's keys are dealt by hash to blocks of 32,768 bits (4 KB), about ``KEYS_PER_BLOCK`` keys each, and every key sets
``4 * HASHES`` bits of its block.  A key that a period holds always finds all its bits set; one that it doesn't hold finds
them set about once in three million times.  A filter takes four bytes a key, however long the key is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 1 << 15
KEYS_PER_BLOCK = 1024
HASHES = 4  # 64-bit hashes of a key, each of which names four bits


def _hashes(key: str) -> list[Column]:
    return [F.xxhash64(F.lit(seed), F.col(key)) for seed in range(HASHES)]


def _bits(hashes: list[Column]) -> list[Column]:
    return [F.shiftrightunsigned(h, 15 * part).bitwiseAND(F.lit(BLOCK_BITS - 1)) for h in hashes for part in range(4)]


def _block(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), F.col(key)), blocks).cast("int")


def key_filters(keys: DataFrame, key: str, period: str) -> DataFrame:
    """(period, blocks, block, bits) for rows (key, period); NULL keys set nothing.

    The keys' hashes are shuffled once, by block, before bits are named and set, so a task holds only the blocks dealt to it.
    """
    keys = keys.filter(F.col(key).isNotNull()).select(key, period)
    sizes = keys.groupBy(period).agg(F.ceil(F.count(F.lit(1)) / F.lit(KEYS_PER_BLOCK)).cast("int").alias("blocks"))
    dealt = keys.join(F.broadcast(sizes), period).select(  # one row a period
        period, "blocks", _block(key, F.col("blocks")).alias("block"), F.array(*_hashes(key)).alias("hashes"))
    # as many tasks as there are, not as few as the hashes' bytes ask for: a row becomes sixteen
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = F.array(*_bits([F.get("hashes", F.lit(seed)) for seed in range(HASHES)]))
    return dealt.repartition(tasks, period, "blocks", "block").select(
        period, "blocks", "block", F.explode(bits).alias("bit")).groupBy(
        period, "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _is_set(bits: str, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1


def may_hold(filters: DataFrame, keys: DataFrame, key: str, period: str) -> DataFrame:
    """The different (period, key) where the period's filter has all bits of the key.

    Every key asks each period once, in the one block that is its own there.  The periods are as many as the calendar
    spans, so their sizes travel as one array.  Spark takes the keys for as few after each has become a row for every period
    as before, and would broadcast them; so it is told to shuffle them, without their hashes, which are made again.
    """
    sizes = filters.groupBy(period).agg(F.max("blocks").alias("blocks")).agg(
        F.collect_list(F.struct(period, "blocks")).alias("sizes")).scalar()
    asked = keys.filter(F.col(key).isNotNull()).select(key).distinct().select(key, F.explode(sizes).alias("size"))
    asked = asked.select(key, F.col(f"size.{period}").alias(period), F.col("size.blocks").alias("blocks"))
    asked = asked.withColumn("block", _block(key, F.col("blocks")))
    return asked.join(filters.hint("shuffle_hash"), [period, "blocks", "block"]).filter(
        reduce(Column.__and__, [_is_set("bits", bit) for bit in _bits(_hashes(key))])).select(period, key)
