"""Joins that don't move the fact: fact and dimensions are stored in the same buckets of the join key.

The shuffle is paid once, when the fact is stored; every later join with a dimension in the same buckets, and every
aggregate by the key, reads bucket beside bucket.  A key with a large share of the fact would make one bucket large, so rows
of such keys, and rows without a key, are stored beside the buckets in plain files: there are at most ``1 / hot_share`` such
keys, so the dimension's rows for them are few and are broadcast.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.operators.incremental import publish
from brasa.session import new_table_path

HOT_SHARE = 0.01


def bucketed(spark: SparkSession, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Store a table in buckets of ``key``, sorted by it, one file a bucket; the table's files lie in the shared folder."""
    table = f"brasa_{name}_{uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", new_table_path(spark, name)).saveAsTable(table))
    return spark.table(table)


class BucketedFact:
    """A fact stored in buckets of a key, its hot keys apart.

    ``dimension`` tables come from ``bucketed`` with the same number of buckets and hold one row per key.
    """

    def __init__(self, spark: SparkSession, fact: DataFrame, name: str, key: str, buckets: int, hot_share: float = HOT_SHARE):
        self.key = key
        stored = publish(spark, fact, f"{name}_rows")  # read for the counts and for both parts
        limit = stored.agg((F.count(key) * F.lit(hot_share)).alias("limit")).scalar()
        counts = stored.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        self.hot_keys = publish(spark, counts.filter(F.col("rows") >= limit).select(key), f"{name}_hot")
        few = F.broadcast(self.hot_keys)  # at most 1 / hot_share rows
        keyed = stored.filter(F.col(key).isNotNull())
        self.cold = bucketed(spark, keyed.join(few, key, "left_anti"), name, key, buckets)
        self.hot = publish(spark, keyed.join(few, key, "left_semi").unionByName(stored.filter(F.col(key).isNull())),
                           f"{name}_apart")

    def rows(self) -> DataFrame:
        return self.cold.unionByName(self.hot)

    def left_join(self, dimension: DataFrame) -> DataFrame:
        """Every fact row with its dimension row, or NULLs."""
        wanted = F.broadcast(dimension.join(F.broadcast(self.hot_keys), self.key, "left_semi"))
        return self.cold.join(dimension, self.key, "left").unionByName(self.hot.join(wanted, self.key, "left"))

    def by_key(self, *aggregates: Column) -> DataFrame:
        """Aggregates by the key; both parts hold different keys, so nothing is added up between them."""
        return self.cold.groupBy(self.key).agg(*aggregates).unionByName(self.hot.groupBy(self.key).agg(*aggregates))
