"""Exact medians by distributed selection: memory depends neither on a group's rows nor on its different values.

Every group starts with the range from its smallest to its largest value.  A pass counts the values in ``PARTS`` equal parts of
each range (summed before the shuffle), and the part that holds the wanted rank becomes the next range, until a part is one
value.  The number of passes is the logarithm of the widest range to the base ``PARTS``, six at most; a group's state is
two rows and ``PARTS`` counts for each.  Only one number, the widest range, comes to the driver.
"""

from __future__ import annotations

from decimal import Decimal
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from brasa.operators.incremental import publish

PARTS = 4096


def exact_medians(df: DataFrame, by: Sequence[str], col: str, out: str) -> DataFrame:
    """(by, ``out``): the exact median of ``col`` in each group, as a decimal of one more digit than ``col``.

    ``col`` is an integer or a decimal of at most 18 digits.  NULL is no value; a group without values has a NULL median.
    NULL is a group like any other.
    """
    kind = df.schema[col].dataType
    scale = kind.scale if isinstance(kind, DecimalType) else 0
    if not isinstance(kind, IntegralType) and not (isinstance(kind, DecimalType) and kind.precision <= 18):
        raise TypeError(f"{col} is {kind.simpleString()}: an integer or a decimal of at most 18 digits is needed")
    spark = df.sparkSession
    unscaled = F.col(col) if not scale else F.col(col).cast(DecimalType(38, scale)) * F.lit(10 ** scale).cast("decimal(19,0)")
    groups = F.struct(*[F.col(c).alias(f"b{i}") for i, c in enumerate(by)]) if by else F.lit(0)
    rows = df.select(groups.alias("_group"), unscaled.cast("bigint").alias("_value"))
    ranges = rows.groupBy("_group").agg(F.count("_value").alias("_n"), F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    middles = F.array_distinct(F.array(F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1")))
    wanted = publish(spark, ranges.select(
        "_group", F.explode(middles).alias("_place"), "_low", F.expr(f"(_high - _low) div {PARTS} + 1").alias("_width"))
        .withColumn("_rank", F.col("_place")), "median_ranges")
    widest = wanted.agg(F.max("_width")).first()[0]
    while widest is not None:
        wanted = publish(spark, _narrowed(rows, wanted), "median_ranges")
        widest = None if widest == 1 else (widest - 1) // PARTS + 1
    found = wanted.groupBy("_group").agg((F.min("_low") + F.max("_low")).alias("_twice"))
    median = F.col("_twice").cast("decimal(20,0)") * F.lit(Decimal(5).scaleb(-scale - 1))
    return found.select(*[F.col("_group")[f"b{i}"].alias(c) for i, c in enumerate(by)],
                        median.cast(DecimalType(38, scale + 1)).alias(out))


def _narrowed(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with each range cut down to the part that holds its rank; a group without values stays as it is."""
    of = wanted.select(F.col("_group").alias("_of"), "_place", "_low", "_width", "_rank")
    part = F.expr("(_value - _low) div _width")
    inside = rows.join(of, (F.col("_group") == F.col("_of")) & (F.col("_value") >= F.col("_low"))
                       & (F.col("_value") - F.col("_low") < F.col("_width") * PARTS))
    counts = inside.groupBy("_of", "_place", "_low", "_width", "_rank", part.alias("_part")).agg(F.count("_value").alias("_n"))
    so_far = F.sum("_n").over(Window.partitionBy("_of", "_place").orderBy("_part"))
    hit = counts.withColumn("_upto", so_far).filter("_upto >= _rank and _upto - _n < _rank")
    narrowed = hit.select(F.col("_of").alias("_group"), "_place", (F.col("_low") + F.col("_part") * F.col("_width")).alias("_low"),
                          F.expr(f"(_width - 1) div {PARTS} + 1").alias("_width"),
                          (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"))
    return narrowed.unionByName(wanted.filter(F.col("_low").isNull()).select(narrowed.columns))
