"""Exact distinct counts that can be merged: bitmaps of ids, stored by day and united for coarser periods.

A count of different ids can't be summed from days to months, but a union of sets can.  Each day (and group) keeps its ids
as bitmaps of 32,768 neighbouring ids; months, quarters and any other period are unions of the stored rows, so the fact is
never read again.  A stored row is 4 KB however few ids it holds (compressed in the file and in the shuffle), so ids should
be numbered densely; ids that are not numbers, or not dense, are numbered by a dimension first.  NULL is no id.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, id_col: str, day: Column, by: Sequence[str] = ()) -> DataFrame:
    """(dia, by, cubo, ids): for each day and group the bitmaps of its ids, by bucket of ids."""
    key = F.col(id_col).cast("bigint")
    return df.filter(F.col(id_col).isNotNull()).groupBy(
        day.alias("dia"), *by, F.bitmap_bucket_number(key).alias("cubo")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("ids"))


def united(bitmaps: DataFrame, period: Column, by: Sequence[str] = ()) -> DataFrame:
    """The bitmaps of coarser periods, or of fewer groups; a table of the same form, which can be united further."""
    return bitmaps.groupBy(period.alias("dia"), *by, "cubo").agg(F.bitmap_or_agg("ids").alias("ids"))


def distinct_ids(bitmaps: DataFrame, out: str, by: Sequence[str] = ()) -> DataFrame:
    """(dia, by, ``out``): how many different ids each period and group has."""
    return bitmaps.groupBy("dia", *by).agg(F.sum(F.bitmap_count("ids")).cast("bigint").alias(out))
