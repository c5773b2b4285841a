"""Interval-to-calendar operators.

``active_per_day`` answers "how many intervals cover each day" without
expanding them: +1 on the first day, -1 after the last day, summed per day
and accumulated along all days that occur; the calendar's days are picked
afterwards, so neither its gaps nor its ends lose an interval.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def active_per_day(df: DataFrame, start: str, end: str, calendar: DataFrame, measures: Mapping[str, Column],
                   day_col: str = "fecha") -> DataFrame:
    """Per calendar day, the number of intervals [start, coalesce(end, start)] for which each 0/1 measure holds.

    Exact for COUNT(DISTINCT id) when the id is unique per interval row.  Intervals that end before they start, and
    those without a start, count nowhere.
    """
    first, last = F.col(start), F.coalesce(F.col(end), F.col(start))
    # one scan: every interval emits +m on its first day and -m on the day after its last
    edges = F.array(F.struct(first.alias("d"), F.lit(1).alias("s")),
                    F.struct(F.date_add(last, 1).alias("d"), F.lit(-1).alias("s")))
    events = df.filter(first.isNotNull() & (last >= first)).select(
        F.explode(edges).alias("_e"), *[m.cast("bigint").alias(n) for n, m in measures.items()])
    deltas = events.groupBy(F.col("_e.d").alias(day_col)).agg(
        *[F.sum(F.col(n) * F.col("_e.s")).alias(n) for n in measures])
    # a row for each day that occurs, reduced before it is accumulated: as many as the calendar spans
    wanted = calendar.select(day_col).withColumn("_wanted", F.lit(True))
    days = wanted.join(deltas, day_col, "full")
    run = Window.orderBy(day_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.select(day_col, "_wanted", *[F.sum(F.coalesce(F.col(n), F.lit(0))).over(run).cast("bigint").alias(n)
                                             for n in measures]).filter("_wanted").drop("_wanted")


def coalesced(df: DataFrame, ids: Sequence[str], start: str, end: str) -> DataFrame:
    """The union of each id's day intervals as (ids, ``start``, ``end``): no two of them overlap or touch.

    Rows are first reduced to the latest end for each id and first day, before the shuffle, so the running maximum of ends
    goes over at most as many rows as an id has different first days, however often it is repeated.  An open end counts as
    the first day alone; backwards intervals and those without a start or an id are left out.
    """
    first, last = F.col(start), F.coalesce(F.col(end), F.col(start))
    known = reduce(lambda a, b: a & b, [F.col(i).isNotNull() for i in ids], first.isNotNull() & (last >= first))
    spans = df.filter(known).groupBy(*ids, first.alias("_first")).agg(F.max(last).alias("_last"))
    in_order = Window.partitionBy(*ids).orderBy("_first")
    reach = F.max("_last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce((F.col("_first") > F.date_add(reach, 1)).cast("int"), F.lit(1))
    islands = spans.withColumn("_apart", apart).withColumn("_island", F.sum("_apart").over(in_order))
    return islands.groupBy(*ids, "_island").agg(F.min("_first").alias(start), F.max("_last").alias(end)).drop("_island")


def distinct_active_per_day(df: DataFrame, id_col: str, start: str, end: str, calendar: DataFrame,
                            measures: Mapping[str, Column], day_col: str = "fecha") -> DataFrame:
    """Per calendar day, the different ids with an interval on it for which each condition holds: COUNT(DISTINCT id) exactly.

    Unlike in ``active_per_day`` an id may have any number of intervals, overlapping ones too: for each measure an id's
    intervals are united first, so every id counts once a day.  Nothing is expanded to days.
    """
    holds = F.filter(F.array(*[F.when(m, F.lit(n)) for n, m in measures.items()]), lambda n: n.isNotNull())
    rows = df.select(F.col(id_col).alias("_id"), F.col(start).alias("_start"), F.col(end).alias("_end"),
                     F.explode(holds).alias("_measure"))
    return active_per_day(coalesced(rows, ["_measure", "_id"], "_start", "_end"), "_start", "_end", calendar,
                          {n: (F.col("_measure") == n).cast("int") for n in measures}, day_col)
