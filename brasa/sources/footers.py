"""Newest and oldest values, and row counts, from the footers of Parquet files, without reading a data page.

Spark answers COUNT, MIN and MAX from the footers' statistics where the files are read by its newer Parquet source and the
column is a whole number, a floating-point number, a boolean or a date.  Timestamps and texts are not answered that way, so
``with_mark`` gives a stored table the microseconds of a timestamp as a whole number.  A filter on the rows, or a group,
would need the pages again; both are refused here by having no place for them.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType,
)

IN_FOOTERS = (BooleanType, ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DateType)
EPOCH = "1970-01-01 00:00:00"
NO_TIME = -(2 ** 63)


def mark(ts: str) -> Column:
    """Microseconds from 1970 to a timestamp without time zone; the session's zone plays no part.

    A missing timestamp has the smallest mark, so a mark is never NULL and the newest one is that of the newest timestamp.
    """
    day = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    second = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("bigint")
    fraction = (F.date_part(F.lit("SECOND"), F.col(ts)).cast("decimal(18,6)") * F.lit(1_000_000)).cast("bigint")
    return F.coalesce((day * F.lit(86_400) + second) * F.lit(1_000_000) + fraction, F.lit(NO_TIME))


def marked_time(micros: Column) -> Column:
    """The timestamp of a mark; NULL for that of a missing one."""
    micros = F.nullif(micros, F.lit(NO_TIME))
    whole = (micros / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)")
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), whole)


def with_mark(df: DataFrame, ts: str, out: str) -> DataFrame:
    return df.withColumn(out, mark(ts))


def _reader(spark: SparkSession):
    """A reader of the same application that takes Parquet files by the source which knows about footers."""
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other.read


def footer_extremes(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row: n, and min_x and max_x for each column, NULL where the table is empty.

    Columns of types that footers don't answer are refused.  Spark fails on a row group in which a column is NULL throughout
    and so has no least value: take columns that are never NULL, such as keys and marks.
    """
    table = _reader(spark).parquet(*paths)
    for field in (table.schema[c] for c in columns):
        if not isinstance(field.dataType, IN_FOOTERS):
            raise TypeError(f"{field.name} is {field.dataType.simpleString()}, which footers don't answer; store a mark")
    lows, highs = [F.min(c).alias(f"min_{c}") for c in columns], [F.max(c).alias(f"max_{c}") for c in columns]
    ends = table.agg(F.count(F.lit(1)).alias("n"), *lows, *highs)
    return ends.withColumn("n", F.greatest("n", F.lit(0)))  # Spark adds the counts of no row group up to NULL


def newest_time(spark: SparkSession, paths: Sequence[str], mark_col: str) -> Column:
    """Scalar subquery: the newest timestamp whose mark the files hold; usable in any frame of ``spark``."""
    return marked_time(footer_extremes(spark, paths, [mark_col]).select(f"max_{mark_col}").scalar())
