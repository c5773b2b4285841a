"""Source freshness: age of the newest load timestamp against warn / error limits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WARN_AFTER_DAYS = 30
ERROR_AFTER_DAYS = 60


def freshness(df: DataFrame, loaded_at: str, as_of: str, warn_days: int = WARN_AFTER_DAYS,
              error_days: int = ERROR_AFTER_DAYS, enabled: bool = True) -> DataFrame:
    """One row: newest load time, its age in days at ``as_of`` and pass / warn / error."""
    newest = df.agg(F.max(F.col(loaded_at)).alias("max_loaded_at"))
    age = F.datediff(F.lit(as_of).cast("date"), F.col("max_loaded_at")).cast("bigint")
    status = (F.when(F.lit(not enabled), F.lit("skipped")).when(age > error_days, F.lit("error"))
              .when(age > warn_days, F.lit("warn")).otherwise(F.lit("pass")))
    return newest.select(F.lit(as_of).cast("date").alias("as_of"), "max_loaded_at",
                         age.alias("age_days"), status.alias("status"))


# the bronze tables that have a load column
SOURCES = ("users", "vehicles", "equipos_personales", "extra_hours", "guards", "requests",
           "firefighters_assignments", "shift_change_requests", "incidents")


def freshness_of_all(bronze, as_of: str, loaded_at: str = "_LOADED_AT", disabled: tuple[str, ...] = ()) -> DataFrame:
    """``freshness`` of every bronze table that has a load column, on it, one row each; those in ``disabled`` are skipped."""
    parts = [freshness(bronze.table(name), loaded_at, as_of, enabled=name not in disabled).select(
        F.lit(name).alias("source"), "*") for name in SOURCES]
    return reduce(DataFrame.unionByName, parts)
