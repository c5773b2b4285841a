"""First row per key without a window.

``ROW_NUMBER() OVER (PARTITION BY k ORDER BY o) = 1`` sends every row of a key
to one task.  The same row is ``min_by(row, o)`` per key (``max_by`` for a
descending order), which Spark aggregates map-side first, so a key holding a
third of the rows is reduced inside every input task before the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = False,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """The row with the smallest (or largest) ``order`` tuple per key; ``order`` must make it unique.

    Struct ordering puts NULL fields first, like an ascending window order (and last when descending).
    """
    cols = [c for c in (columns or df.columns) if c not in keys]
    pick = F.max_by if descending else F.min_by
    row = pick(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order])).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in cols])
