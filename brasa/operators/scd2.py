"""Slowly changing dimension, type 2, with hard deletes.

History rows carry ``dbt_valid_from`` / ``dbt_valid_to`` (half open, NULL =
open), ``dbt_is_deleted``, ``dbt_scd_id`` and ``dbt_updated_at``.  A new
version opens only when one of the *check* columns changes (NULL-safe); other
columns do not open versions.  A key missing from an extract gets its open
version closed and a deleted-marker row opened; a key that comes back closes
the marker and opens a fresh version.

Each apply is one equi-join of the open versions with the new extract on the
business key; closed versions pass through untouched.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brasa.functions.columns import ts_ntz

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to", "dbt_is_deleted"]


def scd_id(key: Column, at: Column) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit("|"), at.cast("string")))


def bootstrap_history(snapshot: DataFrame, key: str, at: str = "1900-01-01 00:00:00") -> DataFrame:
    """First history: one open version per key, valid from ``at``."""
    t = ts_ntz(at)
    return snapshot.select(
        "*", scd_id(F.col(key), t).alias("dbt_scd_id"), t.alias("dbt_updated_at"),
        t.alias("dbt_valid_from"), F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
        F.lit(False).alias("dbt_is_deleted"))


def scd2_apply(history: DataFrame, snapshot: DataFrame, key: str, check_cols: Sequence[str],
               at: str) -> DataFrame:
    """Apply one extract taken at ``at`` to the history."""
    t = ts_ntz(at)
    attrs = [c for c in snapshot.columns]
    closed = history.filter(F.col("dbt_valid_to").isNotNull())
    current = history.filter(F.col("dbt_valid_to").isNull())

    c = current.select(*[F.col(x).alias(f"c__{x}") for x in current.columns], F.lit(True).alias("c__present"))
    s = snapshot.select(*[F.col(x).alias(f"s__{x}") for x in attrs], F.lit(True).alias("s__present"))
    j = c.join(s, F.col(f"c__{key}") == F.col(f"s__{key}"), "full_outer")

    c_in = F.coalesce(F.col("c__present"), F.lit(False))
    s_in = F.coalesce(F.col("s__present"), F.lit(False))
    c_del = F.coalesce(F.col("c__dbt_is_deleted"), F.lit(False))
    same = F.lit(True)
    for col in check_cols:
        same = same & F.col(f"c__{col}").eqNullSafe(F.col(f"s__{col}"))
    changed = c_in & s_in & (c_del | ~same)
    vanished = c_in & ~s_in & ~c_del

    kinds = F.filter(F.array(
        F.when(c_in & ~changed & ~vanished, F.lit("keep")),
        F.when(changed | vanished, F.lit("close")),
        F.when(s_in & (~c_in | changed), F.lit("open")),
        F.when(vanished, F.lit("delete")),
    ), lambda x: x.isNotNull())
    rows = j.withColumn("_kind", F.explode(kinds))
    kind = F.col("_kind")
    from_current = kind.isin("keep", "close", "delete")

    out = [F.when(from_current, F.col(f"c__{x}")).otherwise(F.col(f"s__{x}")).alias(x) for x in attrs]
    new_row = kind.isin("open", "delete")
    key_value = F.coalesce(F.col(f"c__{key}"), F.col(f"s__{key}"))
    out += [
        F.when(new_row, scd_id(key_value, t)).otherwise(F.col("c__dbt_scd_id")).alias("dbt_scd_id"),
        F.when(new_row, t).otherwise(F.col("c__dbt_updated_at")).alias("dbt_updated_at"),
        F.when(new_row, t).otherwise(F.col("c__dbt_valid_from")).alias("dbt_valid_from"),
        F.when(kind == "close", t).otherwise(F.lit(None).cast("timestamp_ntz")).alias("dbt_valid_to"),
        F.when(kind == "delete", F.lit(True)).when(kind == "open", F.lit(False))
        .otherwise(F.col("c__dbt_is_deleted")).alias("dbt_is_deleted"),
    ]
    return closed.unionByName(rows.select(*out))


def build_history(extracts: Sequence[tuple[DataFrame, str]], key: str,
                  check_cols: Sequence[str], materialize_every: int = 8) -> DataFrame:
    """Bootstrap with the first extract, then apply the following ones in order.

    With many extracts (daily snapshots over years) the plan would grow with every apply, so
    the history is written to the shared work folder every ``materialize_every`` applies.
    """
    (first, at0), *rest = extracts
    history = bootstrap_history(first, key, at0)
    for i, (snap, at) in enumerate(rest, start=1):
        history = scd2_apply(history, snap, key, check_cols, at)
        if materialize_every and i % materialize_every == 0 and i < len(rest):
            from brasa.operators.incremental import publish
            history = publish(history.sparkSession, history, "scd2_history")
    return history


def history_at_once(extracts: Sequence[tuple[DataFrame, str]], key: str, check_cols: Sequence[str]) -> DataFrame:
    """The history of ``build_history`` from all extracts together: one shuffle on the key, however many extracts there are.

    A key's rows in the order of the extracts are cut where a version opens (first seen, seen again after a gap, a check
    column changed) and where the key is missing from the next extract; each cut is a row of the history, valid until the
    next one.  A version and its deleted marker keep the values of the row that opened it.  The rows of one key are at most
    as many as the extracts.  Keys are unique within an extract; rows without a key have no history and are left out.
    """
    times = [at for _, at in extracts]
    if any(a >= b for a, b in zip(times, times[1:])):
        raise ValueError("extracts must be in the order of their times")
    attrs = extracts[0][0].columns
    stacked = reduce(DataFrame.unionByName, [df.select(F.col(key).alias("_key"), F.struct(*attrs).alias("_row"), F.lit(n).alias("_n"))
                                             for n, (df, _) in enumerate(extracts)]).filter(F.col("_key").isNotNull())
    in_order = Window.partitionBy("_key").orderBy("_n")
    checked = F.struct(*[F.col("_row")[c] for c in check_cols])
    n, before = F.col("_n"), F.lag("_n").over(in_order)
    opens = before.isNull() | (before < n - 1) | ~F.lag(checked).over(in_order).eqNullSafe(checked)
    ends = (n < len(extracts) - 1) & ~F.lead("_n").over(in_order).eqNullSafe(n + 1)
    cut = stacked.select("*", opens.alias("_opens"), ends.alias("_ends"))
    opened = F.last(F.when(F.col("_opens"), F.col("_row")), ignorenulls=True).over(
        in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = cut.withColumn("_opened", opened).filter("_opens or _ends")

    def event(at: Column, deleted: bool) -> Column:
        return F.struct(F.get(F.array(*[ts_ntz(t) for t in times]), at).alias("at"), F.lit(deleted).alias("deleted"))

    kinds = F.filter(F.array(F.when(F.col("_opens"), event(n, False)), F.when(F.col("_ends"), event(n + 1, True))),
                     lambda e: e.isNotNull())
    rows = cut.select("_key", "_opened", F.explode(kinds).alias("_event"))
    at = F.col("_event.at")
    until = F.lead(at).over(Window.partitionBy("_key").orderBy(at))
    return rows.select(*[F.col("_opened")[c].alias(c) for c in attrs], scd_id(F.col("_key"), at).alias("dbt_scd_id"),
                       at.alias("dbt_updated_at"), at.alias("dbt_valid_from"), until.alias("dbt_valid_to"),
                       F.col("_event.deleted").alias("dbt_is_deleted"))
