"""Data-quality checks and schema contracts.

Each check yields its failing rows (a DataFrame); ``quality_report`` turns a
list of checks into one row per check with the failing-row count, severity
and status.  Row-level checks on the same table are evaluated in a single
aggregation (one ``count_if`` per check); uniqueness and relationship checks
are one grouped aggregation / anti join each.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass
class Check:
    name: str
    table: str
    kind: str                         # not_null | unique | accepted_values | relationship | expression
    column: str | None = None
    values: Sequence = ()
    expression: str | None = None
    parent: str | None = None         # relationship: parent table name
    parent_column: str | None = None
    where: str | None = None
    severity: str = "error"           # error | warn
    columns: Sequence[str] = field(default_factory=tuple)


def _scoped(df: DataFrame, where: str | None) -> DataFrame:
    return df.filter(F.expr(where)) if where else df


def failing_condition(check: Check) -> Column:
    """Row-level failure predicate (NULL never counts as a failure)."""
    c = F.col(check.column) if check.column else None
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*check.values)
    if check.kind == "expression":
        return F.coalesce(~F.expr(check.expression), F.lit(False))
    raise ValueError(check.kind)


def unique_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    keyed = df.filter(F.greatest(*[F.col(c).isNull() for c in columns]) == F.lit(False)) if len(columns) > 1 \
        else df.filter(F.col(columns[0]).isNotNull())
    return keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_filas")).filter(F.col("n_filas") > 1)


def relationship_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias("_parent_key")).distinct()
    return (child.filter(F.col(column).isNotNull())
            .join(keys, F.col(column) == F.col("_parent_key"), "left_anti"))


def failures(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    df = _scoped(tables[check.table], check.where)
    if check.kind == "unique":
        return unique_failures(df, list(check.columns) or [check.column])
    if check.kind == "relationship":
        return relationship_failures(df, check.column, tables[check.parent], check.parent_column)
    return df.filter(failing_condition(check))


def quality_report(checks: Sequence[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check: name, table, kind, severity, failing rows, status."""
    parts: list[DataFrame] = []
    row_level = [c for c in checks if c.kind in ("not_null", "accepted_values", "expression")]
    by_scope: dict[tuple, list[Check]] = {}
    for c in row_level:
        by_scope.setdefault((c.table, c.where), []).append(c)
    for (table, where), group in by_scope.items():
        agg = _scoped(tables[table], where).agg(
            *[F.count_if(failing_condition(c)).cast("bigint").alias(f"_c{i}") for i, c in enumerate(group)])
        stack = F.explode(F.array(*[
            F.struct(F.lit(c.name).alias("check_name"), F.col(f"_c{i}").alias("failing_rows"))
            for i, c in enumerate(group)]))
        parts.append(agg.select(stack.alias("s")).select("s.*"))
    for c in checks:
        if c.kind in ("unique", "relationship"):
            parts.append(failures(c, tables).agg(F.count(F.lit(1)).cast("bigint").alias("failing_rows"))
                         .select(F.lit(c.name).alias("check_name"), "failing_rows"))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    spark = counts.sparkSession
    meta = spark.createDataFrame([(c.name, c.table, c.kind, c.severity) for c in checks],
                                 "check_name string, table_name string, check_kind string, severity string")
    status = (F.when(F.col("failing_rows") == 0, F.lit("pass"))
              .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return meta.join(counts, "check_name").withColumn("status", status)


def contract_report(df: DataFrame, contract: StructType, not_null: Sequence[str] = ()) -> DataFrame:
    """Compare a frame with its contract: one row per contract column.

    Reports the expected and actual type, whether the column is present with
    the right type, and how many rows break a not-null constraint (one pass).
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    null_counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c)
                           for c in not_null if c in actual]) if not_null else None
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), actual.get(f.name), f.name in not_null)
            for f in contract.fields]
    spec = spark.createDataFrame(rows, "column_name string, expected_type string, actual_type string, "
                                       "is_not_null boolean")
    if null_counts is not None and null_counts.columns:
        stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_violations"))
                                    for c in null_counts.columns]))
        nulls = null_counts.select(stack.alias("s")).select("s.*")
        spec = spec.join(nulls, "column_name", "left")
    else:
        spec = spec.withColumn("null_violations", F.lit(None).cast("bigint"))
    ok = ((F.col("actual_type") == F.col("expected_type"))
          & F.coalesce(F.col("null_violations") == 0, F.lit(True)))
    return spec.withColumn("null_violations", F.coalesce(F.col("null_violations"), F.lit(0)).cast("bigint")) \
               .withColumn("passes", F.coalesce(ok, F.lit(False)))


class ContractBroken(ValueError):
    """A table that is not as its contract says."""


@dataclass(frozen=True)
class Contract:
    """What a table must be: each column of the type that its name declares, some columns present and never NULL.

    Types are compared before a write.  NULLs are counted in the job that writes (``Observation``), so that holding a
    table against its contract takes no pass of its own; a repeated task can count a NULL twice, but never hide one.
    """

    table: str
    type_of: Callable[[str], str]
    not_null: Sequence[str] = ()

    def of_schema(self, schema: StructType) -> None:
        """Raises where a column is missing or has another type."""
        actual = {f.name: f.dataType.simpleString() for f in schema.fields}
        wrong = [f"{c} is missing" for c in self.not_null if c not in actual]
        wrong += [f"{c} is {t}, not {self.type_of(c)}" for c, t in actual.items() if t != self.type_of(c)]
        if wrong:
            raise ContractBroken(f"{self.table} breaks its contract: " + "; ".join(wrong))

    def watched(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """The frame, whose next action counts its rows and NULLs."""
        seen = Observation()
        return df.observe(seen, F.count(F.lit(1)).alias("n_rows"),
                          *[F.count_if(F.col(c).isNull()).alias(c) for c in self.not_null]), seen

    def of_rows(self, seen: Observation) -> None:
        """Raises where the written rows had a NULL in a column that must not."""
        counted = seen.get
        wrong = [f"{c} is NULL in {counted[c]} rows" for c in self.not_null if counted[c]]
        if wrong:
            raise ContractBroken(f"{self.table} breaks its contract: " + "; ".join(wrong))

    def report(self, df: DataFrame) -> DataFrame:
        """A row for each column of the frame: declared and actual type, and how many NULLs it must not hold; one scan."""
        nulls = {c: F.count_if(F.col(c).isNull()).cast("bigint") for c in self.not_null}
        rows = F.array(*[F.struct(
            F.lit(f.name).alias("column_name"), F.lit(self.type_of(f.name)).alias("expected_type"),
            F.lit(f.dataType.simpleString()).alias("actual_type"), F.lit(f.name in nulls).alias("is_not_null"),
            (F.col(f"n_{f.name}") if f.name in nulls else F.lit(0).cast("bigint")).alias("null_violations"))
            for f in df.schema.fields])
        counted = df.agg(F.count(F.lit(1)).alias("n"), *[n.alias(f"n_{c}") for c, n in nulls.items()])
        return counted.select(F.explode(rows).alias("r")).select(
            F.lit(self.table).alias("table_name"), "r.*",
            ((F.col("r.expected_type") == F.col("r.actual_type")) & (F.col("r.null_violations") == 0)).alias("passes"))


def key_report(name: str, df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows a table has, how many lack the key, and how many repeat another row's key."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(key).isNull()).cast("bigint").alias("null_keys"),
                  (F.count(key) - F.count_distinct(key)).alias("repeated_keys")).select(
        F.lit(name).alias("table_name"), F.lit(key).alias("key_name"), "n_rows", "null_keys", "repeated_keys")


def reference_reports(references: Sequence[tuple[str, DataFrame, str]], parent: str, keys: DataFrame, key: str) -> DataFrame:
    """One row for each (child's name, child, column): how many of its rows point to a key that the parent does not hold.

    The children's values and the parent's keys are counted by value together: one shuffle, of values that are counted in
    each task before, however many columns point to the parent.
    """
    parts = [keys.select(F.col(key).alias("_value"), F.lit(-1).alias("_ref"))]
    parts += [df.select(F.col(column).alias("_value"), F.lit(i).alias("_ref")) for i, (_, df, column) in enumerate(references)]
    pointing = [F.count_if(F.col("_ref") == i).alias(f"_n{i}") for i in range(len(references))]
    by_value = reduce(DataFrame.unionByName, parts).filter(F.col("_value").isNotNull()).groupBy("_value").agg(
        F.bool_or(F.col("_ref") == -1).alias("_held"), *pointing)
    zero = F.lit(0).cast("bigint")
    counted = by_value.filter(~F.col("_held")).agg(
        *[F.coalesce(F.sum(f"_n{i}"), zero).alias(f"_n{i}") for i in range(len(references))])
    rows = F.array(*[F.struct(F.lit(child).alias("child"), F.lit(column).alias("column_name"), F.lit(parent).alias("parent"),
                              F.col(f"_n{i}").alias("orphans")) for i, (child, _, column) in enumerate(references)])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def reference_report(child: str, df: DataFrame, column: str, parent: str, keys: DataFrame, key: str) -> DataFrame:
    """One row: how many rows of the child point to a key that the parent does not hold."""
    return reference_reports([(child, df, column)], parent, keys, key)


def enforce_contract(name: str, df: DataFrame, not_null: Sequence[str] = (), contract: StructType | None = None) -> DataFrame:
    """The frame itself; raises where a column is missing, has another type, or breaks a not-null constraint."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = [f"{f.name} is {actual.get(f.name)}, not {f.dataType.simpleString()}"
             for f in (contract.fields if contract else []) if actual.get(f.name) != f.dataType.simpleString()]
    wrong += [f"{c} is missing" for c in not_null if c not in actual]
    if not wrong and not_null:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null]).first()
        wrong = [f"{c} is NULL in {nulls[c]} rows" for c in not_null if nulls[c]]
    if wrong:
        raise ValueError(f"{name} breaks its contract: " + "; ".join(wrong))
    return df
