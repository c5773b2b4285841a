"""Ranks and per-group statistics that never send a whole table, or a whole rank group, to one task.

``add_ranks`` computes RANK and ROW_NUMBER, per group or over everything, in one way for every size:

1. The input is written once to the shared work folder, each row with a number of its own.  All that follows reads that
   table, so the input is computed once however many ranks there are, and a lost executor cannot change a value between two
   readings of it.
2. Boundaries.  The rows whose hashed numbers lie below a share are one sample for all orders; evenly spaced rows of the
   sorted sample cut an order (group columns, order columns, row number) into ranges, a bounded array in a scalar subquery.
3. A row's range is a plain column expression, a binary search in that array.
4. One shuffle on (group, range) of the order columns and the row number, one window in it, and the rows of the group's
   earlier ranges added: a sum over a table with a row for each group and range.
5. The rank goes back to its row by the row's number; values are never joined.

The row number is part of the order that is cut, so a tie of any size is cut into ranges as well.  For RANK a range that
begins inside a tie takes over the rank of that tie from the ranges before it.  ROW_NUMBER breaks ties by a hash of the row.
NULL is a value like any other (placed as the order says), NaN equals NaN and is the largest number.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil, log2
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from brasa.session import new_table_path

SAMPLES_PER_RANGE = 32
MOST_RANGES = 4096
HASHES = 2 ** 40


@dataclass(frozen=True)
class Order:
    col: str
    descending: bool = False
    nulls_last: bool | None = None   # None: Spark default (first for asc, last for desc)

    @property
    def null_goes_last(self) -> bool:
        return self.nulls_last if self.nulls_last is not None else self.descending

    def expr(self) -> Column:
        c = F.col(self.col)
        if self.descending:
            return c.desc_nulls_last() if self.null_goes_last else c.desc_nulls_first()
        return c.asc_nulls_last() if self.null_goes_last else c.asc_nulls_first()

    def before(self, a: Column, b: Column) -> Column:
        """Whether value ``a`` comes strictly before value ``b``; never NULL."""
        less = a > b if self.descending else a < b
        null = a.isNotNull() & b.isNull() if self.null_goes_last else a.isNull() & b.isNotNull()
        return null | F.coalesce(less, F.lit(False))


@dataclass(frozen=True)
class RankSpec:
    out: str
    order: Sequence[Order]
    partition_by: Sequence[str] = ()
    method: str = "rank"          # "rank" | "row_number"


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs], F.lit(True))


def _ranges(spark: SparkSession) -> int:
    return min(MOST_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _sample(rows: DataFrame, by: Column) -> DataFrame:
    """About ``SAMPLES_PER_RANGE`` rows for each range: those whose hashed ``by`` lies below a share of all hashes."""
    wanted = 2 * SAMPLES_PER_RANGE * (_ranges(rows.sparkSession) + 1)
    share = min(1.0, wanted / max(1, rows.count()))
    return rows.filter(F.pmod(F.xxhash64(by), F.lit(HASHES)) < int(share * HASHES))


def _with_range(keyed: DataFrame, order: Sequence[Order], sample: DataFrame | None = None) -> DataFrame:
    """Adds ``_range``: how many boundaries come before the row's key.  ``sample`` holds rows of ``keyed``."""
    steps = max(1, ceil(log2(_ranges(keyed.sparkSession) + 1)))
    cuts = 2 ** steps - 1
    key = F.struct(*[F.col(o.col).alias(f"k{i}") for i, o in enumerate(order)])
    sample = (_sample(keyed, key) if sample is None else sample).select(key.alias("_key"))
    # the sample is bounded, so one task sorts it
    sorted_ = Window.orderBy(*[Order(f"_key.k{i}", o.descending, o.null_goes_last).expr() for i, o in enumerate(order)])
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    step = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)).over(everything) / (cuts + 1)))
    places = sample.select("_key", F.row_number().over(sorted_).alias("_place"), step.alias("_step")).filter(
        F.col("_place") % F.col("_step") == 0)
    boundaries = places.agg(F.array_sort(F.collect_list(F.struct("_place", "_key"))).alias("b")).select(
        F.slice(F.transform("b", lambda b: b["_key"]), 1, cuts)).scalar()

    def passed(boundary: Column) -> Column:
        """Whether the boundary comes before the row's key."""
        out = F.lit(False)
        for i, o in reversed(list(enumerate(order))):
            own, other = F.col("_key")[f"k{i}"], boundary[f"k{i}"]
            out = o.before(other, own) | (own.eqNullSafe(other) & out)
        return boundary.isNotNull() & out

    halves = F.array(*[F.lit(2 ** s) for s in reversed(range(steps))])
    # the boundary is named once, as each mention of it plans the subquery again
    search = F.aggregate(halves, F.lit(0), lambda at, half: at + F.when(
        F.exists(F.array(F.get(F.col("_cuts"), at + half - 1)), passed), half).otherwise(0))
    return keyed.withColumn("_key", key).withColumn("_cuts", boundaries).withColumn("_range", search).drop("_key", "_cuts")


def _earlier(placed: DataFrame, ties: bool) -> DataFrame:
    """For each group and range: the rows in earlier ranges, and the rank of the tie that goes on into the range, if any."""
    at, key = F.col("_at"), F.col("_key")
    of_ties = [F.max(at).alias("_last"), F.min_by(key, at).alias("_first_key"), F.max_by(key, at).alias("_last_key")]
    sums = placed.groupBy("_group", "_range").agg(F.count("_row").alias("_n"), *(of_ties if ties else []))
    by_range = Window.partitionBy("_group").orderBy("_range")
    so_far = by_range.rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("_before", F.sum("_n").over(so_far) - F.col("_n"))
    carried = F.lit(None).cast("bigint")
    if ties:
        goes_on = F.lag("_range").over(by_range).isNotNull() & F.lag("_last_key").over(by_range).eqNullSafe(F.col("_first_key"))
        inside = F.col("_goes_on") & F.col("_first_key").eqNullSafe(F.col("_last_key"))   # one tie, begun earlier
        sums = sums.withColumn("_goes_on", goes_on).withColumn(
            "_start", F.last(F.when(~inside, F.col("_before") + F.col("_last")), ignorenulls=True).over(so_far))
        carried = F.when(F.col("_goes_on"), F.lag("_start").over(by_range))
    return sums.select(F.col("_group").alias("_of_group"), F.col("_range").alias("_of_range"), "_before",
                       carried.alias("_carried"))


def _ranks(rows: DataFrame, sample: DataFrame, spec: RankSpec, row: str, tie: str) -> DataFrame:
    """(``row``, ``spec.out``) for every row."""
    ties = spec.method != "row_number"
    by = list(spec.order) if ties else [*spec.order, Order(tie)]
    groups, keys = [f"g{i}" for i in range(len(spec.partition_by))], [f"k{i}" for i in range(len(by))]
    names = [F.col(c).alias(n) for c, n in zip([*spec.partition_by, *[o.col for o in by], row], [*groups, *keys, "_row"])]
    order = [Order(k, o.descending, o.null_goes_last) for k, o in zip(keys, by)]
    ranged = _with_range(rows.select(*names), [*[Order(g) for g in groups], *order, Order("_row")], sample.select(*names))
    ranged = ranged.select("_row", (F.struct(*groups) if groups else F.lit(0)).alias("_group"),
                           F.struct(*keys).alias("_key"), "_range")
    inside = [Order(f"_key.{o.col}", o.descending, o.null_goes_last).expr() for o in order]
    within = Window.partitionBy("_group", "_range").orderBy(*inside, *([] if ties else ["_row"]))
    placed = ranged.withColumn("_at", (F.rank() if ties else F.row_number()).over(within))
    earlier = _earlier(placed if ties else ranged.withColumn("_at", F.lit(0)), ties)
    number = F.coalesce(F.when(F.col("_at") == 1, F.col("_carried")), F.col("_before") + F.col("_at"))
    return placed.join(earlier, (F.col("_group") == F.col("_of_group")) & (F.col("_range") == F.col("_of_range"))).select(
        F.col("_row").alias(row), number.cast("bigint").alias(spec.out))


def _unused(columns: Sequence[str], name: str) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name = f"_{name}"
    return name


def add_ranks(df: DataFrame, specs: Sequence[RankSpec]) -> DataFrame:
    """Add a rank column for each spec; rows and other columns stay as they are.

    ``df`` is written once when this is called; ranks refer to its columns, not to each other.
    """
    row, tie = _unused(df.columns, "_row"), _unused(df.columns, "_tie")
    numbered = df.withColumn(row, F.monotonically_increasing_id()).withColumn(tie, F.xxhash64(*[F.col(c) for c in df.columns]))
    rows = _written(numbered, "ranked")
    used = dict.fromkeys(c for s in specs for c in [*s.partition_by, *[o.col for o in s.order]])
    sample = _written(_sample(rows, F.col(row)).select(*used, *[c for c in (row, tie) if c not in used]).repartition(1),
                      "ranked-sample")
    out = rows
    for spec in specs:
        out = out.join(_ranks(rows, sample, spec, row, tie), row)
    return out.select(*df.columns, *[s.out for s in specs])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Stat:
    """A per-group statistic."""
    kind: str                 # sum | count | avg_dec | stddev
    col: str | None = None
    scale: int = 0

    def aggregate(self) -> Column:
        c = F.col(self.col) if self.col else F.lit(1)
        if self.kind == "sum":
            return F.sum(c)
        if self.kind == "count":
            return F.count(c)
        if self.kind == "stddev":
            return F.stddev_samp(c.cast("double"))
        if self.kind == "avg_dec":
            d = c.cast(DecimalType(38, self.scale))
            zero = F.lit(0).cast(DecimalType(38, 0))
            return F.sum(d) / F.nullif(F.count(d).cast(DecimalType(38, 0)), zero)
        raise ValueError(self.kind)


def attach_group_stats(df: DataFrame, partition_by: Sequence[str], stats: dict) -> DataFrame:
    """Attach per-group statistics (AVG(x) OVER (PARTITION BY p) and the like).

    The statistics are aggregated, reduced before the shuffle, and joined back on the key (NULL is a group of its own);
    the planner broadcasts the group table when it is measured small and splits hot keys otherwise.  A statistic over
    everything is a scalar subquery, so no row is joined to it.  Values are ``Stat`` specs or aggregate Columns.
    """
    aggs = [(v.aggregate() if isinstance(v, Stat) else v).alias(n) for n, v in stats.items()]
    if not partition_by:
        totals = df.agg(F.struct(*aggs).alias("_all")).scalar()
        return df.withColumn("_all", totals).select(*df.columns, *[F.col("_all")[n].alias(n) for n in stats])
    grouped = df.groupBy(*[F.col(c).alias(f"_g_{c}") for c in partition_by]).agg(*aggs)
    return df.join(grouped, _same(df, grouped, [(c, f"_g_{c}") for c in partition_by]), "left").drop(
        *[f"_g_{c}" for c in partition_by])
