"""Incremental loads: look-back delta, upsert by unique key, publishing."""

from __future__ import annotations

import json
from typing import Callable
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from brasa.functions.columns import ts_ntz
from brasa.operators.membership import key_filters, may_hold
from brasa.operators.quality import Contract, ContractBroken
from brasa.session import new_table_path

EMPTY_TARGET_MARK = "1900-01-01 00:00:00"


def high_water_mark(target: DataFrame, col: str, empty_default: str | None = EMPTY_TARGET_MARK):
    """Scalar subquery: max(col) of the target, or the default when empty."""
    mark = F.max(F.col(col))
    if empty_default is not None:
        mark = F.coalesce(mark, ts_ntz(empty_default))
    return target.select(mark.alias("_hwm")).scalar()


def lookback_delta(source: DataFrame, target: DataFrame | None, updated_col: str,
                   days: int = 7, empty_default: str | None = EMPTY_TARGET_MARK, newest: Column | None = None) -> DataFrame:
    """Source rows updated at or after (target high-water mark - days).

    No target: everything.  Rows with a NULL update time never qualify.  ``newest`` is the mark where it is known without
    reading the target (``newest_time`` of its files' footers).
    """
    if target is None:
        return source
    mark = high_water_mark(target, updated_col, empty_default) if newest is None else (
        F.coalesce(newest, ts_ntz(empty_default)) if empty_default is not None else newest)
    floor = mark - F.make_dt_interval(F.lit(days))
    return source.filter(F.col(updated_col) >= floor)


def latest_keyed(rows: DataFrame, key: str, newest: str | None = None) -> DataFrame:
    """The rows of ``latest_per_key`` that have a key; they lie by it, so that a join by the key doesn't shuffle them again."""
    order = [F.col(newest).isNotNull(), F.col(newest)] if newest else []
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*order, F.xxhash64(*rows.columns)])])
    row = F.struct(*[F.col(c) for c in rows.columns])
    keyed = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(row, order).alias("_latest"))
    return keyed.select(*[F.col(key) if c == key else F.col("_latest")[c].alias(c) for c in rows.columns])


def latest_per_key(rows: DataFrame, key: str, newest: str | None = None) -> DataFrame:
    """One row for each key: the one with the latest ``newest`` (NULL counts as the oldest), else by a hash of the row.

    Rows without a key are no versions of each other and stay as they are.
    """
    return latest_keyed(rows, key, newest).unionByName(rows.filter(F.col(key).isNull()))


def upsert(target: DataFrame | None, delta: DataFrame, key: str, newest: str | None = None) -> DataFrame:
    """MERGE by unique key: delta rows replace matching target rows, new rows are added.

    A key that the delta holds more than once counts once (``latest_per_key``).  Columns new in the delta are
    appended; old rows get NULL for them.
    """
    delta = latest_per_key(delta, key, newest)
    if target is None:
        return delta
    kept = target.join(delta.select(key), key, "left_anti")
    return kept.unionByName(delta, allowMissingColumns=True)


def _folder(spark: SparkSession, path: str):
    """The file system and the path object of a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _folder(spark, path)
    return fs.exists(target)


def write_held(df: DataFrame, contract: Contract | None, write: Callable[[DataFrame], None], undo: Callable[[], None]) -> None:
    """Write a frame; with a contract, types are compared before, NULLs counted in the same job, and a broken table undone."""
    if contract is None:
        write(df)
        return
    contract.of_schema(df.schema)
    watched, seen = contract.watched(df)
    write(watched)
    try:
        contract.of_rows(seen)
    except ContractBroken:
        undo()
        raise


def publish(spark: SparkSession, df: DataFrame, name: str, cluster_by: tuple[str, ...] = (),
            contract: Contract | None = None) -> DataFrame:
    """Write to a fresh directory in the shared work folder and read it back; a table that breaks its contract is removed.

    ``cluster_by`` sorts the rows inside each output file (no extra shuffle, no sampling pass over
    the input, no skew): every parquet row group then covers a narrow range of the first column,
    and filters on it skip most row groups at read time.
    """
    path = new_table_path(spark, name)
    fs, folder = _folder(spark, path)

    def write(rows: DataFrame) -> None:
        rows = rows.sortWithinPartitions(*cluster_by) if cluster_by else rows
        # keys are hexadecimal digests, of which zstd stores half
        rows.write.mode("errorifexists").option("compression", "zstd").parquet(path)

    write_held(df, contract, write, lambda: fs.delete(folder, True))
    return spark.read.parquet(path)


def guarded_create(spark: SparkSession, df: DataFrame, path: str, force: bool = False) -> DataFrame:
    """Create-as-select at ``path`` that refuses to replace a non-empty table unless forced.

    The new rows are staged beside the table and renamed into its place, so ``path`` itself holds them afterwards.  An
    empty table is replaced without force.  Only a missing path counts as "no table yet"; other failures are raised.
    """
    exists = folder_exists(spark, path)
    if exists and not force and not spark.read.parquet(path).isEmpty():
        raise RuntimeError(f"{path} already holds rows; pass force=True to replace it")
    stage, old = new_table_path(spark, "staged"), new_table_path(spark, "replaced")
    df.write.mode("errorifexists").parquet(stage)
    fs, target = _folder(spark, path)
    fs.mkdirs(target.getParent())
    if exists and not fs.rename(target, _folder(spark, old)[1]):
        raise OSError(f"{path} could not be set aside")
    if not fs.rename(_folder(spark, stage)[1], target):
        raise OSError(f"{stage} could not be renamed to {path}")
    if exists:
        fs.delete(_folder(spark, old)[1], True)
    return spark.read.parquet(path)


PERIOD_COL = "brasa_month"      # folder names that no column of a table should have
VERSION_COL = "brasa_version"
NO_PERIOD = "sin_fecha"  # the period of rows without a date


class ConcurrentMerge(RuntimeError):
    """Another writer committed between this merge's reading of the table and its own commit."""


class MonthTable:
    """A merged table whose files lie in one folder per month, of which a merge rewrites only those it touches.

    ``data/brasa_version=V/brasa_month=M`` holds the rows of month M that merge V wrote; ``commits/N`` lists, as one small JSON
    table, the version that is valid for each month, and the table's schema.  A merge writes its months under a new
    version, then the next commit under a name of its own, which it renames into place; readers take the newest finished
    commit.  Nothing is overwritten, so a merge that fails half way leaves the table as it was, and the next one takes the
    number behind whatever it left.  Of two merges at once one is committed and the other raises ``ConcurrentMerge``.  Rows
    without a date have a period of their own.

    With ``filtered``, a merge also writes a filter of each month's keys (``filters/brasa_version=V``), and rows that a delta
    moves out of other months are looked for only in months whose filter may hold one of its keys, or that have no filter.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, date_col: str, newest: str | None = None,
                 contract: Contract | None = None, filtered: bool = False):
        self.spark, self.path, self.key, self.date_col, self.newest = spark, path.rstrip("/"), key, date_col, newest
        self.contract = contract  # held by the rows that a merge writes, before they are committed
        self.filtered = filtered

    def _commits(self) -> list[int]:
        """The numbers of all commits that were begun in their place, finished or not."""
        fs, folder = _folder(self.spark, f"{self.path}/commits")
        if not fs.exists(folder):
            return []
        return [int(name) for x in fs.listStatus(folder) if (name := x.getPath().getName()).isdigit()]

    def _last_commit(self) -> int:
        fs, _ = _folder(self.spark, self.path)
        return max((n for n in self._commits()
                    if fs.exists(_folder(self.spark, f"{self.path}/commits/{n}/_SUCCESS")[1])), default=0)

    def _commit(self, number: int, rows: list[tuple]) -> None:
        """Write a commit beside the others, then rename it into its place, which fails where the place is taken."""
        pending, place = f"{self.path}/pending/{uuid4().hex}", f"{self.path}/commits/{number}"
        self.spark.createDataFrame(rows, "period string, version string, columns string").coalesce(1).write.json(pending)
        fs, folder = _folder(self.spark, f"{self.path}/commits")
        fs.mkdirs(folder)
        jvm, (_, source), (_, target) = self.spark._jvm, _folder(self.spark, pending), _folder(self.spark, place)
        options = jvm.org.apache.hadoop.fs.Options.Rename
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(
                source, target, self.spark.sparkContext._gateway.new_array(options, 0))
        except Py4JJavaError as taken:
            fs.delete(source, True)
            if "FileAlreadyExists" not in str(taken.java_exception):
                raise
            raise ConcurrentMerge(f"another merge into {self.path} was committed meanwhile; merge again") from taken

    def _state(self) -> tuple[dict[str, str], StructType | None]:
        """The valid version of each month (as many as the calendar spans), and the schema."""
        number = self._last_commit()
        if not number:
            return {}, None
        rows = self.spark.read.schema("period string, version string, columns string").json(
            f"{self.path}/commits/{number}").collect()
        return ({r["period"]: r["version"] for r in rows if r["period"] is not None},
                StructType.fromJson(json.loads(rows[0]["columns"])))

    def _read(self, months: dict[str, str], columns: StructType) -> DataFrame:
        if not months:
            return self.spark.createDataFrame([], columns).withColumn(PERIOD_COL, F.lit("")).limit(0)
        full = StructType([*columns.fields, StructField(VERSION_COL, StringType()), StructField(PERIOD_COL, StringType())])
        folders = [f"{self.path}/data/{VERSION_COL}={v}/{PERIOD_COL}={m}" for m, v in sorted(months.items())]
        return self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*folders).drop(VERSION_COL)

    def read(self) -> DataFrame | None:
        """The table without its period column, or None before the first merge."""
        months, columns = self._state()
        return None if columns is None else self._read(months, columns).drop(PERIOD_COL)

    def _write_filters(self, version: str) -> None:
        """Filters of the keys in the months that a merge has written; one read of their key column."""
        rows = self.spark.read.parquet(f"{self.path}/data/{VERSION_COL}={version}")
        rows = rows.select(self.key, F.col(PERIOD_COL).cast("string").alias(PERIOD_COL))
        key_filters(rows, self.key, PERIOD_COL).write.parquet(f"{self.path}/filters/{VERSION_COL}={version}")

    def months_to_search(self, keys: DataFrame, months: dict[str, str]) -> set[str]:
        """Those of ``months`` (month: valid version) that may hold one of the keys; all of them without filters."""
        if not self.filtered:
            return set(months)
        kept = {v: f"{self.path}/filters/{VERSION_COL}={v}" for v in set(months.values())}
        kept = {v: path for v, path in kept.items() if folder_exists(self.spark, f"{path}/_SUCCESS")}
        unknown = {m for m, v in months.items() if v not in kept}
        if not kept:
            return unknown
        filters = self.spark.read.option("basePath", f"{self.path}/filters").parquet(*sorted(kept.values()))
        valid = [F.concat_ws("/", F.lit(m), F.lit(v)) for m, v in sorted(months.items()) if v in kept]
        filters = filters.filter(F.concat_ws("/", PERIOD_COL, VERSION_COL).isin(*valid)).drop(VERSION_COL)
        return unknown | {r[0] for r in may_hold(filters, keys, self.key, PERIOD_COL).select(PERIOD_COL).distinct().collect()}

    def merge(self, delta: DataFrame, unique: bool = False) -> DataFrame:
        """Delta rows replace the rows with their keys, whatever month those lie in; new columns are appended.

        ``unique``: the delta holds each key once already.
        """
        number = max(self._commits(), default=0) + 1  # before the state is read: a later commit takes this number
        months, columns = self._state()
        period = F.coalesce(F.date_format(F.trunc(self.date_col, "MM"), "yyyy-MM-dd"), F.lit(NO_PERIOD))
        # computed once: what follows reads it several times
        incoming = publish(self.spark, delta if unique else latest_per_key(delta, self.key, self.newest), "merge_delta")
        staged = incoming.withColumn(PERIOD_COL, period)
        touched = {r[0] for r in staged.select(PERIOD_COL).distinct().collect()}
        rebuilt = staged
        if columns is not None:
            if not touched:
                return self.read()
            others = {m: v for m, v in months.items() if m not in touched}
            keys = incoming.select(F.col(self.key).cast(columns[self.key].dataType))  # hashes depend on the type
            suspects = self.months_to_search(keys, others) if others else set()
            table = self._read({m: v for m, v in months.items() if m in touched or m in suspects}, columns)
            # keys first: where a delta replaces few rows, the rows of its months are not shuffled to find them
            replaced = publish(self.spark, table.select(self.key, PERIOD_COL).join(
                incoming.select(self.key), self.key, "left_semi"), "merge_replaced")
            touched |= {r[0] for r in replaced.select(PERIOD_COL).distinct().collect()}
            old = self._read({m: v for m, v in months.items() if m in touched}, columns)
            rebuilt = old.join(replaced.select(self.key), self.key, "left_anti").unionByName(
                staged, allowMissingColumns=True)
        kept = rebuilt.drop(PERIOD_COL).schema
        version = uuid4().hex[:12]
        place = f"{self.path}/data/{VERSION_COL}={version}"
        fs, folder = _folder(self.spark, place)
        if self.contract is not None:
            self.contract.of_schema(kept)
        watched, seen = self.contract.watched(rebuilt) if self.contract else (rebuilt, None)
        watched.repartition(PERIOD_COL, F.pmod(F.xxhash64(self.key), F.lit(FILES_PER_MONTH))).sortWithinPartitions(
            PERIOD_COL, self.date_col).write.partitionBy(PERIOD_COL).option("compression", "zstd").parquet(place)
        if seen is not None:
            try:
                self.contract.of_rows(seen)
            except ContractBroken:
                fs.delete(folder, True)
                raise
        if self.filtered:
            self._write_filters(version)
        names = [x.getPath().getName() for x in fs.listStatus(folder)]
        written = {n.split("=", 1)[1] for n in names if n.startswith(f"{PERIOD_COL}=")}
        valid = {m: v for m, v in months.items() if m not in touched} | {m: version for m in written}
        listed = [(m, v, kept.json()) for m, v in sorted(valid.items())] or [(None, None, kept.json())]
        try:
            self._commit(number, listed)
        except ConcurrentMerge:
            for written in ("data", "filters"):  # what this merge wrote is in no commit
                fs.delete(_folder(self.spark, f"{self.path}/{written}/{VERSION_COL}={version}")[1], True)
            raise
        return self.read()


FILES_PER_MONTH = 8


def merge_partitioned(spark: SparkSession, table_path: str, delta: DataFrame, key: str, date_col: str,
                      newest: str | None = None, filtered: bool = False) -> DataFrame:
    """MERGE ``delta`` into the month table at ``table_path`` (see ``MonthTable``) and read the table."""
    return MonthTable(spark, table_path, key, date_col, newest, filtered=filtered).merge(delta)
