"""Stored tables that later work reads little of: footers, buckets, filters of keys."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brasa.operators.colocated import BucketedFact, bucketed
from brasa.operators.incremental import MonthTable, lookback_delta, publish, upsert
from brasa.operators.membership import key_filters, may_hold
from brasa.session import new_table_path
from brasa.sources.footers import footer_extremes, newest_time, with_mark


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_extremes_come_from_footers(spark):
    path = new_table_path(spark, "footers")
    rows = [(i, date(2024, 1, 1) + timedelta(i) if i % 3 else None, float(i), str(i)) for i in range(500)]  # some dates NULL
    spark.createDataFrame(rows, "k bigint, d date, x double, s string").repartition(4).write.parquet(path)
    got = footer_extremes(spark, [path], ["k", "d", "x"])
    assert "PushedAggregation: [COUNT(*)" in got._jdf.queryExecution().toString()
    assert tuple(got.first()) == (500, 0, date(2024, 1, 2), 0.0, 499, date(2024, 1, 1) + timedelta(499), 499.0)
    with pytest.raises(TypeError):
        footer_extremes(spark, [path], ["s"])
    empty = new_table_path(spark, "footers_empty")
    spark.createDataFrame([], "k bigint, d date").write.parquet(empty)
    assert tuple(footer_extremes(spark, [empty], ["k", "d"]).first()) == (0, None, None, None, None)


def test_mark_and_lookback_from_footers(spark):
    times = [datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2024, 3, 31, 2, 30, 0, 1), None,
             datetime(2024, 10, 27, 2, 30, 15, 123456)]
    schema = "k int, t timestamp_ntz"
    for zone in ("UTC", "Europe/Madrid"):
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            for n in range(1, len(times) + 1):
                path = new_table_path(spark, "marks")
                target = spark.createDataFrame(list(enumerate(times[:n])), schema)
                with_mark(target, "t", "marca").write.parquet(path)
                newest = newest_time(spark, [path], "marca")
                assert spark.range(1).select(newest.alias("t")).first().t == max(t for t in times[:n] if t)
                source = spark.createDataFrame([(i, datetime(2024, 3, 20) + timedelta(i)) for i in range(20)], schema)
                want = sorted(r.k for r in lookback_delta(source, target, "t").collect())
                assert sorted(r.k for r in lookback_delta(source, target, "t", newest=newest).collect()) == want
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
    path = new_table_path(spark, "marks_empty")
    none = new_table_path(spark, "marks_none")
    with_mark(spark.createDataFrame([(1, None)], schema), "t", "marca").write.parquet(none)
    assert spark.range(1).select(newest_time(spark, [none], "marca").alias("t")).first().t is None
    empty = spark.createDataFrame([], schema)
    with_mark(empty, "t", "marca").write.parquet(path)
    newest = newest_time(spark, [path], "marca")
    assert lookback_delta(source, empty, "t", newest=newest).count() == 20
    assert lookback_delta(source, empty, "t", empty_default=None, newest=newest).count() == 0


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_colocated_join_moves_no_fact_row(spark, no_broadcast):
    # key 7 holds a third of the rows; some rows have no key, some keys no dimension row
    rows = [(7 if i % 3 == 0 else None if i % 11 == 0 else i % 400, i) for i in range(6000)]
    fact = spark.createDataFrame(rows, "k int, v int")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(380)], "k int, name string")
    stored = BucketedFact(spark, fact, "colocated", "k", 4)
    assert [r.k for r in stored.hot_keys.collect()] == [7]
    assert stored.cold.filter("k = 7 or k is null").isEmpty()
    joined = stored.left_join(bucketed(spark, dim, "colocated_dim", "k", 4))
    names = dict(dim.collect())
    assert sorted((r.v, r.k, r.name) for r in joined.collect()) == sorted((v, k, names.get(k)) for k, v in rows)
    cold = stored.cold.join(bucketed(spark, dim, "colocated_dim", "k", 4), "k", "left")
    assert "SortMergeJoin" in _plan(cold) and "Exchange" not in _plan(cold)
    assert "Exchange" not in _plan(stored.cold.groupBy("k").agg(F.sum("v")))
    want = {}
    for k, v in rows:
        want[k] = want.get(k, 0) + v
    assert {r.k: r.s for r in stored.by_key(F.sum("v").alias("s")).collect()} == want
    empty = BucketedFact(spark, fact.limit(0), "colocated_none", "k", 4)
    assert empty.left_join(bucketed(spark, dim, "colocated_dim", "k", 4)).collect() == [] and empty.rows().isEmpty()


def test_filters_find_every_key_and_few_others(spark):
    rows = spark.range(60000).select(F.concat(F.lit("key-"), "id").alias("k"), F.when(F.col("id") < 50000, "big").otherwise(
        F.concat(F.lit("m"), F.col("id") % 10)).alias("p")).unionByName(spark.createDataFrame([(None, "big"), (None, "none")], "k string, p string"))
    filters = key_filters(rows, "k", "p")
    assert {r.p: r.blocks for r in filters.select("p", "blocks").distinct().collect()} == {
        "big": 49} | {f"m{i}": 1 for i in range(10)}
    held = may_hold(filters, rows, "k", "p")
    assert held.join(rows, ["k", "p"]).count() == 60000
    strangers = spark.range(20000).select(F.concat(F.lit("other-"), "id").alias("k"))
    assert held.count() - 60000 <= 5 and may_hold(filters, strangers, "k", "p").count() <= 5
    assert may_hold(filters, strangers.limit(0), "k", "p").isEmpty()
    assert may_hold(filters.limit(0), strangers, "k", "p").isEmpty()


def test_keys_that_ask_many_periods_are_not_broadcast(spark):
    """Each key becomes a row for every period, which the size of the keys' file says nothing of."""
    rows = spark.range(4000).select("id", (F.col("id") % 80).cast("string").alias("p"))
    filters = publish(spark, key_filters(rows, "id", "p"), "many_periods")
    asked = may_hold(filters, publish(spark, spark.range(3000, 4200), "few_keys"), "id", "p")
    assert "Broadcast" not in _plan(asked)
    assert asked.join(rows, ["id", "p"]).count() == 1000 and asked.count() < 1010


def test_merge_reads_keys_of_few_months(spark):
    first = date(2019, 1, 1)
    rows = spark.range(6000).select(F.col("id").alias("k"), F.add_months(F.lit(first), (F.col("id") % 60).cast("int")).alias("d"),
                                    F.lit("a").alias("v"))
    delta = spark.createDataFrame([(60 * i + 59, date(2023, 12, 5), "b") for i in range(50)] + [
        (3, date(2023, 12, 6), "moved"), (64, None, "moved"), (10 ** 9, date(2023, 12, 7), "new"), (None, date(2023, 12, 7), "x")],
        "k int, d date, v string")                                              # keys of another whole-number type
    table = MonthTable(spark, new_table_path(spark, "filtered"), "k", "d", filtered=True)
    table.merge(rows)
    months, _ = table._state()
    before = dict(months)
    keys = delta.select(F.col("k").cast("bigint"))
    others = {m: v for m, v in months.items() if m != "2023-12-01"}
    assert table.months_to_search(keys, others) == {"2019-04-01", "2019-05-01"}
    assert table.months_to_search(keys.limit(0), others) == set()
    got = table.merge(delta)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got.collect())) == sorted(map(key, upsert(rows, delta, "k").collect()))
    after = table._state()[0]
    assert {m for m in before if after[m] != before[m]} == {"2019-04-01", "2019-05-01", "2023-12-01"}
    # a month whose filter is not there is searched
    plain = MonthTable(spark, table.path, "k", "d")
    plain.merge(spark.createDataFrame([(5, date(2019, 6, 2), "c")], "k bigint, d date, v string"))
    unknown = table.months_to_search(keys.limit(0), table._state()[0])
    assert unknown == {"2019-06-01"}
