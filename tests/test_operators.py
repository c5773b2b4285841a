from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from brasa.operators.incremental import lookback_delta, upsert
from brasa.operators.intervals import active_per_day
from brasa.operators.quality import Check, quality_report
from brasa.operators.ranking import Order, RankSpec, add_ranks
from brasa.plans.dimensions import dim_time


def test_active_per_day_matches_expansion(spark):
    df = spark.createDataFrame([(1, "2020-01-02", "2020-01-04"), (2, "2020-01-03", None), (3, "2020-01-05", "2020-01-01")],
                               "id int, s string, e string") \
        .select("id", F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e"))
    cal = dim_time(spark, "2020-01-01", "2020-01-06").select(F.col("date_day").alias("fecha"))
    got = {str(r.fecha): r.n for r in active_per_day(df, "s", "e", cal, {"n": F.lit(1)}).collect()}
    assert got == {"2020-01-01": 0, "2020-01-02": 1, "2020-01-03": 2, "2020-01-04": 1, "2020-01-05": 0}
    # an interval that begins before the calendar and one with a gap in it
    some = cal.filter(F.dayofmonth("fecha").isin(3, 5))
    wide = spark.range(1).select(F.lit("2019-12-01").cast("date").alias("s"), F.lit("2020-02-01").cast("date").alias("e"))
    assert [r.n for r in active_per_day(wide, "s", "e", some, {"n": F.lit(1)}).collect()] == [1, 1]


def test_distinct_active_per_day_counts_an_id_once(spark):
    from datetime import date, timedelta
    from brasa.operators.intervals import coalesced, distinct_active_per_day
    day = lambda n: date(2020, 1, 1) + timedelta(n)
    # inside another, touching, equal, open, backwards, without a start, without an id, and apart
    rows = [(1, 0, 9, "a"), (1, 2, 4, "b"), (1, 10, 12, "a"), (1, 20, 21, "b"), (2, 5, 5, "a"), (2, 5, 8, "a"), (2, 5, 8, "a"),
            (3, 7, None, "b"), (4, 9, 3, "a"), (5, None, 4, "a"), (None, 1, 30, "a")]
    rows += [(6, i % 17, i % 17 + i % 5, "ab"[i % 2]) for i in range(300)]
    df = spark.createDataFrame([(i, None if s is None else day(s), None if e is None else day(e), k) for i, s, e, k in rows],
                               "id int, s date, e date, k string")
    cal = dim_time(spark, "2020-01-01", "2020-02-01").select(F.col("date_day").alias("fecha"))
    got = {r.fecha: (r.n, r.b) for r in distinct_active_per_day(df, "id", "s", "e", cal, {
        "n": F.lit(True), "b": F.col("k") == "b"}).collect()}

    def ids(d, kinds):
        return len({i for i, s, e, k in rows if i is not None and s is not None and k in kinds
                    and day(s) <= d <= day(s if e is None else e)})

    assert got == {d: (ids(d, "ab"), ids(d, "b")) for d in got} and len(got) == 31
    united = coalesced(df.filter("id <= 2"), ["id"], "s", "e")
    assert sorted(((r.id, r.s, r.e) for r in united.collect())) == [
        (1, day(0), day(12)), (1, day(20), day(21)), (2, day(5), day(8))]


def test_upsert_and_new_columns(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    delta = spark.createDataFrame([(2, "B", 1), (3, "c", 2)], "k int, v string, extra int")
    got = sorted(tuple(r) for r in upsert(target, delta, "k").collect())
    assert got == [(1, "a", None), (2, "B", 1), (3, "c", 2)]


def test_lookback_window(spark):
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    target = spark.range(1).select(ts("2024-01-10 00:00:00").alias("u"))
    source = spark.createDataFrame([(1, "2024-01-04 00:00:00"), (2, "2024-01-02 00:00:00"), (3, None)], "k int, u string") \
        .withColumn("u", F.col("u").cast("timestamp_ntz"))
    assert [r.k for r in lookback_delta(source, target, "u", 7).collect()] == [1]
    assert lookback_delta(source, None, "u", 7).count() == 3


def _by_windows(df, specs):
    for spec in specs:
        w = Window.partitionBy(*spec.partition_by).orderBy(*[o.expr() for o in spec.order])
        df = df.withColumn(spec.out, (F.rank() if spec.method == "rank" else F.row_number()).over(w).cast("bigint"))
    return df


def _equal_to_windows(df, specs):
    got, want = add_ranks(df, specs), _by_windows(df, specs)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    return got


def _ranked(spark):
    rows = [(i, "g%d" % (i % 3), Decimal(i % 5)) for i in range(200)] + [(1000, None, None)]
    df = spark.createDataFrame(rows, "id int, g string, x decimal(10,0)")
    specs = [RankSpec("r_global", [Order("x", True, False)]),
             RankSpec("r_group", [Order("x", True, False)], ["g"]),
             RankSpec("rn", [Order("x", True, False), Order("id")], ["g"], method="row_number")]
    return {r.id: (r.r_global, r.r_group, r.rn) for r in _equal_to_windows(df, specs).collect()}


def test_rank_ties_and_nulls_first_desc(spark):
    got = _ranked(spark)
    assert got[1000][0] == 1                     # NULL sorts high: first when descending
    assert got[4][0] == got[9][0] == 2           # ties share a rank, next rank leaves a gap
    assert got[3][0] == 2 + 40


def test_rank_of_nan_null_and_one_giant_tie(spark):
    nan = float("nan")
    values = [nan, nan, None, 1.5, -0.0, 0.0, float("inf"), None, nan] * 20 + [7.0] * 3000
    df = spark.createDataFrame([(i, "a" if i % 7 else None, x) for i, x in enumerate(values)], "id int, g string, x double")
    for order in (Order("x"), Order("x", True), Order("x", True, False), Order("x", False, True)):
        _equal_to_windows(df, [RankSpec("r", [order]), RankSpec("rg", [order], ["g"]),
                               RankSpec("n", [order, Order("id")], method="row_number")])
    tied = add_ranks(df.drop("id"), [RankSpec("n", [Order("x")], method="row_number")])
    assert sorted(r.n for r in tied.collect()) == list(range(1, len(values) + 1))


def test_large_tie_is_cut_into_ranges(spark):
    from brasa.operators.ranking import _with_range
    df = spark.range(5000).selectExpr("1 as x", "xxhash64(id) as _tie")
    sizes = [r["count"] for r in _with_range(df, [Order("x"), Order("_tie")]).groupBy("_range").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 5000 / 4


def test_rank_of_an_empty_table_and_names_that_clash(spark):
    df = spark.createDataFrame([], "x int, _n int, g int")
    assert add_ranks(df, [RankSpec("r", [Order("x")]), RankSpec("n", [Order("x")], ["g"], "row_number")]).collect() == []


def test_ranks_of_an_input_that_differs_each_time(spark):
    """The input is computed once: no row is lost, and ranks fit the values beside them."""
    df = spark.range(2000).select("id", (F.rand() * 50).cast("int").alias("x"), F.rand().alias("y"))
    rows = add_ranks(df, [RankSpec("r", [Order("x")]), RankSpec("n", [Order("y")], ["x"], "row_number")]).collect()
    assert len(rows) == 2000
    below = sorted(r.x for r in rows)
    assert all(r.r == below.index(r.x) + 1 for r in rows)
    for x in {r.x for r in rows}:
        of_x = sorted((r.y, r.n) for r in rows if r.x == x)
        assert [n for _, n in of_x] == list(range(1, len(of_x) + 1))


def test_rank_of_a_row_repeated_many_times_and_clashing_names(spark):
    df = spark.range(4000).selectExpr("1 as _row", "2 as _tie", "cast(null as int) as _range")
    ranked = add_ranks(df, [RankSpec("r", [Order("_row")], ["_tie"]), RankSpec("n", [Order("_range")], ["_row"], "row_number")])
    assert ranked.columns == ["_row", "_tie", "_range", "r", "n"]
    rows = ranked.collect()
    assert {r.r for r in rows} == {1} and sorted(r.n for r in rows) == list(range(1, 4001))


def test_ranks_do_not_read_their_source_again(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 as g").write.parquet(f"{tmp_path}/source")
    source = spark.read.parquet(f"{tmp_path}/source")
    ranked = add_ranks(source, [RankSpec("r", [Order("g")]), RankSpec("n", [Order("id", True)], ["g"], "row_number")])
    assert f"{tmp_path}/source" not in ranked._jdf.queryExecution().executedPlan().toString()


def test_quality_report_status(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "z")], "k int, v string")
    checks = [Check("u", "t", "unique", column="k"), Check("nn", "t", "not_null", column="v", severity="warn"),
              Check("acc", "t", "accepted_values", column="v", values=("a",)),
              Check("expr", "t", "expression", expression="k < 5")]
    got = {r.check_name: (r.failing_rows, r.status) for r in quality_report(checks, {"t": df}).collect()}
    assert got == {"u": (1, "fail"), "nn": (1, "warn"), "acc": (1, "fail"), "expr": (0, "pass")}


from hypothesis import HealthCheck, given, settings, strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 6))), min_size=1, max_size=120))
def test_scalable_rank_property(spark, rows):
    """Ranks equal window ranks for any data: ties, NULLs, hot groups, empty ranges."""
    df = spark.createDataFrame([(i, g, x) for i, (g, x) in enumerate(rows)], "id int, g int, x int")
    specs = [RankSpec("r", [Order("x", True, False)], ["g"]), RankSpec("rg", [Order("x")]),
             RankSpec("rn", [Order("x"), Order("id")], ["g"], method="row_number")]
    _equal_to_windows(df, specs)


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k int, d string, v string").withColumn("d", F.col("d").cast("date"))


def _table(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_merge_rewrites_touched_months_only(spark):
    from brasa.operators.incremental import MonthTable
    from brasa.session import new_table_path
    table = MonthTable(spark, new_table_path(spark, "merge_test"), "k", "d")
    base = _rows(spark, [(1, "2024-01-05", "a"), (2, "2024-02-20", "b"), (3, "2024-02-03", "c"), (4, "2024-03-10", "d")])
    table.merge(base)
    before = table._state()[0]
    # key 4 moves from March to February, key 2 is corrected in place, key 5 is new
    delta = _rows(spark, [(2, "2024-02-21", "B"), (4, "2024-02-11", "D"), (5, "2024-02-12", "e")])
    expected = _table(upsert(base, delta, "k"))
    assert _table(table.merge(delta)) == expected
    after = table._state()[0]
    assert set(after) == {"2024-01-01", "2024-02-01"}                     # the emptied month is gone
    assert after["2024-01-01"] == before["2024-01-01"] and after["2024-02-01"] != before["2024-02-01"]
    assert _table(table.merge(delta)) == expected                          # again: no change
    assert _table(table.merge(delta.limit(0))) == expected


def test_merge_keeps_rows_without_a_date(spark):
    from brasa.operators.incremental import merge_partitioned
    from brasa.session import new_table_path
    path = new_table_path(spark, "merge_null_month")
    merge_partitioned(spark, path, _rows(spark, [(1, "2024-01-05", "a"), (2, None, "b"), (3, None, "c")]), "k", "d")
    # key 4 is new, key 2 stays without a date, then 2 gets one and 1 loses its own
    merge_partitioned(spark, path, _rows(spark, [(4, "2024-01-07", "d"), (2, None, "B")]), "k", "d")
    got = merge_partitioned(spark, path, _rows(spark, [(2, "2024-01-09", "BB"), (1, None, "A")]), "k", "d")
    assert {(r.k, str(r.d), r.v) for r in got.collect()} == {
        (1, "None", "A"), (2, "2024-01-09", "BB"), (3, "None", "c"), (4, "2024-01-07", "d")}
    assert got.count() == 4
    only_null = new_table_path(spark, "merge_only_null")
    assert merge_partitioned(spark, only_null, _rows(spark, [(1, None, "a"), (2, None, "b")]), "k", "d").count() == 2
    assert merge_partitioned(spark, only_null, _rows(spark, [(2, None, "c")]), "k", "d").count() == 2


def test_merge_appends_columns_and_takes_repeated_keys_once(spark):
    from brasa.operators.incremental import merge_partitioned
    from brasa.session import new_table_path
    path = new_table_path(spark, "merge_columns")
    merge_partitioned(spark, path, _rows(spark, [(1, "2024-01-05", "a"), (2, "2024-02-05", "b")]), "k", "d", "v")
    delta = _rows(spark, [(2, "2024-02-06", "p"), (2, "2024-02-07", "q"), (2, "2024-02-08", None)]).withColumn("n", F.lit(7))
    got = merge_partitioned(spark, path, delta, "k", "d", "v")
    assert {(r.k, str(r.d), r.v, r.n) for r in got.collect()} == {(1, "2024-01-05", "a", None), (2, "2024-02-07", "q", 7)}
    assert got.count() == 2 and upsert(None, delta, "k", "v").count() == 1


def test_a_merge_that_fails_changes_nothing(spark):
    import pytest
    from brasa.operators.incremental import MonthTable
    from brasa.session import new_table_path
    table = MonthTable(spark, new_table_path(spark, "merge_fails"), "k", "d")
    table.merge(_rows(spark, [(1, "2024-01-05", "a")]))
    with pytest.raises(Exception):
        table.merge(_rows(spark, [(1, "2024-01-06", "b")]).withColumn("v", F.expr("string(1 / (k - 1))")))
    spark.createDataFrame([(1,)], "x int").write.json(f"{table.path}/commits/2")
    fs = spark._jvm.org.apache.hadoop.fs.Path(table.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{table.path}/commits/2/_SUCCESS"), False)  # a commit cut off
    assert [tuple(r)[::2] for r in table.read().collect()] == [(1, "a")]


def test_a_lost_commit_does_not_block_the_table(spark):
    from brasa.operators.incremental import MonthTable
    from brasa.session import new_table_path
    path = new_table_path(spark, "lost_commit")
    MonthTable(spark, path, "k", "d").merge(_rows(spark, [(1, "2024-01-05", "a")]))
    # a writer was lost while it wrote its commit: a folder without the mark of a finished write
    lost = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits/2/_temporary")
    lost.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(lost)
    table = MonthTable(spark, path, "k", "d")
    assert {tuple(r) for r in table.read().select("k", "v").collect()} == {(1, "a")}
    table.merge(_rows(spark, [(2, "2024-02-05", "b")]))
    got = MonthTable(spark, path, "k", "d").merge(_rows(spark, [(1, "2024-02-07", "A")]))
    assert {tuple(r) for r in got.select("k", "v").collect()} == {(1, "A"), (2, "b")}


def test_of_two_merges_at_once_one_is_committed(spark):
    import pytest
    from brasa.operators.incremental import ConcurrentMerge, MonthTable
    from brasa.session import new_table_path
    path = new_table_path(spark, "two_writers")
    MonthTable(spark, path, "k", "d").merge(_rows(spark, [(1, "2024-01-05", "a")]))

    class Slow(MonthTable):
        def _commit(self, number, rows):  # the other writer commits while this one is about to
            MonthTable(spark, path, "k", "d").merge(_rows(spark, [(2, "2024-01-06", "b")]))
            super()._commit(number, rows)

    with pytest.raises(ConcurrentMerge):
        Slow(spark, path, "k", "d").merge(_rows(spark, [(3, "2024-01-07", "c")]))
    table = MonthTable(spark, path, "k", "d")
    assert {r.k for r in table.read().collect()} == {1, 2}
    assert {r.k for r in table.merge(_rows(spark, [(3, "2024-01-07", "c")])).collect()} == {1, 2, 3}


def test_a_broken_table_is_not_published(spark):
    import pytest
    from brasa.operators.incremental import MonthTable, folder_exists, publish
    from brasa.operators.quality import Contract, ContractBroken
    from brasa.session import new_table_path, work_dir
    held = Contract("t", lambda c: {"k": "int", "d": "date", "v": "string"}[c], ("k", "v"))
    good = _rows(spark, [(1, "2024-01-05", "a"), (2, None, "b")])
    assert publish(spark, good, "held", ("d",), held).count() == 2
    assert publish(spark, good.limit(0), "held", (), held).count() == 0
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark)}/tables")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = len(fs.listStatus(folder))
    with pytest.raises(ContractBroken, match="v is NULL in 1 rows"):
        publish(spark, good.unionByName(_rows(spark, [(3, None, None)])), "held", (), held)
    with pytest.raises(ContractBroken, match="k is string, not int"):
        publish(spark, good.withColumn("k", good.k.cast("string")), "held", (), held)
    with pytest.raises(ContractBroken, match="v is missing"):
        publish(spark, good.drop("v"), "held", (), held)
    assert len(fs.listStatus(folder)) == before
    path = new_table_path(spark, "held_months")
    table = MonthTable(spark, path, "k", "d", contract=held)
    table.merge(good)
    with pytest.raises(ContractBroken):
        table.merge(_rows(spark, [(1, "2024-02-05", None)]))
    assert {tuple(r) for r in table.read().select("k", "v").collect()} == {(1, "a"), (2, "b")}
    assert folder_exists(spark, f"{path}/commits/1") and not folder_exists(spark, f"{path}/commits/2")
    # the NULLs are counted in the plan of the write: one scan of the input
    stored = publish(spark, good, "held")
    plan = held.watched(stored)[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan


def test_declared_types_are_those_of_the_overtime_contract():
    from brasa.plans.contracts import FACT_HORAS_EXTRA, declared_type
    assert {f.name: f.dataType.simpleString() for f in FACT_HORAS_EXTRA.fields} == {
        f.name: declared_type("fact_horas_extra", f.name) for f in FACT_HORAS_EXTRA.fields}
