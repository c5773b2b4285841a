import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from brasa.operators import metrics as M
from brasa.operators.incremental import guarded_create
from brasa.operators.quality import contract_report
from brasa.operators.scd2 import build_history
from brasa.session import new_table_path
from brasa.sources.freshness import freshness


def test_freshness_status(spark):
    df = spark.createDataFrame([("2024-01-30 10:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = {str(r.as_of): (r.age_days, r.status) for a in ("2024-02-15", "2024-03-15", "2024-06-01")
           for r in freshness(df, "t", a).collect()}
    assert got == {"2024-02-15": (16, "pass"), "2024-03-15": (45, "warn"), "2024-06-01": (123, "error")}


def test_guarded_create_refuses_without_force(spark):
    path = new_table_path(spark, "guard_test")
    guarded_create(spark, spark.range(3), path)
    with pytest.raises(RuntimeError):
        guarded_create(spark, spark.range(5), path)
    assert guarded_create(spark, spark.range(5), path, force=True).count() == 5
    assert spark.read.parquet(path).count() == 5          # the path itself holds the new rows
    empty = new_table_path(spark, "guard_empty")
    guarded_create(spark, spark.range(0), empty)
    assert guarded_create(spark, spark.range(4), empty).count() == 4 and spark.read.parquet(empty).count() == 4


def test_guarded_create_raises_a_storage_failure(spark):
    import os
    path = new_table_path(spark, "guard_broken")
    local = path.removeprefix("file:")
    os.makedirs(local)
    with open(os.path.join(local, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer|schema"):
        guarded_create(spark, spark.range(1), path)


def test_contract_is_enforced(spark):
    from brasa.operators.quality import enforce_contract
    df = spark.createDataFrame([(1, None), (2, "x")], "a bigint, b string")
    good = StructType([StructField("a", LongType())])
    assert enforce_contract("t", df, ["a"], good) is df
    with pytest.raises(ValueError, match="b is NULL in 1 rows"):
        enforce_contract("t", df, ["a", "b"])
    with pytest.raises(ValueError, match="a is bigint, not string"):
        enforce_contract("t", df, (), StructType([StructField("a", StringType())]))
    with pytest.raises(ValueError, match="c is missing"):
        enforce_contract("t", df, ["c"])


def test_contract_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a bigint, b string")
    contract = StructType([StructField("a", LongType()), StructField("b", StringType()), StructField("c", StringType())])
    got = {r.column_name: (r.actual_type, r.null_violations, r.passes) for r in contract_report(df, contract, ["b"]).collect()}
    assert got == {"a": ("bigint", 0, True), "b": ("string", 1, False), "c": (None, 0, False)}


def test_metrics_simple_filtered_ratio(spark):
    df = spark.createDataFrame([("a", "confirmada", 2), ("a", "denegada", 1), ("b", "confirmada", 4)],
                               "k string, estado string, d bigint").withColumn("solicitud_key", F.col("k"))
    ms = [M.Simple("n", "count", "d"), M.Simple("ok", "count", "d", filter="estado = 'confirmada'"),
          M.Simple("dias", "sum", "d"), M.Simple("media", "average", "d"), M.Ratio("tasa", "ok", "n")]
    got = {r.k: (r.n, r.ok, r.dias, float(r.media), float(r.tasa)) for r in M.evaluate(df, ms, ["k"]).collect()}
    assert got == {"a": (2, 1, 3, 1.5, 0.5), "b": (1, 1, 4, 4.0, 1.0)}


def test_history_with_periodic_materialisation(spark):
    schema = "id_empleado bigint, puesto string"
    extracts = [(spark.createDataFrame([(1, str(i % 2))], schema), f"2024-01-{i + 1:02d} 00:00:00") for i in range(6)]
    h = build_history(extracts, "id_empleado", ["puesto"], materialize_every=2)
    assert h.count() == 6
    assert h.filter(F.col("dbt_valid_to").isNull()).count() == 1


def test_references_to_a_parent_are_counted_in_one_shuffle(spark):
    from brasa.operators.quality import reference_report, reference_reports
    child = spark.createDataFrame([("a", "x"), ("a", None), ("z", "b"), ("z", "x"), (None, "a")], "p string, q string")
    other = spark.createDataFrame([("y",), ("a",), (None,)], "p string")
    keys = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    got = reference_reports([("child", child, "p"), ("child", child, "q"), ("other", other, "p")], "parent", keys, "k")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert got.columns == ["child", "column_name", "parent", "orphans"]
    assert sorted(map(tuple, got.collect())) == [("child", "p", "parent", 2), ("child", "q", "parent", 2), ("other", "p", "parent", 1)]
    assert tuple(reference_report("other", other, "p", "none", keys.limit(0), "k").first()) == ("other", "p", "none", 2)
    assert reference_report("none", other.limit(0), "p", "parent", keys, "k").first().orphans == 0
