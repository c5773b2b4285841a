from pyspark.sql import functions as F

from brasa.operators.asof import asof_join
from brasa.operators.scd2 import build_history
from brasa.plans.dimensions import dim_empleado

SCHEMA = "id_empleado bigint, puesto string, vacaciones int"
T1, T2, T3 = "1900-01-01 00:00:00", "2023-07-01 10:00:00", "2024-03-01 09:00:00"


def _history(spark):
    e1 = spark.createDataFrame([(1, "A", 1), (2, "A", 1), (3, "A", 1), (4, None, 1), (5, "A", 1), (6, "A", 1)], SCHEMA)
    # 1 unchanged, 2 volatile only, 3 checked column, 4 NULL -> value, 5 deleted, 6 deleted then back, 7 new
    e2 = spark.createDataFrame([(1, "A", 1), (2, "A", 9), (3, "B", 1), (4, "X", 1), (7, "A", 1)], SCHEMA)
    e3 = spark.createDataFrame([(1, "A", 1), (2, "A", 9), (3, "B", 1), (4, "X", 1), (6, "A", 1), (7, "A", 1)], SCHEMA)
    return build_history([(e1, T1), (e2, T2), (e3, T3)], "id_empleado", ["puesto"])


def test_scd2_versions(spark):
    h = _history(spark)
    counts = {r[0]: r[1] for r in h.groupBy("id_empleado").count().collect()}
    assert counts == {1: 1, 2: 1, 3: 2, 4: 2, 5: 2, 6: 3, 7: 1}


def test_scd2_hard_delete_and_return(spark):
    rows = (_history(spark).filter(F.col("id_empleado").isin(5, 6))
            .orderBy("id_empleado", "dbt_valid_from").collect())
    five = [(str(r.dbt_valid_from), str(r.dbt_valid_to), r.dbt_is_deleted) for r in rows if r.id_empleado == 5]
    assert five == [("1900-01-01 00:00:00", "2023-07-01 10:00:00", False), ("2023-07-01 10:00:00", "None", True)]
    six = [(r.dbt_is_deleted, r.dbt_valid_to is None) for r in rows if r.id_empleado == 6]
    assert six == [(False, False), (True, False), (False, True)]


def test_scd2_volatile_column_keeps_opening_values(spark):
    r = _history(spark).filter(F.col("id_empleado") == 2).first()
    assert r.vacaciones == 1 and r.dbt_valid_to is None


def test_one_current_version_per_key(spark):
    d = dim_empleado(spark, _history(spark).withColumn("nombre_token", F.lit("n"))
                     .withColumn("tipo_usuario", F.lit("t")).withColumn("categoria_puesto", F.lit("c"))
                     .withColumn("es_mando_especial", F.lit(False)))
    bad = d.filter(F.col("es_version_actual") & (F.col("id_empleado") != -1)).groupBy("id_empleado").count() \
           .filter(F.col("count") > 1).count()
    assert bad == 0
    assert d.filter(F.col("empleado_key") == "-1").count() == 1


def test_asof_edges(spark):
    versions = spark.createDataFrame(
        [("k1", 1, "1900-01-01 00:00:00", "2024-03-01 10:00:00"), ("k2", 1, "2024-03-01 10:00:00", None)],
        "empleado_key string, id_empleado bigint, f string, t string") \
        .select("empleado_key", "id_empleado", F.col("f").cast("timestamp_ntz").alias("fecha_inicio_validez"),
                F.col("t").cast("timestamp_ntz").alias("fecha_fin_validez"))
    facts = spark.createDataFrame(
        [(1, 1, "2020-01-01"), (2, 1, "2024-03-01"), (3, 1, "2024-03-02"), (4, 1, None), (5, 9, "2024-03-02"),
         (6, None, "2024-03-02")], "n int, id bigint, d string").withColumn("d", F.col("d").cast("date"))
    got = {r.n: r.k for r in asof_join(facts, versions, "id", "d", "k").collect()}
    # a change at 10:00 does not affect that day's fact; misses get '-1'
    assert got == {1: "k1", 2: "k1", 3: "k2", 4: "-1", 5: "-1", 6: "-1"}


def test_stored_history_bootstrap_and_snapshots(spark):
    import pytest
    from brasa.registry import warehouse
    from brasa.session import new_table_path
    from conftest import SF_SMALL
    w = warehouse(spark, SF_SMALL)
    path = new_table_path(spark, "snp_test")
    h = w.bootstrap_employee_history(path)
    with pytest.raises(RuntimeError):
        w.bootstrap_employee_history(path)
    (_, _), (e2, t2), (e3, t3) = w.user_extracts()
    h = w.snapshot_employees(h, e2, t2)
    h = w.snapshot_employees(h, e3, t3)
    # bootstrapped from the current users instead of the first extract: same versions from the second on
    assert h.filter(F.col("dbt_valid_to").isNull()).groupBy("id_empleado").count().filter("count > 1").count() == 0
    assert h.filter(F.col("dbt_is_deleted")).count() > 0


def test_salted_asof_equals_plain_with_a_hot_id(spark):
    """One id holds most fact rows: the salted join gives exactly the plain join's keys."""
    versions = spark.createDataFrame(
        [("a1", 1, "1900-01-01 00:00:00", "2024-03-01 10:00:00"), ("a2", 1, "2024-03-01 10:00:00", None),
         ("b1", 2, "1900-01-01 00:00:00", None)],
        "empleado_key string, id_empleado bigint, f string, t string") \
        .select("empleado_key", "id_empleado", F.col("f").cast("timestamp_ntz").alias("fecha_inicio_validez"),
                F.col("t").cast("timestamp_ntz").alias("fecha_fin_validez"))
    rows = [(n, 1 if n % 10 else 2, "2024-02-%02d" % (1 + n % 28)) for n in range(600)] + \
           [(1000 + n, 1, "2024-03-%02d" % (1 + n % 28)) for n in range(300)] + [(5000, None, "2024-03-02")]
    facts = spark.createDataFrame(rows, "n int, id bigint, d string").withColumn("d", F.col("d").cast("date"))
    plain = {r.n: r.k for r in asof_join(facts, versions, "id", "d", "k", skew="none").collect()}
    salted = {r.n: r.k for r in asof_join(facts, versions, "id", "d", "k", skew="salt", salts=8).collect()}
    assert salted == plain and len(plain) == len(rows)
    assert plain[1000] == "a1" and plain[1001] == "a2" and plain[1] == "a1" and plain[0] == "b1" and plain[5000] == "-1"


def test_asof_on_version_bounds(spark):
    """Half-open validity: a fact dated exactly at a version's start takes it; exactly at its end, the next."""
    versions = spark.createDataFrame(
        [("v1", 7, "1900-01-01 00:00:00", "2024-03-05 00:00:00"), ("v2", 7, "2024-03-05 00:00:00", "2024-04-01 00:00:00"),
         ("v3", 7, "2024-04-01 00:00:00", None)],
        "empleado_key string, id_empleado bigint, f string, t string") \
        .select("empleado_key", "id_empleado", F.col("f").cast("timestamp_ntz").alias("fecha_inicio_validez"),
                F.col("t").cast("timestamp_ntz").alias("fecha_fin_validez"))
    facts = spark.createDataFrame([(1, 7, "2024-03-04"), (2, 7, "2024-03-05"), (3, 7, "2024-03-31"), (4, 7, "2024-04-01"),
                                   (5, 7, "1950-06-01")], "n int, id bigint, d string") \
        .withColumn("d", F.col("d").cast("date"))
    got = {r.n: r.k for r in asof_join(facts, versions, "id", "d", "k").collect()}
    assert got == {1: "v1", 2: "v2", 3: "v2", 4: "v3", 5: "v1"}


def _state(spark, n, keys=40):
    """Extract n: keys come, go and come back; puesto changes now and then (NULL among its values); vacaciones always."""
    rows = [(k, [None, "A", "B"][(k + n // 3) % 3], n) for k in range(keys) if (k * 5 + n // 2) % 4]
    return spark.createDataFrame(rows, SCHEMA), f"2024-01-{n + 1:02d} 00:00:00"


def test_history_at_once_equals_the_fold(spark):
    from brasa.operators.scd2 import history_at_once
    extracts = [_state(spark, n) for n in range(9)]
    extracts.append((extracts[0][0].limit(0), "2024-02-01 00:00:00"))       # everything vanishes
    extracts.append((extracts[3][0], "2024-02-02 00:00:00"))                # and some come back
    fold = build_history(extracts, "id_empleado", ["puesto"], materialize_every=4)
    at_once = history_at_once(extracts, "id_empleado", ["puesto"])
    assert at_once.columns == fold.columns
    assert sorted(map(repr, at_once.collect())) == sorted(map(repr, fold.collect()))


def test_history_at_once_of_a_hundred_extracts_is_one_shuffle(spark):
    from brasa.operators.scd2 import history_at_once
    base = spark.range(30).select(F.col("id").alias("id_empleado"))
    extracts = [(base.filter((F.col("id_empleado") + n // 7) % 5 != 0).select("id_empleado", F.lit(str(n // 30)).alias("puesto")),
                 f"{1950 + n}-01-01 00:00:00") for n in range(100)]
    history = history_at_once(extracts, "id_empleado", ["puesto"])
    assert history._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = []
    for k in range(30):
        open_ = None
        for n in range(100):
            there, post = (k + n // 7) % 5 != 0, str(n // 30)
            if there and open_ != post:
                want.append((k, post, 1950 + n, False))
                open_ = post
            elif not there and open_ is not None:
                want.append((k, open_, 1950 + n, True))
                open_ = None
    rows = history.collect()
    assert sorted((r.id_empleado, r.puesto, r.dbt_valid_from.year, r.dbt_is_deleted) for r in rows) == sorted(want)
    by_key = {}
    for r in sorted(rows, key=lambda r: (r.id_empleado, r.dbt_valid_from)):
        if r.id_empleado in by_key:
            assert by_key[r.id_empleado] == r.dbt_valid_from
        by_key[r.id_empleado] = r.dbt_valid_to
    assert set(by_key.values()) == {None}


def test_history_at_once_without_rows_or_keys_and_out_of_order(spark):
    import pytest
    from brasa.operators.scd2 import history_at_once
    empty = spark.createDataFrame([], SCHEMA)
    assert history_at_once([(empty, T1), (empty, T2)], "id_empleado", ["puesto"]).collect() == []
    keyless = spark.createDataFrame([(None, "A", 1), (1, "A", 1)], SCHEMA)
    assert [r.id_empleado for r in history_at_once([(keyless, T1)], "id_empleado", ["puesto"]).collect()] == [1]
    with pytest.raises(ValueError):
        history_at_once([(empty, T2), (empty, T1)], "id_empleado", ["puesto"])


def _versions(spark, rows):
    return spark.createDataFrame(rows, "empleado_key string, id_empleado bigint, f string, t string").select(
        "empleado_key", "id_empleado", F.col("f").cast("timestamp_ntz").alias("fecha_inicio_validez"),
        F.col("t").cast("timestamp_ntz").alias("fecha_fin_validez"))


def test_asof_by_order_equals_the_join(spark):
    from brasa.operators.asof import asof_by_order
    versions = _versions(spark, [
        ("a", 1, "1900-01-01 00:00:00", "2024-03-01 10:00:00"), ("b", 1, "2024-03-01 10:00:00", "2024-03-05 00:00:00"),
        ("c", 1, "2024-03-20 00:00:00", "2024-05-02 00:00:00"),         # a gap before it
        ("never", 1, "2024-05-02 00:00:00", "2024-05-02 00:00:00"), ("d", 1, "2024-05-02 00:00:00", None),
        ("e", 2, "2024-02-10 00:00:00", None), ("lost", None, "1900-01-01 00:00:00", None)])
    dates = ["1899-12-31", "1900-01-01", "2024-02-29", "2024-03-01", "2024-03-02", "2024-03-05", "2024-03-19", "2024-03-20",
             "2024-04-15", "2024-05-01", "2024-05-02", "2031-01-01", None]
    rows = [(i, d, "x") for i in (1, 2, 3, None) for d in dates for _ in range(2)]
    facts = spark.createDataFrame(rows, "id int, d string, _id string").withColumn("d", F.col("d").cast("date"))
    for default in ("-1", None):
        want = asof_join(facts, versions, "id", "d", "k", default=default)
        got = asof_by_order(facts, versions, "id", "d", "k", default=default)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert asof_by_order(facts.limit(0), versions, "id", "d", "k").collect() == []
    assert {r.k for r in asof_by_order(facts, versions.limit(0), "id", "d", "k").collect()} == {"-1"}


def test_asof_by_order_of_an_id_with_a_hundred_thousand_versions(spark):
    from brasa.operators.asof import asof_by_order
    n = 100_000                                                          # a version each hour
    hour = lambda i: F.timestamp_add("HOUR", i, F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
    versions = spark.range(n).select(F.col("id").cast("string").alias("empleado_key"), F.lit(7).alias("id_empleado"),
                                     hour(F.col("id").cast("int")).alias("fecha_inicio_validez"),
                                     hour((F.col("id") + 1).cast("int")).alias("fecha_fin_validez"))
    facts = spark.range(200_000).select("id", F.lit(7).alias("emp"), F.timestamp_add(
        "MINUTE", (F.col("id") * 31 % (n * 60)).cast("int"), F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")).alias("at"))
    found = asof_by_order(facts, versions, "emp", "at", "k")
    wrong = found.filter(F.col("k") != F.floor(F.col("id") * 31 % (n * 60) / 60).cast("string"))
    assert wrong.count() == 0 and found.count() == 200_000


def test_asof_is_hashed_by_id_at_every_size(spark):
    """Versions grow with the input: they are neither broadcast while they are few nor are facts sorted for them."""
    facts = spark.sql("select id as n, id % 7 as id, date'2024-01-05' as d from range(20)")
    versions = spark.sql("select id as id_empleado, concat('k', id) as empleado_key, timestamp_ntz'2024-01-01' as "
                         "fecha_inicio_validez, cast(null as timestamp_ntz) as fecha_fin_validez from range(5)")
    got = asof_join(facts, versions, "id", "d", "k")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan
    assert {(r.id, r.k) for r in got.collect()} == {(i, f"k{i}" if i < 5 else "-1") for i in range(7)}


def test_only_resolved_incidents_are_looked_up_by_resolver(spark):
    from brasa.functions.columns import ts_ntz
    from brasa.plans.facts import fact_incidencias
    from brasa.plans.staging import stg_incidents
    rows = [(1, "resuelta", "2", "2026-01-03"), (2, "resuelta", "9", "2026-01-03"), (3, "resuelta", None, "2026-01-03"),
            (4, "pendiente", "2", "2026-01-03"), (5, "resuelta", "2", None), (6, None, "2", "2026-01-03"), (6, None, "2", "2026-01-03")]
    src = spark.createDataFrame(rows, "ID_INCIDENCIA bigint, ESTADO string, RESULTA_POR string, u string").select(
        "ID_INCIDENCIA", "ESTADO", "RESULTA_POR", F.lit(1).alias("ID_EMPLEADO"), F.lit("vehiculo").alias("TIPO"),
        F.lit("alto").alias("NIVEL"), F.lit("2026-01-02").cast("date").alias("FECHA"), F.lit(0).alias("ID_PARQUE"),
        F.lit(None).cast("string").alias("MATRICULA"), F.lit(None).cast("string").alias("ID_EMPLEADO2"),
        F.lit(None).cast("string").alias("EQUIPO"), F.lit(True).alias("LEIDO"), F.lit(None).cast("string").alias("NOMBRE_EQUIPO"),
        ts_ntz("2026-01-02 00:00:00").alias("CREATED_AT"), F.col("u").cast("timestamp_ntz").alias("UPDATED_AT"),
        ts_ntz("2026-02-01 00:00:00").alias("_LOADED_AT"))
    versions = spark.sql("select id as id_empleado, concat('k', id) as empleado_key, timestamp_ntz'1900-01-01' as "
                         "fecha_inicio_validez, cast(null as timestamp_ntz) as fecha_fin_validez from range(5)")
    fact = fact_incidencias(stg_incidents(src), versions)
    got = sorted((r.id_incidencia, r.empleado_creador_key, r.empleado_resolutor_key) for r in fact.collect())
    assert got == [(1, "k1", "k2"), (2, "k1", "-1"), *[(i, "k1", None) for i in (3, 4, 5, 6, 6)]]
    joins = fact._jdf.queryExecution().optimizedPlan().toString()
    assert "UNION" in joins.upper() and joins.count("Join LeftOuter") == 2
