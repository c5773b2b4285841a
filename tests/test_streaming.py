"""The micro-batch fact load ends with the same table as one full build."""

import tempfile

from pyspark.sql import functions as F

from brasa.registry import warehouse
from brasa.sources.bronze import Bronze
from brasa.streaming import start_fact_stream
from conftest import SF_SMALL


def test_stream_of_incident_files_equals_full_build(spark):
    bronze = Bronze(spark, SF_SMALL).table("incidents")
    src = tempfile.mkdtemp(prefix="brasa-stream-src-")
    # three arrival files: by creation day, so every row arrives once
    day = F.dayofmonth("CREATED_AT")
    for i, cond in enumerate([day <= 10, (day > 10) & (day <= 20), day > 20]):
        bronze.filter(cond).write.mode("overwrite").parquet(f"{src}/part={i}")
    w = warehouse(spark, SF_SMALL)
    from brasa.plans.staging import stg_incidents
    schema = spark.read.parquet(f"{src}/part=0").schema
    state, query = start_fact_stream(spark, f"{src}/*", schema, lambda b: w.fact_incidencias(stg_incidents(b)),
                                     "incidents_stream", "incidencia_key", "fecha_incidencia", root=f"{src}-root")
    query.awaitTermination(300)
    streamed = state.table()
    full = w.fact_incidencias()
    assert streamed.count() == full.count()
    assert streamed.exceptAll(full.select(*streamed.columns)).count() == 0


def _start(spark, src, root):
    schema = "k int, d date, v string, u timestamp_ntz"
    state, query = start_fact_stream(spark, f"{src}/*", schema, lambda b: b, "restart", "k", "d", "u", root=root)
    query.awaitTermination(300)
    return state


def _arrive(spark, src, n, rows):
    spark.createDataFrame(rows, "k int, d string, v string, u string").select(
        "k", F.col("d").cast("date").alias("d"), "v", F.col("u").cast("timestamp_ntz").alias("u")).coalesce(1).write.parquet(f"{src}/part={n}")


def test_stream_goes_on_after_a_restart(spark):
    src = tempfile.mkdtemp(prefix="brasa-restart-")
    root = f"{src}-root"
    _arrive(spark, src, 0, [(1, "2024-01-01", "a", "2024-01-05"), (2, "2024-01-02", "b", None), (3, None, "c", "2024-01-01")])
    assert _start(spark, src, root).table().count() == 3
    # an older row, one without update time, a newer one and a new key arrive after the stop
    _arrive(spark, src, 1, [(1, "2024-02-01", "old", "2024-01-04"), (3, "2024-02-01", "new", "2024-01-02"), (4, "2024-02-01", "d", None)])
    _arrive(spark, src, 2, [(1, "2024-02-01", "unstamped", None), (2, "2024-01-02", "stamped", "2024-01-01")])
    state = _start(spark, src, root)
    want = {(1, "a"), (2, "stamped"), (3, "new"), (4, "d")}
    assert {(r.k, r.v) for r in state.table().collect()} == want and state.table().count() == 4
    again = _start(spark, src, root)                       # nothing new
    assert {(r.k, r.v) for r in again.table().collect()} == want


def test_files_of_an_arrival_are_one_batch(spark):
    src = tempfile.mkdtemp(prefix="brasa-arrival-")
    rows = [(i, f"2024-01-{i % 28 + 1:02d}", "a", "2024-02-01") for i in range(40)]
    for n in range(2):
        _arrive_in_files(spark, src, n, [(k + 20 * n, *rest) for k, *rest in rows], 5)
        state, query = start_fact_stream(spark, f"{src}/*", "k int, d date, v string, u timestamp_ntz", lambda b: b, "arrival",
                                         "k", "d", "u", max_files_per_trigger=None, root=f"{src}-root")
        query.awaitTermination(300)
        assert state._months()._last_commit() == n + 1             # a merge, so a rewritten month, for each arrival
    assert sorted(r.k for r in state.table().collect()) == list(range(60))


def _arrive_in_files(spark, src, n, rows, files):
    spark.createDataFrame(rows, "k int, d string, v string, u string").select(
        "k", F.col("d").cast("date").alias("d"), "v", F.col("u").cast("timestamp_ntz").alias("u")).repartition(
        files).write.parquet(f"{src}/part={n}")
