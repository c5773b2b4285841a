"""The warehouse over one dataset directory: every model as a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brasa.plans import analytics as A
from brasa.plans import dimensions as D
from brasa.plans import facts as X
from brasa.plans.staging import STAGING
from brasa.sources.bronze import USER_EXTRACT_TIMES, Bronze


class Warehouse:
    """All models over one dataset directory.

    Like the reference layout, staging models and analytical views are lazy
    (views), while the history, dimensions and facts are materialised tables:
    each is written once to the shared work folder (parquet) and read back,
    so every view reads compact gold tables instead of re-deriving them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.bronze = Bronze(spark, sf_dir)
        self.materialize = materialize
        self._tables: dict[str, DataFrame] = {}
        self._views: dict[str, object] = {}

    # facts are clustered by the date their views filter on, then by the unique key
    CLUSTER = {"fact_horas_extra": ("fecha", "id_hora_extra"), "fact_solicitudes": ("fecha_inicio", "id_solicitud"),
               "fact_asignaciones": ("fecha_inicio", "id_asignacion"),
               "fact_incidencias": ("fecha_incidencia", "id_incidencia")}

    def _table(self, name: str, build) -> DataFrame:
        if not self.materialize:
            return build()
        if name not in self._tables:
            from brasa.operators.incremental import publish
            from brasa.plans.contracts import NOT_NULL, contract

            # held against its contract while it is written; a broken table is not published
            self._tables[name] = publish(self.spark, build(), name, self.CLUSTER.get(name, ()),
                                         contract(name) if name in NOT_NULL else None)
        return self._tables[name]

    def gold(self, name: str) -> DataFrame:
        """A dimension or fact by its name."""
        table = getattr(self, name)
        return table if isinstance(table, DataFrame) else table()

    # staging (lazy views; the DataFrame objects are built once and reused)
    def stg(self, name: str) -> DataFrame:
        key = f"stg:{name}"
        if key not in self._views:
            self._views[key] = STAGING[name](self.bronze.table(name))
        return self._views[key]

    def user_extracts(self) -> list[tuple[DataFrame, str]]:
        if "extracts" not in self._views:
            self._views["extracts"] = [(STAGING["users"](self.bronze.table("users", v)), at)
                                       for v, at in enumerate(USER_EXTRACT_TIMES, start=1)]
        return self._views["extracts"]

    # history and dimensions
    @property
    def snp_empleado(self) -> DataFrame:
        return self._table("snp_empleado", lambda: D.snp_empleado(self.user_extracts()))

    @property
    def dim_empleado(self) -> DataFrame:
        return self._table("dim_empleado", lambda: D.dim_empleado(self.spark, self.snp_empleado))

    @property
    def dim_time(self) -> DataFrame:
        return self._table("dim_time", lambda: D.dim_time(self.spark))

    @property
    def dim_fecha(self) -> DataFrame:
        return self._table("dim_fecha", lambda: D.dim_fecha(self.dim_time, self.stg("guards")))

    def dim_parque(self) -> DataFrame:
        return self._table("dim_parque", lambda: D.dim_parque(self.spark, self.stg("parks")))

    def dim_brigada(self) -> DataFrame:
        return self._table("dim_brigada", lambda: D.dim_brigada(self.spark, self.stg("brigades"), self.stg("parks")))

    def dim_equipo(self) -> DataFrame:
        return self._table("dim_equipo",
                           lambda: D.dim_equipo(self.spark, self.stg("equipos_personales"), self.stg("parks")))

    def dim_vehiculo(self) -> DataFrame:
        return self._table("dim_vehiculo", lambda: D.dim_vehiculo(self.spark, self.stg("vehicles"), self.stg("parks")))

    def dim_puesto(self) -> DataFrame:
        return self._table("dim_puesto", lambda: D.dim_puesto(self.stg("users")))

    def dim_salario(self) -> DataFrame:
        return self._table("dim_salario", lambda: D.dim_salario(self.stg("salaries")))

    # facts (full build from a staging frame; the default is the whole source)
    def fact_horas_extra(self, source: DataFrame | None = None) -> DataFrame:
        build = lambda src: X.fact_horas_extra(src, self.stg("salaries"), self.stg("guards"),
                                               self.stg("brigades"), self.dim_empleado)
        if source is not None:
            return build(source)
        return self._table("fact_horas_extra", lambda: build(self.stg("extra_hours")))

    def fact_solicitudes(self, source: DataFrame | None = None) -> DataFrame:
        build = lambda src: X.fact_solicitudes(src, self.stg("firefighters_assignments"), self.dim_empleado)
        if source is not None:
            return build(source)
        return self._table("fact_solicitudes", lambda: build(self.stg("requests")))

    def fact_asignaciones(self, source: DataFrame | None = None) -> DataFrame:
        build = lambda src: X.fact_asignaciones(src, self.dim_empleado)
        if source is not None:
            return build(source)
        return self._table("fact_asignaciones", lambda: build(self.stg("firefighters_assignments")))

    def fact_incidencias(self, source: DataFrame | None = None) -> DataFrame:
        build = lambda src: X.fact_incidencias(src, self.dim_empleado)
        if source is not None:
            return build(source)
        return self._table("fact_incidencias", lambda: build(self.stg("incidents")))

    # incremental refresh (the daily job): look-back delta of the staging model, merged by unique key
    FACT_SOURCES = {"fact_horas_extra": "extra_hours", "fact_solicitudes": "requests",
                    "fact_asignaciones": "firefighters_assignments", "fact_incidencias": "incidents"}

    # the leave-request fact takes MAX(update time) without a default: an empty target never loads
    EMPTY_DEFAULT = {"fact_solicitudes": None}

    def refresh_fact(self, name: str, target: DataFrame | None, lookback_days: int = 7,
                     empty_default: str | None = "1900-01-01 00:00:00") -> DataFrame:
        """Merge the rows updated since (target high-water mark - look-back) into ``target``.

        ``target=None`` is the first (full) build.  ``empty_default=None`` reproduces the
        variant whose empty target never loads (no default on the high-water mark).
        The result is published to a fresh folder in the shared work area.
        """
        from brasa.operators.incremental import lookback_delta, publish, upsert
        from brasa.plans.facts import FACT_KEYS

        source = self.stg(self.FACT_SOURCES[name])
        empty_default = self.EMPTY_DEFAULT.get(name, empty_default)
        delta = lookback_delta(source, target, "fecha_actualizacion", lookback_days, empty_default)
        rows = getattr(self, name)(delta)
        return publish(self.spark, upsert(target, rows, FACT_KEYS[name], "fecha_actualizacion"), f"{name}_refresh",
                       self.CLUSTER.get(name, ()))

    def refresh_fact_partitioned(self, name: str, table_path: str, lookback_days: int = 7) -> DataFrame:
        """Daily refresh of a month-partitioned fact table: only the months touched are rewritten."""
        from brasa.operators.incremental import MonthTable, lookback_delta
        from brasa.plans.contracts import contract
        from brasa.plans.facts import FACT_KEYS

        table = MonthTable(self.spark, table_path, FACT_KEYS[name], self.CLUSTER[name][0], "fecha_actualizacion",
                           contract(name))
        delta = lookback_delta(self.stg(self.FACT_SOURCES[name]), table.read(), "fecha_actualizacion", lookback_days,
                               self.EMPTY_DEFAULT.get(name, "1900-01-01 00:00:00"))
        return table.merge(getattr(self, name)(delta))

    # employee history as stored tables: guarded bootstrap, then one snapshot per new extract
    def bootstrap_employee_history(self, path: str, force: bool = False) -> DataFrame:
        """History starting at 1900-01-01 from the current users; refuses a non-empty table unless forced."""
        from brasa.operators.incremental import guarded_create
        from brasa.operators.scd2 import bootstrap_history

        first = self.stg("users").select(*D.SNAPSHOT_COLS)
        return guarded_create(self.spark, bootstrap_history(first, "id_empleado", D.HISTORY_START), path, force)

    def snapshot_employees(self, history: DataFrame, extract: DataFrame, at: str) -> DataFrame:
        """Apply one staged users extract taken at ``at`` and publish the new history."""
        from brasa.operators.incremental import publish
        from brasa.operators.scd2 import scd2_apply

        new = scd2_apply(history, extract.select(*D.SNAPSHOT_COLS), "id_empleado", D.EMPLOYEE_CHECK_COLS, at)
        return publish(self.spark, new, "snp_empleado")

    def build(self, root: str | None = None) -> DataFrame:
        """The daily build: history and dimensions materialised in dependency order, the facts merged into their month
        tables under ``root``, then the data tests of the gold tables as one report.

        A build on the same root merges the look-back delta of each fact and rewrites only the months that it touches;
        without a root the tables are new ones in the work folder.
        """
        from brasa.session import new_table_path
        from brasa.operators.quality import Check, quality_report
        from brasa.plans.contracts import EXPRESSION_TESTS, expression_test_name

        for dim in ("dim_parque", "dim_brigada", "dim_equipo", "dim_vehiculo", "dim_puesto", "dim_salario"):
            getattr(self, dim)()
        _ = (self.snp_empleado, self.dim_empleado, self.dim_time, self.dim_fecha)
        root = (root or new_table_path(self.spark, "gold")).rstrip("/")
        facts = {name: self.refresh_fact_partitioned(name, f"{root}/{name}") for name in self.FACT_SOURCES}
        self._tables.update(facts)  # what the views read from now on
        checks = [Check(expression_test_name(t, e, w), t, "expression", expression=e, where=w, severity=sev)
                  for t, e, w, sev in EXPRESSION_TESTS if t in facts]
        return quality_report(checks, facts)

    # analytical views
    def v1(self): return A.v1_overtime_seasonality(self.fact_horas_extra())
    def v2(self): return A.v2_overtime_by_day_type(self.fact_horas_extra(), self.dim_fecha)
    def v3(self): return A.v3_overtime_brigade_ranking(self.fact_horas_extra(), self.dim_brigada())
    def v4(self): return A.v4_overtime_employee_ranking(self.fact_horas_extra(), self.dim_empleado)
    def v5(self): return A.v5_request_seasonality(self.fact_solicitudes())
    def v6(self): return A.v6_leave_type_management(self.fact_solicitudes())
    def v7(self): return A.v7_request_employee_ranking(self.fact_solicitudes(), self.dim_empleado)

    def v8(self):
        return A.v8_daily_pressure(self.fact_solicitudes(), self.fact_asignaciones(), self.dim_fecha)

    def v9(self): return A.v9_resolution_efficiency(self.fact_incidencias())
    def v10(self): return A.v10_resolver_ranking(self.fact_incidencias(), self.dim_empleado, self.dim_parque())
    def v11(self): return A.v11_top_vehicles(self.fact_incidencias(), self.dim_vehiculo())
    def v12(self): return A.v12_top_equipment(self.fact_incidencias(), self.dim_equipo())

    def v13(self, as_of: str | None = None):
        return A.v13_bottlenecks(self.fact_incidencias(), self.dim_empleado, self.dim_parque(),
                                 self.dim_vehiculo(), self.dim_equipo(), as_of)
