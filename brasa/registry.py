"""Every registered query: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from brasa.plans.analytics import AS_OF
from brasa.plans.model import Warehouse

QueryFn = Callable[[SparkSession, str], DataFrame]
_WAREHOUSES: dict[tuple[str, int, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One warehouse (and one set of materialised gold tables) per live session and dataset."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"))
    cached = _WAREHOUSES.get(key)
    if cached is None or cached.spark is not spark:
        cached = _WAREHOUSES[key] = Warehouse(spark, sf_dir)
    return cached


def _w(fn: Callable[[Warehouse], DataFrame]) -> QueryFn:
    return lambda spark, sf_dir: fn(warehouse(spark, sf_dir))


MODEL_QUERIES: dict[str, QueryFn] = {
    "b1_stg_users": _w(lambda w: w.stg("users")),
    "b2_stg_parks": _w(lambda w: w.stg("parks")),
    "b3_stg_brigades": _w(lambda w: w.stg("brigades")),
    "b4_stg_extra_hours": _w(lambda w: w.stg("extra_hours")),
    "b5_stg_salaries": _w(lambda w: w.stg("salaries")),
    "b6_stg_guards": _w(lambda w: w.stg("guards")),
    "b7_stg_requests": _w(lambda w: w.stg("requests")),
    "b8_stg_shift_changes": _w(lambda w: w.stg("shift_change_requests")),
    "b9_stg_assignments": _w(lambda w: w.stg("firefighters_assignments")),
    "b10_stg_incidents": _w(lambda w: w.stg("incidents")),
    "b11_stg_vehicles": _w(lambda w: w.stg("vehicles")),
    "b12_stg_equipment": _w(lambda w: w.stg("equipos_personales")),
    "h1_snp_empleado": _w(lambda w: w.snp_empleado),
    "d2_dim_fecha": _w(lambda w: w.dim_fecha),
    "d3_dim_parque": _w(lambda w: w.dim_parque()),
    "d4_dim_brigada": _w(lambda w: w.dim_brigada()),
    "d5_dim_equipo": _w(lambda w: w.dim_equipo()),
    "d6_dim_vehiculo": _w(lambda w: w.dim_vehiculo()),
    "d7_dim_puesto": _w(lambda w: w.dim_puesto()),
    "d8_dim_salario": _w(lambda w: w.dim_salario()),
    "d9_dim_empleado": _w(lambda w: w.dim_empleado),
    "x1_fact_horas_extra": _w(lambda w: w.fact_horas_extra()),
    "x2_fact_solicitudes": _w(lambda w: w.fact_solicitudes()),
    "x3_fact_asignaciones": _w(lambda w: w.fact_asignaciones()),
    "x4_fact_incidencias": _w(lambda w: w.fact_incidencias()),
    "v1_overtime_seasonality": _w(lambda w: w.v1()),
    "v2_overtime_by_day_type": _w(lambda w: w.v2()),
    "v3_overtime_brigade_ranking": _w(lambda w: w.v3()),
    "v4_overtime_employee_ranking": _w(lambda w: w.v4()),
    "v5_request_seasonality": _w(lambda w: w.v5()),
    "v6_leave_type_management": _w(lambda w: w.v6()),
    "v7_request_employee_ranking": _w(lambda w: w.v7()),
    "v8_daily_pressure": _w(lambda w: w.v8()),
    "v9_resolution_efficiency": _w(lambda w: w.v9()),
    "v10_resolver_ranking": _w(lambda w: w.v10()),
    "v11_top_vehicles": _w(lambda w: w.v11()),
    "v12_top_equipment": _w(lambda w: w.v12()),
    "v13_bottlenecks": _w(lambda w: w.v13(AS_OF)),
}


def all_queries() -> dict[str, QueryFn]:
    from brasa.operator_queries import OPERATOR_QUERIES

    out = dict(MODEL_QUERIES)
    out.update(OPERATOR_QUERIES)
    return out
