"""Fact tables (X1-X4): full build of a delta; incremental loading is in
``brasa.operators.incremental`` and ``Warehouse.incremental_fact``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brasa.functions.columns import indicator, surrogate_key
from brasa.operators.asof import asof_join
from brasa.operators.dedup import first_per_key

# Names of the brigades on duty service (day/night collapse).
DUTY_BRIGADE_NAMES = ("Brigada A", "Brigada B", "Brigada C", "Brigada D", "Brigada E", "Brigada F")

FACT_KEYS = {
    "fact_horas_extra": "horas_extra_key",
    "fact_solicitudes": "solicitud_key",
    "fact_asignaciones_operativas": "asignacion_key",
    "fact_asignaciones": "asignacion_key",
    "fact_incidencias": "incidencia_key",
}


def duty_brigade_per_day(stg_guards: DataFrame, stg_brigades: DataFrame) -> DataFrame:
    """Collapse same-named brigades per day, then keep the first name per day."""
    named = stg_guards.join(stg_brigades.select("id_brigada", "nombre_brigada"), "id_brigada", "left") \
                      .filter(F.col("nombre_brigada").isin(*DUTY_BRIGADE_NAMES))
    collapsed = named.groupBy("fecha", "nombre_brigada").agg(
        F.min("tipo_dia").alias("tipo_dia"), F.min("id_brigada").alias("id_brigada_guardia"))
    # first brigade name per day (names are unique per day after the collapse)
    return first_per_key(collapsed, ["fecha"], ["nombre_brigada"], columns=["fecha", "tipo_dia", "id_brigada_guardia"])


def fact_horas_extra(stg_extra_hours: DataFrame, stg_salaries: DataFrame, stg_guards: DataFrame,
                     stg_brigades: DataFrame, dim_emp: DataFrame) -> DataFrame:
    s = stg_salaries.select("id_salario", "tipo_salario", "precio_hora_diurna", "precio_hora_nocturna")
    # at most one duty row per calendar day: bounded by the days covered, safe to broadcast
    duty = F.broadcast(duty_brigade_per_day(stg_guards, stg_brigades))
    e = stg_extra_hours.join(s, "id_salario", "left").join(duty, "fecha", "left")
    day_cost = F.col("horas_diurnas").cast("decimal(38,0)") * F.col("precio_hora_diurna")
    night_cost = F.col("horas_nocturnas").cast("decimal(38,0)") * F.col("precio_hora_nocturna")
    e = e.select("*", F.coalesce(F.col("id_brigada_guardia"), F.lit(-1).cast("bigint")).alias("_brig"),
                 day_cost.cast("decimal(12,2)").alias("coste_diurno"),
                 night_cost.cast("decimal(12,2)").alias("coste_nocturno"),
                 (day_cost + night_cost).cast("decimal(12,2)").alias("coste_total"))
    e = asof_join(e, dim_emp, "id_empleado", "fecha", "empleado_key")
    return e.select(
        surrogate_key("id_hora_extra").alias("horas_extra_key"), "empleado_key",
        surrogate_key("fecha").alias("fecha_key"),
        F.when(F.col("_brig") == -1, F.lit("-1")).otherwise(surrogate_key("_brig")).alias("brigada_key"),
        F.when(F.col("id_salario").isNull(), F.lit("-1")).otherwise(surrogate_key("id_salario")).alias("salario_key"),
        "id_hora_extra", "id_empleado", "fecha", "id_salario", "horas_diurnas", "horas_nocturnas", "total_horas",
        "precio_hora_diurna", "precio_hora_nocturna", "coste_diurno", "coste_nocturno", "coste_total",
        "tipo_dia", "tipo_salario", "fecha_creacion", "fecha_actualizacion", "fecha_carga_bronze")


def assignments_per_request(stg_assignments: DataFrame) -> DataFrame:
    """Pre-aggregate the child table once (two counters, one scan) before joining."""
    return (stg_assignments.filter(F.col("id_solicitud").isNotNull()).groupBy("id_solicitud")
            .agg(F.count(F.lit(1)).alias("_n_asig"),
                 F.count(F.when(F.col("es_requerimiento"), F.lit(1))).alias("_n_req")))


def fact_solicitudes(stg_requests: DataFrame, stg_assignments: DataFrame, dim_emp: DataFrame) -> DataFrame:
    r = stg_requests.join(assignments_per_request(stg_assignments), "id_solicitud", "left")
    days = F.when(F.col("fecha_fin").isNotNull() & F.col("fecha_inicio").isNotNull(),
                  F.datediff(F.col("fecha_fin"), F.col("fecha_inicio")) + 1).otherwise(F.lit(1))
    r = r.select("*", F.coalesce(F.col("_n_asig"), F.lit(0)).cast("bigint").alias("total_asignaciones_generadas"),
                 F.coalesce(F.col("_n_req"), F.lit(0)).cast("bigint").alias("total_requerimientos_generados"),
                 days.cast("bigint").alias("dias_solicitados"))
    r = asof_join(r, dim_emp, "id_empleado", "fecha_inicio", "empleado_key")
    return r.select(
        surrogate_key("id_solicitud").alias("solicitud_key"), "empleado_key",
        F.when(F.col("fecha_inicio").isNotNull(), surrogate_key("fecha_inicio")).alias("fecha_inicio_key"),
        F.when(F.col("fecha_fin").isNotNull(), surrogate_key("fecha_fin")).alias("fecha_fin_key"),
        "id_solicitud", "id_empleado", "id_empleado_gestor", "tipo_permiso", "turno", "estado",
        "fecha_inicio", "fecha_fin", "horas_solicitadas", "dias_solicitados",
        "total_asignaciones_generadas", "total_requerimientos_generados",
        "fecha_creacion", "fecha_actualizacion", "fecha_carga_bronze")


def _key_or_null(col: str):
    return F.when(F.col(col).isNotNull(), surrogate_key(col))


def fact_asignaciones(stg_assignments: DataFrame, dim_emp: DataFrame) -> DataFrame:
    a = asof_join(stg_assignments, dim_emp, "id_empleado", "fecha_inicio", "empleado_key")
    return a.select(
        surrogate_key("id_asignacion").alias("asignacion_key"), "empleado_key",
        surrogate_key("fecha_inicio").alias("fecha_key"),
        _key_or_null("id_brigada_origen").alias("brigada_origen_key"),
        surrogate_key("id_brigada_destino").alias("brigada_destino_key"),
        _key_or_null("id_solicitud").alias("solicitud_key"),
        _key_or_null("id_cambio_guardia").alias("cambio_guardia_key"),
        "id_asignacion", "id_empleado", "id_brigada_origen", "id_brigada_destino", "id_solicitud",
        "id_cambio_guardia", "id_traslado", "fecha_inicio", "turno", "tipo_asignacion", "es_requerimiento",
        F.lit(1).cast("bigint").alias("total_asignaciones"),
        indicator(F.col("es_requerimiento")).cast("bigint").alias("total_requerimientos"),
        indicator(F.col("tipo_asignacion") == "ida").cast("bigint").alias("total_idas"),
        indicator(F.col("tipo_asignacion") == "vuelta").cast("bigint").alias("total_vueltas"),
        "fecha_creacion", "fecha_actualizacion", "fecha_carga_bronze")


def fact_incidencias(stg_incidents: DataFrame, dim_emp: DataFrame) -> DataFrame:
    resolved_at = F.when((F.col("estado") == "resuelta") & F.col("id_empleado_resolutor").isNotNull(),
                         F.col("fecha_actualizacion"))
    i = stg_incidents.withColumn("fecha_efecto_resolutor", resolved_at)
    # only resolved incidents are looked up, and so shuffled, by their resolver; first, before they have a key of the creator
    resolved = F.col("fecha_efecto_resolutor").isNotNull()
    i = asof_join(i.filter(resolved), dim_emp, "id_empleado_resolutor", "fecha_efecto_resolutor", "_resolver_key").unionByName(
        i.filter(~resolved).withColumn("_resolver_key", F.lit(None).cast("string")))
    i = asof_join(i, dim_emp, "id_empleado_creador", "fecha_incidencia", "empleado_creador_key")
    resolver = F.when(F.col("id_empleado_resolutor").isNotNull() & F.col("fecha_efecto_resolutor").isNotNull(),
                      F.col("_resolver_key"))
    state = F.col("estado")
    return i.select(
        surrogate_key("id_incidencia").alias("incidencia_key"), "empleado_creador_key",
        resolver.alias("empleado_resolutor_key"), surrogate_key("fecha_incidencia").alias("fecha_key"),
        surrogate_key("id_parque").alias("parque_key"),
        _key_or_null("matricula_vehiculo").alias("vehiculo_key"), _key_or_null("id_equipo").alias("equipo_key"),
        "id_incidencia", "id_empleado_creador", "id_empleado_resolutor", "id_empleado_referenciado",
        "fecha_incidencia", "id_parque", "matricula_vehiculo", "id_equipo", "nombre_equipo_comun",
        "tipo_incidencia", "estado", "nivel_gravedad", "esta_leido", "dias_resolucion",
        indicator(state == "resuelta").cast("bigint").alias("es_resuelta"),
        indicator(state == "pendiente").cast("bigint").alias("es_pendiente"),
        indicator(state == "tramitada").cast("bigint").alias("es_tramitada"),
        "fecha_creacion", "fecha_actualizacion", "fecha_carga_bronze")
