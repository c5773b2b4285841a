"""Staging models: rename, type and clean one bronze table each (B1-B12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brasa.functions.columns import clean_text, date_lit, safe_number, trim_null

# Staging rules of the operational sources.
DATE_FLOOR = "2020-01-01"       # rows dated before this are corrupt extracts
RESOLUTION_MAX_DAYS = 3650      # longest plausible resolution time
POSTS_TROPA = ("conductor", "operador", "bombero")
POSTS_MANDO = ("subinspector", "oficial")
SERVICE_BRIGADES = ("A", "B", "C", "D", "E", "F")


def audit_columns() -> list[Column]:
    return [F.col("CREATED_AT").cast("timestamp_ntz").alias("fecha_creacion"),
            F.col("UPDATED_AT").cast("timestamp_ntz").alias("fecha_actualizacion"),
            F.col("_LOADED_AT").cast("timestamp_ntz").alias("fecha_carga_bronze")]


def _id(name: str) -> Column:
    return F.col(name).cast("bigint")


def post_category(normalised: Column) -> Column:
    return (F.when(normalised.isin(*POSTS_TROPA), F.lit("Tropa"))
            .when(normalised.isin(*POSTS_MANDO), F.lit("Mando"))
            .when(normalised.isNull(), F.lit("Administrativo"))
            .otherwise(F.lit("Desconocido")))


def stg_users(users: DataFrame) -> DataFrame:
    return users.select(
        _id("ID_EMPLEADO").alias("id_empleado"), F.col("NOMBRE").alias("nombre_token"),
        clean_text("TYPE").alias("tipo_usuario"), F.trim(F.col("PUESTO")).alias("puesto"),
        F.coalesce(F.col("AP"), F.lit(0)).cast("bigint").alias("dias_asuntos_propios"),
        F.coalesce(F.col("VACACIONES"), F.lit(0)).cast("bigint").alias("dias_vacaciones"),
        F.coalesce(F.col("MODULO"), F.lit(0)).cast("bigint").alias("dias_modulo"),
        F.coalesce(F.col("SP"), F.lit(0)).cast("bigint").alias("salidas_personales"),
        F.coalesce(F.col("COMPENSACION_GRUPOS"), F.lit(0)).cast("bigint").alias("dias_compensacion_grupos"),
        F.coalesce(F.col("HORAS_SINDICALES"), F.lit(0)).cast("bigint").alias("horas_sindicales"),
        F.coalesce(F.col("MANDO_ESPECIAL"), F.lit(False)).alias("es_mando_especial"),
        F.col("CREATED_AT").cast("timestamp_ntz").alias("fecha_creacion"),
        F.col("UPDATED_AT").cast("timestamp_ntz").alias("fecha_actualizacion"),
        post_category(clean_text("PUESTO")).alias("categoria_puesto"),
    )


def stg_parks(parks: DataFrame) -> DataFrame:
    return parks.select(_id("ID_PARQUE").alias("id_parque"), trim_null("NOMBRE").alias("nombre_parque"),
                        trim_null("UBICACION").alias("ubicacion"))


def stg_brigades(brigades: DataFrame) -> DataFrame:
    return brigades.select(
        _id("ID_BRIGADA").alias("id_brigada"), _id("ID_PARQUE").alias("id_parque"),
        trim_null("NOMBRE").alias("nombre_brigada"),
        F.coalesce(F.col("ESPECIAL"), F.lit(False)).alias("es_especial"),
        F.coalesce(F.upper(trim_null("NOMBRE")).isin(*SERVICE_BRIGADES), F.lit(False)).alias("es_brigada_servicio"),
    )


def stg_extra_hours(extra_hours: DataFrame) -> DataFrame:
    out = extra_hours.filter(F.col("DATE").cast("date") >= date_lit(DATE_FLOOR)).select(
        _id("ID").alias("id_hora_extra"), F.col("DATE").cast("date").alias("fecha"),
        _id("ID_EMPLEADO").alias("id_empleado"), _id("ID_SALARIO").alias("id_salario"),
        F.coalesce(F.col("HORAS_DIURNAS"), F.lit(0)).cast("bigint").alias("horas_diurnas"),
        F.coalesce(F.col("HORAS_NOCTURNAS"), F.lit(0)).cast("bigint").alias("horas_nocturnas"),
        *audit_columns(),
    )
    return out.withColumn("total_horas", F.col("horas_diurnas") + F.col("horas_nocturnas"))


def stg_salaries(salaries: DataFrame) -> DataFrame:
    return salaries.select(
        _id("ID_SALARIO").alias("id_salario"), F.col("FECHA_INI").cast("date").alias("fecha_vigencia"),
        trim_null("TIPO").alias("tipo_salario"),
        F.col("PRECIO_DIURNO").cast("decimal(10,2)").alias("precio_hora_diurna"),
        F.col("PRECIO_NOCTURNO").cast("decimal(10,2)").alias("precio_hora_nocturna"),
        F.coalesce(F.col("HORAS_DIURNAS"), F.lit(0)).cast("bigint").alias("horas_diurnas_jornada"),
        F.coalesce(F.col("HORAS_NOCTURNAS"), F.lit(0)).cast("bigint").alias("horas_nocturnas_jornada"),
    )


def stg_guards(guards: DataFrame) -> DataFrame:
    return guards.select(
        _id("ID").alias("id_guardia"), F.col("DATE").cast("date").alias("fecha"),
        _id("ID_BRIGADA").alias("id_brigada"), _id("ID_PARQUE").alias("id_parque"),
        _id("ID_SALARIO").alias("id_salario"), clean_text("TIPO").alias("tipo_dia"),
        trim_null("ESPECIALES").alias("tipo_especial"), *audit_columns(),
    )


def stg_requests(requests: DataFrame) -> DataFrame:
    start = F.col("FECHA_INI").cast("date")
    return requests.filter(F.col("FECHA_INI").isNull() | (start >= date_lit(DATE_FLOOR))).select(
        _id("ID").alias("id_solicitud"), _id("ID_EMPLEADO").alias("id_empleado"),
        _id("ID_EMPLEADO2").alias("id_empleado_gestor"), clean_text("TIPO").alias("tipo_permiso"),
        start.alias("fecha_inicio"), F.col("FECHA_FIN").cast("date").alias("fecha_fin"),
        F.coalesce(F.col("HORAS"), F.lit(0)).cast("bigint").alias("horas_solicitadas"),
        clean_text("TURNO").alias("turno"), clean_text("ESTADO").alias("estado"), *audit_columns(),
    )


def stg_shift_changes(changes: DataFrame) -> DataFrame:
    return changes.select(
        _id("ID").alias("id_cambio"), _id("ID_EMPLEADO1").alias("id_empleado_solicitante"),
        _id("ID_EMPLEADO2").alias("id_empleado_receptor"), _id("ID_EMPLEADO3").alias("id_empleado_aprobador"),
        _id("BRIGADA1").alias("id_brigada_solicitante"), _id("BRIGADA2").alias("id_brigada_receptor"),
        F.col("FECHA").cast("date").alias("fecha_cambio"), F.col("FECHA2").cast("date").alias("fecha_cambio_espejo"),
        clean_text("ESTADO").alias("estado"), clean_text("TURNO").alias("turno"), *audit_columns(),
    )


def stg_assignments(assignments: DataFrame) -> DataFrame:
    out = assignments.select(
        _id("ID_ASIGNACION").alias("id_asignacion"), F.col("FECHA_INI").cast("date").alias("fecha_inicio"),
        _id("ID_EMPLEADO").alias("id_empleado"), _id("ID_BRIGADA_ORIGEN").alias("id_brigada_origen"),
        _id("ID_BRIGADA_DESTINO").alias("id_brigada_destino"), clean_text("TURNO").alias("turno"),
        _id("ID_REQUEST").alias("id_solicitud"), _id("ID_CHANGE_REQUEST").alias("id_cambio_guardia"),
        F.coalesce(F.col("REQUERIMIENTO"), F.lit(False)).alias("es_requerimiento"),
        clean_text("TIPO_ASIGNACION").alias("tipo_asignacion"), _id("ID_TRANSFER").alias("id_traslado"),
        *audit_columns(),
    )
    return out.filter(F.col("fecha_inicio") >= date_lit(DATE_FLOOR))


def resolution_days(state: Column, created: Column, updated: Column,
                    max_days: int = RESOLUTION_MAX_DAYS, floor_date: str = DATE_FLOOR,
                    resolved: str = "resuelta") -> Column:
    """Days from creation to resolution, only for resolved rows with sane dates."""
    days = F.datediff(updated, created)
    floor = date_lit(floor_date).cast("timestamp_ntz")
    ok = ((state == resolved) & created.isNotNull() & updated.isNotNull()
          & (created >= floor) & (updated >= floor) & days.between(0, max_days))
    return F.when(ok, days).cast("bigint")


def stg_incidents(incidents: DataFrame) -> DataFrame:
    out = incidents.select(
        _id("ID_INCIDENCIA").alias("id_incidencia"), _id("ID_EMPLEADO").alias("id_empleado_creador"),
        clean_text("TIPO").alias("tipo_incidencia"), clean_text("ESTADO").alias("estado"),
        clean_text("NIVEL").alias("nivel_gravedad"), F.col("FECHA").cast("date").alias("fecha_incidencia"),
        _id("ID_PARQUE").alias("id_parque"), trim_null("MATRICULA").alias("matricula_vehiculo"),
        safe_number("ID_EMPLEADO2").cast("bigint").alias("id_empleado_referenciado"),
        safe_number("EQUIPO").cast("bigint").alias("id_equipo"),
        safe_number("RESULTA_POR").cast("bigint").alias("id_empleado_resolutor"),
        F.coalesce(F.col("LEIDO"), F.lit(False)).alias("esta_leido"),
        trim_null("NOMBRE_EQUIPO").alias("nombre_equipo_comun"), *audit_columns(),
    )
    return out.withColumn("dias_resolucion", resolution_days(
        F.col("estado"), F.col("fecha_creacion"), F.col("fecha_actualizacion")))


def stg_vehicles(vehicles: DataFrame) -> DataFrame:
    return vehicles.select(
        trim_null("MATRICULA").alias("matricula_token"), trim_null("NOMBRE").alias("nombre_vehiculo"),
        safe_number("ID_PARQUE").cast("bigint").alias("id_parque"), clean_text("TIPO").alias("tipo_vehiculo"),
        safe_number("ANO").cast("bigint").alias("anio_vehiculo"), *audit_columns(),
    )


def stg_equipment(equipment: DataFrame) -> DataFrame:
    return equipment.select(
        _id("ID").alias("id_equipo"), trim_null("NOMBRE").alias("nombre_equipo"),
        clean_text("CATEGORIA").alias("categoria_equipo"),
        F.coalesce(F.col("DISPONIBLE"), F.lit(False)).alias("esta_disponible"),
        safe_number("PARQUE").cast("bigint").alias("id_parque"), *audit_columns(),
    )


STAGING = {
    "users": stg_users, "parks": stg_parks, "brigades": stg_brigades,
    "extra_hours": stg_extra_hours, "salaries": stg_salaries, "guards": stg_guards,
    "requests": stg_requests, "shift_change_requests": stg_shift_changes,
    "firefighters_assignments": stg_assignments, "incidents": stg_incidents,
    "vehicles": stg_vehicles, "equipos_personales": stg_equipment,
}
