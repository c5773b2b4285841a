"""Schema contracts of the gold tables (names, types, not-null constraints)."""

from functools import partial

from pyspark.sql.types import (DateType, DecimalType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from brasa.operators.quality import Contract


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Declared contract of the overtime fact.
FACT_HORAS_EXTRA = _s(
    ("horas_extra_key", StringType()), ("empleado_key", StringType()), ("fecha_key", StringType()),
    ("brigada_key", StringType()), ("salario_key", StringType()), ("id_hora_extra", LongType()),
    ("id_empleado", LongType()), ("fecha", DateType()), ("id_salario", LongType()),
    ("horas_diurnas", LongType()), ("horas_nocturnas", LongType()), ("total_horas", LongType()),
    ("precio_hora_diurna", DecimalType(10, 2)), ("precio_hora_nocturna", DecimalType(10, 2)),
    ("coste_diurno", DecimalType(12, 2)), ("coste_nocturno", DecimalType(12, 2)),
    ("coste_total", DecimalType(12, 2)), ("tipo_dia", StringType()), ("tipo_salario", StringType()),
    ("fecha_creacion", TimestampNTZType()), ("fecha_actualizacion", TimestampNTZType()),
    ("fecha_carga_bronze", TimestampNTZType()),
)
FACT_HORAS_EXTRA_NOT_NULL = ("horas_extra_key", "empleado_key")

# Columns that are never NULL, by table
NOT_NULL = {
    "dim_time": ("date_day",), "dim_fecha": ("fecha_key", "fecha"), "dim_parque": ("parque_key", "id_parque"),
    "dim_brigada": ("brigada_key", "id_brigada"), "dim_equipo": ("equipo_key", "id_equipo"),
    "dim_vehiculo": ("vehiculo_key", "matricula_token"), "dim_puesto": ("puesto_key", "nombre_puesto"),
    "dim_salario": ("salario_key", "id_salario"), "dim_empleado": ("empleado_key", "id_empleado", "fecha_inicio_validez"),
    "fact_horas_extra": FACT_HORAS_EXTRA_NOT_NULL, "fact_solicitudes": ("solicitud_key", "empleado_key"),
    "fact_asignaciones": ("asignacion_key", "empleado_key", "id_asignacion"),
    "fact_incidencias": ("incidencia_key", "empleado_creador_key"),
    "v1": ("mes",), "v2": ("tipo_dia",), "v3": ("id_brigada",), "v4": ("id_empleado",), "v5": ("mes", "tipo_permiso"),
    "v6": ("tipo_permiso",), "v7": ("id_empleado",), "v8": ("fecha",), "v9": ("tipo_incidencia",),
    "v10": ("id_empleado_resolutor",), "v11": ("matricula_vehiculo",), "v12": ("id_equipo",), "v13": ("id_incidencia",),
}

TEXTS = ("nombre_", "tipo_", "categoria_", "matricula_", "mes_", "tramo_")
MONEY_AND_RATIOS = ("coste_", "pct_", "media_", "mediana_", "mttr_", "desviacion_", "z_score_", "horas_medias_",
                    "requerimientos_por_")


def declared_type(table: str, column: str) -> str:
    """The type that a column of a gold table or view has by its name."""
    if column.endswith("_validez") or column in ("fecha_actualizacion", "fecha_creacion", "fecha_carga_bronze"):
        return "timestamp_ntz"
    if column.endswith(("_key", "_nombre")) or column in ("estado", "nivel_gravedad", "puesto", "turno", "ubicacion") or (
            column.startswith(TEXTS)) or column in ("creador_categoria_puesto", "creador_nombre_token", "creador_puesto",
                                                    "dia_semana_nombre", "tipos_permiso_usados"):
        return "string"
    if column.startswith("fecha") or column == "date_day" or (column == "mes" and table in ("v1", "v5")):
        return "date"
    if column.startswith(("es_", "esta_", "hubo_", "sin_datos_")):
        return "bigint" if column in ("es_pendiente", "es_resuelta", "es_tramitada") else "boolean"
    if column.startswith("precio_"):
        return "decimal(10,2)"
    if column.startswith(MONEY_AND_RATIOS):
        if column == "requerimientos_por_permiso_activo":
            return "decimal(38,3)"
        return "decimal(12,2)" if table in ("fact_horas_extra", "v3") else "decimal(38,2)"
    return "bigint"


def contract(table: str) -> Contract:
    """Names and types by ``declared_type``, NOT_NULL columns: the contract of one of the 26 gold tables and views."""
    return Contract(table, partial(declared_type, table), NOT_NULL[table])


# The primary key of each dimension and fact (unique, never NULL)
GOLD_KEYS = {
    "dim_fecha": "fecha_key", "dim_parque": "parque_key", "dim_brigada": "brigada_key", "dim_equipo": "equipo_key",
    "dim_vehiculo": "vehiculo_key", "dim_puesto": "puesto_key", "dim_salario": "salario_key",
    "dim_empleado": "empleado_key", "fact_horas_extra": "horas_extra_key", "fact_solicitudes": "solicitud_key",
    "fact_asignaciones": "asignacion_key", "fact_incidencias": "incidencia_key",
}

# Foreign keys of the facts (child, column, parent); the parent's column is its primary key
GOLD_REFERENCES = (
    ("fact_horas_extra", "empleado_key", "dim_empleado"), ("fact_horas_extra", "fecha_key", "dim_fecha"),
    ("fact_horas_extra", "brigada_key", "dim_brigada"), ("fact_horas_extra", "salario_key", "dim_salario"),
    ("fact_solicitudes", "empleado_key", "dim_empleado"), ("fact_solicitudes", "fecha_inicio_key", "dim_fecha"),
    ("fact_solicitudes", "fecha_fin_key", "dim_fecha"), ("fact_asignaciones", "empleado_key", "dim_empleado"),
    ("fact_asignaciones", "fecha_key", "dim_fecha"), ("fact_asignaciones", "brigada_origen_key", "dim_brigada"),
    ("fact_asignaciones", "brigada_destino_key", "dim_brigada"), ("fact_asignaciones", "solicitud_key", "fact_solicitudes"),
    ("fact_incidencias", "empleado_creador_key", "dim_empleado"),
    ("fact_incidencias", "empleado_resolutor_key", "dim_empleado"), ("fact_incidencias", "fecha_key", "dim_fecha"),
    ("fact_incidencias", "parque_key", "dim_parque"), ("fact_incidencias", "vehiculo_key", "dim_vehiculo"),
    ("fact_incidencias", "equipo_key", "dim_equipo"),
)


# Expression tests declared on the facts and analytical views
# (table, expression, where, severity).  A NULL result is not a failure.
EXPRESSION_TESTS = (
    ("fact_horas_extra", "total_horas = horas_diurnas + horas_nocturnas", None, "error"),
    ("fact_horas_extra", "ABS(coste_total - (coste_diurno + coste_nocturno)) <= 0.01", None, "error"),
    ("fact_horas_extra", "horas_diurnas >= 0 AND horas_nocturnas >= 0", None, "error"),
    ("fact_horas_extra", "coste_total >= 0", None, "error"),
    ("fact_solicitudes", "dias_solicitados >= 1", None, "error"),
    ("fact_solicitudes", "total_asignaciones_generadas >= 0", None, "error"),
    ("fact_solicitudes", "total_requerimientos_generados <= total_asignaciones_generadas", None, "error"),
    ("fact_solicitudes", "fecha_fin >= fecha_inicio", "fecha_fin IS NOT NULL", "error"),
    ("fact_asignaciones", "(total_asignaciones = 1)", None, "error"),
    ("fact_asignaciones", "(total_requerimientos IN (0, 1))", None, "error"),
    ("fact_asignaciones", "(total_idas + total_vueltas) <= 1", None, "warn"),
    ("fact_incidencias", "es_resuelta = 1 AND empleado_resolutor_key IS NOT NULL", "estado = 'resuelta'", "error"),
    ("fact_incidencias", "(es_resuelta + es_pendiente + es_tramitada) = 1", None, "error"),
    ("fact_incidencias", "dias_resolucion IS NOT NULL", "estado = 'resuelta'", "warn"),
    ("fact_incidencias", "dias_resolucion BETWEEN 0 AND 1825", "dias_resolucion IS NOT NULL", "error"),
    ("v8_daily_pressure", "permisos_activos_total >= 0", None, "error"),
    ("v8_daily_pressure", "requerimientos_total >= 0", None, "error"),
    ("v8_daily_pressure", "requerimientos_por_permiso_activo >= 0", "requerimientos_por_permiso_activo IS NOT NULL", "error"),
    ("v6_leave_type_management", "solicitudes_confirmadas + solicitudes_denegadas + solicitudes_canceladas + solicitudes_pendientes = total_solicitudes", None, "error"),
    ("v7_request_employee_ranking", "total_dias_solicitados >= dias_confirmados", None, "error"),
    ("v2_overtime_by_day_type", "ABS(coste_total - (coste_diurno + coste_nocturno)) <= 0.05", None, "error"),
    ("v2_overtime_by_day_type", "pct_coste_sobre_total BETWEEN 0 AND 100", None, "error"),
    ("v3_overtime_brigade_ranking", "ABS(coste_total - (coste_festivo + coste_prefestivo + coste_laborable + coste_festivo_vispera)) <= 0.05", None, "error"),
    ("v4_overtime_employee_ranking", "ABS(total_horas - (horas_festivo + horas_prefestivo + horas_laborable + horas_festivo_vispera)) <= 0.05", None, "error"),
    ("v9_resolution_efficiency", "total_resueltas + total_tramitadas + total_pendientes = total_incidencias", None, "error"),
    ("v9_resolution_efficiency", "pct_resueltas + pct_tramitadas + pct_pendientes BETWEEN 99.5 AND 100.5", None, "warn"),
    ("v9_resolution_efficiency", "dias_resolucion_min >= 0", "dias_resolucion_min IS NOT NULL", "error"),
    ("v10_resolver_ranking", "total_resueltas >= 1", None, "error"),
    ("v10_resolver_ranking", "(resueltas_vehiculo + resueltas_personal + resueltas_equipo + resueltas_instalacion + resueltas_vestuario + resueltas_equipos_comunes) = total_resueltas", None, "warn"),
    ("v11_top_vehicles", "(incidencias_alta_gravedad + incidencias_media_gravedad + incidencias_baja_gravedad + incidencias_sin_clasificar) = total_incidencias", None, "error"),
    ("v12_top_equipment", "pct_resueltas BETWEEN 0 AND 100", None, "error"),
    ("v13_bottlenecks", "dias_atascada >= 0", None, "error"),
    ("v13_bottlenecks", "prioridad_atencion BETWEEN 1 AND 7", None, "error"),
)


def expression_test_name(table: str, expression: str, where: str | None) -> str:
    return f"{table}: {expression}" + (f" [where {where}]" if where else "")
