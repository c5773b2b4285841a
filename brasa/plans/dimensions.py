"""Dimensions (D1-D9) and the employee history (H1)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brasa.functions.calendar import calendar_parts
from brasa.functions.columns import flag_eq, surrogate_key, ts_ntz
from brasa.operators.dedup import first_per_key
from brasa.operators.scd2 import build_history

# Calendar parameters and SCD2 configuration of the employee history.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"          # exclusive end of the daily spine
EMPLOYEE_CHECK_COLS = ("tipo_usuario", "puesto", "categoria_puesto", "es_mando_especial")
HISTORY_START = "1900-01-01 00:00:00"
UNKNOWN_KEY = "-1"


def dim_time(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END,
             inclusive_end: bool = False) -> DataFrame:
    """One row per day; the end date is excluded unless ``inclusive_end``."""
    last = F.lit(end).cast("date") if inclusive_end else F.date_sub(F.lit(end).cast("date"), 1)
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), last, F.expr("INTERVAL 1 DAY"))).alias("date_day"))


def first_guard_per_day(stg_guards: DataFrame) -> DataFrame:
    """One representative duty row per date: the lowest guard id (map-side reduced per date)."""
    first = first_per_key(stg_guards.select("fecha", "tipo_dia", "id_guardia"), ["fecha"], ["id_guardia"])
    return first.select("fecha", F.col("tipo_dia").alias("tipo_dia_guardia"))


def dim_fecha(spine: DataFrame, stg_guards: DataFrame) -> DataFrame:
    days = spine.select(F.col("date_day").alias("fecha"))
    enriched = days.join(first_guard_per_day(stg_guards), "fecha", "left")
    parts = calendar_parts("fecha")
    g = F.col("tipo_dia_guardia")
    return enriched.select(
        surrogate_key("fecha").alias("fecha_key"), "fecha", *[e.alias(n) for n, e in parts.items()],
        g.alias("tipo_dia"), g.isNull().alias("sin_datos_guardia"),
        flag_eq(g, "festivo").alias("es_festivo"), flag_eq(g, "prefestivo").alias("es_prefestivo"),
        flag_eq(g, "festivo víspera").alias("es_festivo_vispera"), flag_eq(g, "laborable").alias("es_laborable"),
        parts["dia_semana_num"].isin(6, 7).alias("es_fin_de_semana"),
    )


def _unknown_row(spark: SparkSession, schema_df: DataFrame, values: dict) -> DataFrame:
    row = spark.range(1).select(*[F.lit(values[f.name]).cast(f.dataType).alias(f.name)
                                  for f in schema_df.schema.fields])
    return schema_df.unionByName(row)


def dim_parque(spark: SparkSession, stg_parks: DataFrame) -> DataFrame:
    real = stg_parks.select(surrogate_key("id_parque").alias("parque_key"), "id_parque", "nombre_parque", "ubicacion")
    return _unknown_row(spark, real, {"parque_key": UNKNOWN_KEY, "id_parque": -1,
                                      "nombre_parque": "DESCONOCIDO", "ubicacion": "DESCONOCIDO"})


def _with_park_name(df: DataFrame, stg_parks: DataFrame) -> DataFrame:
    # stations are a handful of rows per region; AQE broadcasts them once measured
    return df.join(stg_parks.select("id_parque", "nombre_parque"), "id_parque", "left")


def dim_brigada(spark: SparkSession, stg_brigades: DataFrame, stg_parks: DataFrame) -> DataFrame:
    e = _with_park_name(stg_brigades, stg_parks)
    real = e.select(surrogate_key("id_brigada").alias("brigada_key"), "id_brigada", "nombre_brigada",
                    "es_especial", "es_brigada_servicio", "id_parque", "nombre_parque")
    return _unknown_row(spark, real, {"brigada_key": UNKNOWN_KEY, "id_brigada": -1,
                                      "nombre_brigada": "DESCONOCIDA", "es_especial": False,
                                      "es_brigada_servicio": False, "id_parque": -1,
                                      "nombre_parque": "DESCONOCIDO"})


def dim_equipo(spark: SparkSession, stg_equipment: DataFrame, stg_parks: DataFrame) -> DataFrame:
    e = _with_park_name(stg_equipment, stg_parks)
    real = e.select(surrogate_key("id_equipo").alias("equipo_key"), "id_equipo", "nombre_equipo",
                    "categoria_equipo", "esta_disponible", "id_parque", "nombre_parque")
    return _unknown_row(spark, real, {"equipo_key": UNKNOWN_KEY, "id_equipo": -1,
                                      "nombre_equipo": "DESCONOCIDO", "categoria_equipo": "desconocido",
                                      "esta_disponible": False, "id_parque": -1,
                                      "nombre_parque": "DESCONOCIDO"})


def dim_vehiculo(spark: SparkSession, stg_vehicles: DataFrame, stg_parks: DataFrame) -> DataFrame:
    e = _with_park_name(stg_vehicles, stg_parks)
    real = e.select(surrogate_key("matricula_token").alias("vehiculo_key"), "matricula_token",
                    "nombre_vehiculo", "tipo_vehiculo", "anio_vehiculo", "id_parque", "nombre_parque")
    return _unknown_row(spark, real, {"vehiculo_key": UNKNOWN_KEY, "matricula_token": "DESCONOCIDO",
                                      "nombre_vehiculo": "DESCONOCIDO", "tipo_vehiculo": "desconocido",
                                      "anio_vehiculo": None, "id_parque": -1,
                                      "nombre_parque": "DESCONOCIDO"})


def dim_puesto(stg_users: DataFrame) -> DataFrame:
    posts = stg_users.filter(F.col("puesto").isNotNull()).select("puesto", "categoria_puesto").distinct()
    return posts.select(
        surrogate_key("puesto").alias("puesto_key"), F.col("puesto").alias("nombre_puesto"), "categoria_puesto",
        flag_eq("categoria_puesto", "Tropa").alias("es_tropa"), flag_eq("categoria_puesto", "Mando").alias("es_mando"))


def dim_salario(stg_salaries: DataFrame) -> DataFrame:
    return stg_salaries.select(
        surrogate_key("id_salario").alias("salario_key"), "id_salario", "tipo_salario", "fecha_vigencia",
        "precio_hora_diurna", "precio_hora_nocturna", "horas_diurnas_jornada", "horas_nocturnas_jornada")


SNAPSHOT_COLS = ("id_empleado", "nombre_token", "tipo_usuario", "puesto", "dias_asuntos_propios",
                 "dias_vacaciones", "dias_modulo", "salidas_personales", "dias_compensacion_grupos",
                 "horas_sindicales", "es_mando_especial", "fecha_creacion", "fecha_actualizacion",
                 "categoria_puesto")


def snp_empleado(extracts: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """SCD2 history of the staged users: bootstrap + one apply per later extract."""
    staged = [(df.select(*SNAPSHOT_COLS), at) for df, at in extracts]
    return build_history(staged, "id_empleado", EMPLOYEE_CHECK_COLS)


def dim_empleado(spark: SparkSession, history: DataFrame) -> DataFrame:
    w = Window.partitionBy("id_empleado").orderBy("dbt_valid_from")
    v = history.withColumn("_version", F.row_number().over(w))
    deleted = F.coalesce(F.col("dbt_is_deleted"), F.lit(False))
    real = v.select(
        surrogate_key("id_empleado", "dbt_valid_from").alias("empleado_key"),
        F.col("id_empleado").cast("bigint").alias("id_empleado"), "nombre_token", "tipo_usuario", "puesto",
        "categoria_puesto", F.col("es_mando_especial").cast("boolean").alias("es_mando_especial"),
        F.when(F.col("_version") == 1, ts_ntz(HISTORY_START)).otherwise(F.col("dbt_valid_from"))
        .alias("fecha_inicio_validez"),
        F.col("dbt_valid_to").alias("fecha_fin_validez"),
        (F.col("dbt_valid_to").isNull() & ~deleted).alias("es_version_actual"),
        deleted.alias("es_eliminado"))
    return _unknown_row(spark, real, {
        "empleado_key": UNKNOWN_KEY, "id_empleado": -1, "nombre_token": "DESCONOCIDO",
        "tipo_usuario": "desconocido", "puesto": "desconocido", "categoria_puesto": "Desconocido",
        "es_mando_especial": False, "fecha_inicio_validez": "1900-01-01 00:00:00",
        "fecha_fin_validez": None, "es_version_actual": True, "es_eliminado": False})
