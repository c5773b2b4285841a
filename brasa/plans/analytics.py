"""Analytical views (V1-V13).

Conventions shared by every view:
* ratios and averages are exact decimals (scale 6) before rounding, as the
  warehouse computes NUMBER arithmetic;
* counts and integer sums are bigint, rounded money / percentages decimal;
* ordering follows the warehouse: NULL sorts high (DESC puts it first);
* ranks go through ``operators.ranking`` so no rank needs one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brasa.functions.columns import DEC2, attention_priority, avg_dec, band, pct, ratio, round_dec
from brasa.operators.intervals import active_per_day
from brasa.operators.ranking import Order, RankSpec, Stat, add_ranks, attach_group_stats

# Reporting windows, reference date and thresholds of the views.
OVERTIME_WINDOW = ("2025-05-05", "2026-05-05")
REQUEST_WINDOW = ("2026-01-01", "2026-05-05")
REQUEST_RANKING_WINDOW = ("2025-05-05", "2026-05-05")
INCIDENT_WINDOW = ("2026-01-01", "2026-05-05")
AS_OF = "2026-05-05"
MIN_CASES_PER_TYPE = 5
MIN_RESOLVED_FOR_SPEED = 3
DAY_TYPES = ("festivo", "prefestivo", "laborable", "festivo víspera")
LEAVE_TYPES = (
    ("vacaciones", "permisos_vacaciones"),
    ("asuntos propios", "permisos_asuntos_propios"),
    ("horas sindicales", "permisos_horas_sindicales"),
    ("salidas personales", "permisos_salidas_personales"),
    ("vestuario", "permisos_vestuario"),
    ("licencias por jornadas", "permisos_licencias_jornadas"),
    ("licencias por dias", "permisos_licencias_dias"),
    ("modulo", "permisos_modulo"),
    ("compensacion grupos especiales", "permisos_compensacion_grupos"),
)
ACTIVE_LEAVE_BANDS = [(0, "0 permisos"), (2, "1-2 permisos"), (4, "3-4 permisos"), (6, "5-6 permisos"),
                      (8, "7-8 permisos"), (10, "9-10 permisos"), (12, "11-12 permisos"),
                      (15, "13-15 permisos"), (20, "16-20 permisos"), (25, "21-25 permisos")]
AGE_BANDS = [(7, "reciente"), (30, "una_semana_a_un_mes"), (90, "mes_a_trimestre"),
             (180, "trimestre_a_semestre")]
RESOLUTION_BANDS = [(3, "rapido"), (7, "normal"), (14, "lento")]
INCIDENT_TYPES = ("vehiculo", "personal", "equipo", "instalacion", "vestuario", "equipos_comunes")


def in_window(col: str, window: tuple[str, str]) -> Column:
    lo, hi = window
    return (F.col(col) >= F.lit(lo).cast("date")) & (F.col(col) < F.lit(hi).cast("date"))


def _sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def _count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("bigint")


def _money(col: Column) -> Column:
    return round_dec(col, 2)


def _median2(col: Column) -> Column:
    # exact median: Spark keeps a value -> count map per group (bounded by the
    # distinct values, e.g. day counts 0..3650) and merges it map-side
    return F.median(col).cast("decimal(38,2)")


def _stddev2(col: Column) -> Column:
    return F.round(F.stddev_samp(col.cast("double")), 2).cast(DEC2)


# --------------------------------------------------------------------- overtime

def v1_overtime_seasonality(fact: DataFrame) -> DataFrame:
    h = fact.filter(in_window("fecha", OVERTIME_WINDOW)).withColumn("mes", F.trunc("fecha", "MM"))
    return h.groupBy("mes").agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.count_distinct("id_empleado").alias("empleados_distintos"),
        F.sum("horas_diurnas").cast("bigint").alias("total_horas_diurnas"),
        F.sum("horas_nocturnas").cast("bigint").alias("total_horas_nocturnas"),
        F.sum("total_horas").cast("bigint").alias("total_horas"),
        pct(F.sum("horas_diurnas"), F.sum("total_horas")).alias("pct_horas_diurnas"),
        pct(F.sum("horas_nocturnas"), F.sum("total_horas")).alias("pct_horas_nocturnas"),
        _money(F.sum("coste_diurno")).alias("coste_diurno"),
        _money(F.sum("coste_nocturno")).alias("coste_nocturno"),
        _money(F.sum("coste_total")).alias("coste_total"),
        pct(F.sum("coste_diurno"), F.sum("coste_total"), 2, 2).alias("pct_coste_diurno"),
        pct(F.sum("coste_nocturno"), F.sum("coste_total"), 2, 2).alias("pct_coste_nocturno"),
        round_dec(avg_dec("total_horas"), 2).alias("media_horas_por_registro"),
        round_dec(avg_dec("coste_total", 2), 2).alias("media_coste_por_registro"),
        round_dec(ratio(F.sum("coste_total"), F.sum("total_horas"), 2, 0), 2).alias("coste_medio_por_hora"),
        _sum_if(F.col("tipo_salario") == "Subinspector", F.col("coste_total")).cast(DEC2).alias("coste_subinspector"),
        _sum_if(F.col("tipo_salario") == "Tropa", F.col("coste_total")).cast(DEC2).alias("coste_tropa"),
    )


def v2_overtime_by_day_type(fact: DataFrame, dim_fecha: DataFrame) -> DataFrame:
    # the calendar holds one row per day between fixed parameters: broadcast is bounded
    cal = F.broadcast(dim_fecha.select("fecha", "dia_semana_num", "dia_semana_nombre", "es_fin_de_semana"))
    h = fact.filter(in_window("fecha", OVERTIME_WINDOW)).join(cal, "fecha", "left")
    # totals come from the grouped rows, a few day types
    days = h.groupBy("tipo_dia").agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.count_distinct("id_empleado").alias("empleados_distintos"),
        F.sum("horas_diurnas").cast("bigint").alias("total_horas_diurnas"),
        F.sum("horas_nocturnas").cast("bigint").alias("total_horas_nocturnas"),
        F.sum("total_horas").cast("bigint").alias("total_horas"),
        _money(F.sum("coste_diurno")).alias("coste_diurno"),
        _money(F.sum("coste_nocturno")).alias("coste_nocturno"),
        _money(F.sum("coste_total")).alias("coste_total"),
        round_dec(avg_dec("total_horas"), 2).alias("media_horas_por_registro"),
        round_dec(avg_dec("coste_total", 2), 2).alias("media_coste_por_registro"),
        round_dec(ratio(F.sum("coste_total"), F.sum("total_horas"), 2, 0), 2).alias("coste_medio_por_hora"),
        F.sum("total_horas").alias("_horas"), F.sum("coste_total").alias("_coste"),
    )
    every = Window.partitionBy()
    return days.withColumn("pct_coste_sobre_total", pct(F.col("_coste"), F.sum("_coste").over(every), 2, 2)).withColumn(
        "pct_horas_sobre_total", pct(F.col("_horas"), F.sum("_horas").over(every))).drop("_horas", "_coste")


def v3_overtime_brigade_ranking(fact: DataFrame, dim_brigada: DataFrame) -> DataFrame:
    h = fact.filter(in_window("fecha", OVERTIME_WINDOW)).join(
        dim_brigada.select("brigada_key", "id_brigada", "nombre_brigada"), "brigada_key", "left")
    name = F.coalesce(F.col("nombre_brigada"), F.lit("DESCONOCIDA"))
    unknown = name == "DESCONOCIDA"
    money12 = lambda c: F.round(c, 2).cast("decimal(12,2)")
    agg = h.groupBy(name.alias("nombre_brigada")).agg(
        F.min("id_brigada").cast("bigint").alias("id_brigada"),
        F.count(F.lit(1)).alias("total_registros"),
        F.count_distinct("id_empleado").alias("empleados_distintos"),
        F.sum("horas_diurnas").cast("bigint").alias("total_horas_diurnas"),
        F.sum("horas_nocturnas").cast("bigint").alias("total_horas_nocturnas"),
        F.sum("total_horas").cast("bigint").alias("total_horas"),
        money12(F.sum("coste_diurno")).alias("coste_diurno"),
        money12(F.sum("coste_nocturno")).alias("coste_nocturno"),
        money12(F.sum("coste_total")).alias("coste_total"),
        *[money12(_sum_if(F.col("tipo_dia") == t, F.col("coste_total"))).alias(f"coste_{t.replace(' víspera', '_vispera')}")
          for t in DAY_TYPES],
        money12(avg_dec("coste_total", 2)).alias("media_coste_por_registro"),
        money12(avg_dec("total_horas")).alias("media_horas_por_registro"),
        money12(ratio(F.sum("coste_total"), F.sum("total_horas"), 2, 0)).alias("coste_medio_por_hora"),
        F.sum("coste_total").alias("_sum_coste"),
        F.sum("total_horas").alias("_sum_horas"),
    )
    # totals come from the grouped rows, one for each brigade
    agg = attach_group_stats(agg, [], {"_coste_global": F.sum("_sum_coste"), "_horas_global": F.sum("_sum_horas")})
    agg = agg.withColumn("pct_coste_sobre_total", money12(ratio(F.col("_sum_coste"), F.col("_coste_global"), 2, 2) * 100)) \
        .withColumn("pct_horas_sobre_total", money12(ratio(F.col("_sum_horas"), F.col("_horas_global")) * 100)) \
        .drop("_coste_global", "_horas_global")
    agg = agg.select("*", F.lit(False).alias("es_especial"),
                     (~unknown).alias("es_brigada_servicio"),
                     F.when(unknown, F.lit("DESCONOCIDO")).otherwise(F.lit("Norte/Sur")).alias("nombre_parque"))
    ranked = add_ranks(agg, [
        RankSpec("ranking_coste", [Order("_sum_coste", descending=True, nulls_last=False)]),
        RankSpec("ranking_horas", [Order("_sum_horas", descending=True, nulls_last=False)]),
    ])
    return ranked.drop("_sum_coste", "_sum_horas")


def v4_overtime_employee_ranking(fact: DataFrame, dim_emp: DataFrame) -> DataFrame:
    h = fact.filter(in_window("fecha", OVERTIME_WINDOW)).join(
        dim_emp.select("empleado_key", "nombre_token", "categoria_puesto", "puesto"), "empleado_key", "left")
    agg = h.groupBy(
        "id_empleado",
        F.coalesce(F.col("nombre_token"), F.lit("DESCONOCIDO")).alias("nombre_token"),
        F.coalesce(F.col("categoria_puesto"), F.lit("desconocido")).alias("categoria_puesto"),
        F.coalesce(F.col("puesto"), F.lit("desconocido")).alias("puesto"),
    ).agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.sum("horas_diurnas").cast("bigint").alias("total_horas_diurnas"),
        F.sum("horas_nocturnas").cast("bigint").alias("total_horas_nocturnas"),
        F.sum("total_horas").cast("bigint").alias("total_horas"),
        _money(F.sum("coste_diurno")).alias("coste_diurno"),
        _money(F.sum("coste_nocturno")).alias("coste_nocturno"),
        _money(F.sum("coste_total")).alias("coste_total"),
        *[_sum_if(F.col("tipo_dia") == t, F.col("total_horas")).cast("bigint")
          .alias(f"horas_{t.replace(' víspera', '_vispera')}") for t in DAY_TYPES],
        round_dec(avg_dec("total_horas"), 2).alias("media_horas_por_registro"),
        round_dec(avg_dec("coste_total", 2), 2).alias("media_coste_por_registro"),
    )
    stats = attach_group_stats(agg, ["puesto"], {
        "_avg_coste": Stat("avg_dec", "coste_total", 2), "_avg_horas": Stat("avg_dec", "total_horas"),
        "_std_coste": Stat("stddev", "coste_total"), "_n": Stat("count"), "_sum_coste": Stat("sum", "coste_total")})
    out = stats.select(
        *agg.columns,
        round_dec(F.col("_avg_coste"), 2).alias("coste_medio_puesto"),
        round_dec(F.col("_avg_horas"), 2).alias("horas_medias_puesto"),
        F.round(F.col("_std_coste"), 2).cast(DEC2).alias("desviacion_coste_puesto"),
        F.col("_n").cast("bigint").alias("empleados_en_puesto"),
        pct(F.col("coste_total"), F.col("_sum_coste"), 2, 2).alias("pct_coste_sobre_puesto"),
        F.round((F.col("coste_total").cast("double") - F.col("_avg_coste").cast("double"))
                / F.nullif(F.col("_std_coste"), F.lit(0.0)), 2).cast(DEC2).alias("z_score_coste_puesto"),
    )
    return add_ranks(out, [
        RankSpec("ranking_coste_dentro_puesto", [Order("coste_total", True, False)], ["puesto"]),
        RankSpec("ranking_horas_dentro_puesto", [Order("total_horas", True, False)], ["puesto"]),
        RankSpec("ranking_coste_global", [Order("coste_total", True, False)]),
    ])


# --------------------------------------------------------------------- requests

def _state_counts() -> list[Column]:
    st = F.col("estado")
    return [_count_if(st == "confirmada").alias("solicitudes_confirmadas"),
            _count_if(st == "denegada").alias("solicitudes_denegadas"),
            _count_if(st == "cancelada").alias("solicitudes_canceladas"),
            _count_if(st == "pendiente").alias("solicitudes_pendientes")]


def v5_request_seasonality(fact: DataFrame) -> DataFrame:
    s = fact.filter(in_window("fecha_inicio", REQUEST_WINDOW)).withColumn("mes", F.trunc("fecha_inicio", "MM"))
    st = F.col("estado")
    return s.groupBy("mes", "tipo_permiso").agg(
        F.count(F.lit(1)).alias("total_solicitudes"),
        F.count_distinct("id_empleado").alias("empleados_distintos"),
        *_state_counts(),
        F.sum("dias_solicitados").cast("bigint").alias("total_dias_solicitados"),
        _sum_if(st == "confirmada", F.col("dias_solicitados")).cast("bigint").alias("dias_confirmados"),
        _sum_if(st == "denegada", F.col("dias_solicitados")).cast("bigint").alias("dias_denegados"),
        round_dec(avg_dec("dias_solicitados"), 2).alias("media_dias_por_solicitud"),
    )


def v6_leave_type_management(fact: DataFrame) -> DataFrame:
    s = fact.filter(in_window("fecha_inicio", REQUEST_WINDOW))
    st = F.col("estado")
    lead = F.datediff(F.col("fecha_inicio"), F.col("fecha_actualizacion"))
    confirmed_lead = F.when((st == "confirmada") & F.col("fecha_actualizacion").isNotNull()
                            & F.col("fecha_inicio").isNotNull(), lead)
    n = F.count(F.lit(1))
    out = s.groupBy("tipo_permiso").agg(
        n.alias("total_solicitudes"), *_state_counts(),
        pct(F.count_if(st == "confirmada"), n).alias("pct_confirmadas"),
        pct(F.count_if(st == "denegada"), n).alias("pct_denegadas"),
        pct(F.count_if(st == "cancelada"), n).alias("pct_canceladas"),
        F.sum("dias_solicitados").cast("bigint").alias("total_dias_solicitados"),
        _sum_if(st == "confirmada", F.col("dias_solicitados")).cast("bigint").alias("dias_confirmados"),
        _sum_if(st == "denegada", F.col("dias_solicitados")).cast("bigint").alias("dias_denegados"),
        round_dec(avg_dec(confirmed_lead), 2).alias("media_dias_antelacion_aprobacion"),
        _median2(confirmed_lead).alias("mediana_dias_antelacion_aprobacion"),
        _count_if((st == "confirmada") & (lead < 0)).alias("aprobadas_despues_inicio"),
        _count_if((st == "confirmada") & lead.between(0, 2)).alias("aprobadas_con_0_2_dias_antelacion"),
    )
    return out.filter(F.col("total_solicitudes") >= MIN_CASES_PER_TYPE)


def v7_request_employee_ranking(fact: DataFrame, dim_emp: DataFrame) -> DataFrame:
    s = fact.filter(in_window("fecha_inicio", REQUEST_RANKING_WINDOW)).join(
        dim_emp.select("empleado_key", "nombre_token", "categoria_puesto", "puesto"), "empleado_key", "left")
    st = F.col("estado")
    d = F.col("dias_solicitados")
    n = F.count(F.lit(1))
    types = F.collect_set("tipo_permiso")          # distinct leave types: a short, bounded list
    return s.groupBy(
        "id_empleado",
        F.coalesce(F.col("nombre_token"), F.lit("DESCONOCIDO")).alias("nombre_token"),
        F.coalesce(F.col("categoria_puesto"), F.lit("desconocido")).alias("categoria_puesto"),
        F.coalesce(F.col("puesto"), F.lit("desconocido")).alias("puesto"),
    ).agg(
        n.alias("total_solicitudes"), *_state_counts(),
        F.sum(d).cast("bigint").alias("total_dias_solicitados"),
        _sum_if(st == "confirmada", d).cast("bigint").alias("dias_confirmados"),
        _sum_if(st == "denegada", d).cast("bigint").alias("dias_denegados"),
        _sum_if(st == "cancelada", d).cast("bigint").alias("dias_cancelados"),
        _sum_if(st == "pendiente", d).cast("bigint").alias("dias_pendientes"),
        pct(F.count_if(st == "confirmada"), n).alias("pct_confirmadas"),
        pct(F.count_if(st == "denegada"), n).alias("pct_denegadas"),
        round_dec(avg_dec(d), 2).alias("media_dias_por_solicitud"),
        F.size(types).cast("bigint").alias("tipos_permiso_distintos"),
        F.array_join(F.array_sort(types), ", ").alias("tipos_permiso_usados"),
    )


def v8_daily_pressure(fact_req: DataFrame, fact_asig: DataFrame, dim_fecha: DataFrame) -> DataFrame:
    confirmed = fact_req.filter(F.col("estado") == "confirmada")
    measures = {"permisos_activos_total": F.lit(1)}
    for kind, name in LEAVE_TYPES:
        measures[name] = F.when(F.col("tipo_permiso") == kind, 1).otherwise(0)
    active = active_per_day(confirmed, "fecha_inicio", "fecha_fin", dim_fecha.select("fecha"),
                            measures)
    req = (fact_asig.filter(F.col("es_requerimiento"))
           .groupBy(F.col("fecha_inicio").alias("fecha"))
           .agg(F.sum("total_requerimientos").cast("bigint").alias("requerimientos_total"),
                F.count_distinct(F.when(F.col("es_requerimiento"), F.col("id_empleado"))).alias("bomberos_requeridos")))
    f = dim_fecha.select("fecha", "tipo_dia").join(active, "fecha", "left").join(req, "fecha", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    total = zero("permisos_activos_total")
    reqs = zero("requerimientos_total")
    return f.select(
        "fecha", "tipo_dia", total.alias("permisos_activos_total"),
        *[zero(name).alias(name) for _, name in LEAVE_TYPES],
        reqs.alias("requerimientos_total"), zero("bomberos_requeridos").alias("bomberos_requeridos"),
        round_dec(ratio(reqs, total), 3).alias("requerimientos_por_permiso_activo"),
        pct(reqs, total).alias("requerimientos_por_100_permisos_activos"),
        band(total, ACTIVE_LEAVE_BANDS, "26+ permisos").alias("tramo_permisos_activos"),
        (reqs > 0).alias("hubo_requerimientos"),
    )


# -------------------------------------------------------------------- incidents

def _mttr_cols(prefix: str) -> list[Column]:
    d = F.col("dias_resolucion")
    return [round_dec(avg_dec(d), 2).alias(prefix), _median2(d).alias(f"{prefix}_mediana"),
            F.min(d).cast("bigint").alias("dias_resolucion_min"),
            F.max(d).cast("bigint").alias("dias_resolucion_max")]


def v9_resolution_efficiency(fact: DataFrame) -> DataFrame:
    i = fact.filter(in_window("fecha_incidencia", INCIDENT_WINDOW))
    d = F.col("dias_resolucion")
    n = F.count(F.lit(1))
    mean = avg_dec(d)
    return i.groupBy("tipo_incidencia", F.coalesce(F.col("nivel_gravedad"), F.lit("sin_clasificar")).alias("nivel_gravedad")).agg(
        n.alias("total_incidencias"),
        F.sum("es_resuelta").cast("bigint").alias("total_resueltas"),
        F.sum("es_tramitada").cast("bigint").alias("total_tramitadas"),
        F.sum("es_pendiente").cast("bigint").alias("total_pendientes"),
        pct(F.sum("es_resuelta"), n).alias("pct_resueltas"),
        pct(F.sum("es_tramitada"), n).alias("pct_tramitadas"),
        pct(F.sum("es_pendiente"), n).alias("pct_pendientes"),
        round_dec(mean, 2).alias("mttr_dias_medio"),
        _median2(d).alias("mttr_dias_mediana"),
        F.min(d).cast("bigint").alias("dias_resolucion_min"),
        F.max(d).cast("bigint").alias("dias_resolucion_max"),
        _stddev2(d).alias("desviacion_mttr"),
        F.when(mean.isNull(), F.lit("sin_datos")).otherwise(band(mean, RESOLUTION_BANDS, "muy_lento")).alias("categoria_mttr"),
    )


def _severity_counts(prefix: str) -> list[Column]:
    lvl = F.col("nivel_gravedad")
    out = [_sum_if(lvl == "alto", F.lit(1)).cast("bigint").alias(f"{prefix}_alta_gravedad"),
           _sum_if(lvl == "medio", F.lit(1)).cast("bigint").alias(f"{prefix}_media_gravedad"),
           _sum_if(lvl == "bajo", F.lit(1)).cast("bigint").alias(f"{prefix}_baja_gravedad")]
    return out


def _known(col: str) -> Column:
    return F.col(col).isNotNull() & (F.col(col) != "-1")


def v10_resolver_ranking(fact: DataFrame, dim_emp: DataFrame, dim_parque: DataFrame) -> DataFrame:
    i = (fact.filter(in_window("fecha_incidencia", INCIDENT_WINDOW) & (F.col("estado") == "resuelta")
                     & _known("empleado_resolutor_key"))
         .withColumn("nivel_gravedad", F.coalesce(F.col("nivel_gravedad"), F.lit("sin_clasificar")))
         .join(dim_emp.select(F.col("empleado_key").alias("empleado_resolutor_key"), "nombre_token",
                              "categoria_puesto", "puesto"), "empleado_resolutor_key", "left")
         .join(dim_parque.select("id_parque", "nombre_parque"), "id_parque", "left"))
    t = F.col("tipo_incidencia")
    agg = i.groupBy(
        "id_empleado_resolutor",
        F.coalesce(F.col("nombre_token"), F.lit("DESCONOCIDO")).alias("nombre_token"),
        F.coalesce(F.col("categoria_puesto"), F.lit("desconocido")).alias("categoria_puesto"),
        F.coalesce(F.col("puesto"), F.lit("desconocido")).alias("puesto"),
        F.coalesce(F.col("nombre_parque"), F.lit("DESCONOCIDO")).alias("nombre_parque"),
    ).agg(
        F.count(F.lit(1)).alias("total_resueltas"),
        *[_sum_if(t == k, F.lit(1)).cast("bigint").alias(f"resueltas_{k}") for k in INCIDENT_TYPES],
        *_severity_counts("resueltas"),
        *_mttr_cols("mttr_personal"),
    )
    speed = F.when(F.col("total_resueltas") >= MIN_RESOLVED_FOR_SPEED, F.col("mttr_personal"))
    agg = agg.withColumn("_speed", speed)
    s = attach_group_stats(agg, ["puesto"], {"_mttr_puesto": Stat("avg_dec", "mttr_personal", 2),
                                             "_n_puesto": Stat("count")})
    s = attach_group_stats(s, ["nombre_parque"], {"_mttr_parque": Stat("avg_dec", "mttr_personal", 2),
                                                  "_n_parque": Stat("count"),
                                                  "_sum_parque": Stat("sum", "total_resueltas")})
    out = s.select(
        *agg.columns,
        round_dec(F.col("_mttr_puesto"), 2).alias("mttr_medio_puesto"),
        round_dec(F.col("_mttr_parque"), 2).alias("mttr_medio_parque"),
        F.col("_n_puesto").cast("bigint").alias("resolutores_en_puesto"),
        F.col("_n_parque").cast("bigint").alias("resolutores_en_parque"),
        pct(F.col("total_resueltas"), F.col("_sum_parque")).alias("pct_resueltas_sobre_parque"),
    )
    ranked = add_ranks(out, [
        RankSpec("ranking_total_global", [Order("total_resueltas", True, False)]),
        RankSpec("ranking_total_dentro_parque", [Order("total_resueltas", True, False)], ["nombre_parque"]),
        RankSpec("ranking_total_dentro_puesto", [Order("total_resueltas", True, False)], ["puesto"]),
        RankSpec("ranking_velocidad_global", [Order("_speed", False, True)]),
    ])
    return ranked.drop("_speed")


def _incident_counts(n: Column) -> list[Column]:
    return [n.alias("total_incidencias"),
            F.sum("es_resuelta").cast("bigint").alias("total_resueltas"),
            F.sum("es_tramitada").cast("bigint").alias("total_tramitadas"),
            F.sum("es_pendiente").cast("bigint").alias("total_pendientes"),
            *_severity_counts("incidencias"),
            _sum_if(F.col("nivel_gravedad") == "sin_clasificar", F.lit(1)).cast("bigint").alias("incidencias_sin_clasificar"),
            pct(F.sum("es_resuelta"), n).alias("pct_resueltas"),
            pct(F.sum("es_pendiente"), n).alias("pct_pendientes")]


def v11_top_vehicles(fact: DataFrame, dim_vehiculo: DataFrame) -> DataFrame:
    i = (fact.filter(in_window("fecha_incidencia", INCIDENT_WINDOW) & _known("vehiculo_key"))
         .withColumn("nivel_gravedad", F.coalesce(F.col("nivel_gravedad"), F.lit("sin_clasificar")))
         .join(dim_vehiculo.select("vehiculo_key", "nombre_vehiculo", "tipo_vehiculo", "anio_vehiculo",
                                   "nombre_parque"), "vehiculo_key", "left"))
    agg = i.groupBy(
        "matricula_vehiculo",
        F.coalesce(F.col("nombre_vehiculo"), F.lit("DESCONOCIDO")).alias("nombre_vehiculo"),
        F.coalesce(F.col("tipo_vehiculo"), F.lit("desconocido")).alias("tipo_vehiculo"),
        "anio_vehiculo",
        F.coalesce(F.col("nombre_parque"), F.lit("DESCONOCIDO")).alias("nombre_parque"),
    ).agg(*_incident_counts(F.count(F.lit(1))), *_mttr_cols("mttr_vehiculo"))
    s = attach_group_stats(agg, [], {"_sum": Stat("sum", "total_incidencias"), "_n": Stat("count"),
                                     "_avg": Stat("avg_dec", "total_incidencias")})
    tot, cnt, sm = F.col("total_incidencias"), F.col("_n"), F.col("_sum")
    klass = (F.when((tot * cnt >= 2 * sm) & (F.col("incidencias_alta_gravedad") >= 1), F.lit("critico"))
             .when(tot * cnt >= sm, F.lit("problematico"))
             .when(2 * tot * cnt >= sm, F.lit("normal")).otherwise(F.lit("bajo_volumen")))
    out = s.select(*agg.columns, round_dec(F.col("_avg"), 2).alias("media_incidencias_flota"),
                   klass.alias("categoria_vehiculo"))
    return add_ranks(out, [
        RankSpec("ranking_volumen_global", [Order("total_incidencias", True, False)]),
        RankSpec("ranking_volumen_dentro_parque", [Order("total_incidencias", True, False)], ["nombre_parque"]),
        RankSpec("ranking_volumen_dentro_tipo", [Order("total_incidencias", True, False)], ["tipo_vehiculo"]),
        RankSpec("ranking_criticidad", [Order("incidencias_alta_gravedad", True, False),
                                        Order("total_incidencias", True, False)]),
    ])


def v12_top_equipment(fact: DataFrame, dim_equipo: DataFrame) -> DataFrame:
    i = (fact.filter(in_window("fecha_incidencia", INCIDENT_WINDOW) & _known("equipo_key"))
         .withColumn("nivel_gravedad", F.coalesce(F.col("nivel_gravedad"), F.lit("sin_clasificar")))
         .join(dim_equipo.select("equipo_key", "nombre_equipo", "categoria_equipo", "esta_disponible",
                                 "nombre_parque"), "equipo_key", "left"))
    agg = i.groupBy(
        "id_equipo",
        F.coalesce(F.col("nombre_equipo"), F.lit("DESCONOCIDO")).alias("nombre_equipo"),
        F.coalesce(F.col("categoria_equipo"), F.lit("desconocido")).alias("categoria_equipo"),
        F.coalesce(F.col("esta_disponible"), F.lit(False)).alias("esta_disponible"),
        F.coalesce(F.col("nombre_parque"), F.lit("DESCONOCIDO")).alias("nombre_parque"),
    ).agg(*_incident_counts(F.count(F.lit(1))), *_mttr_cols("mttr_equipo"))
    s = attach_group_stats(agg, ["categoria_equipo"], {"_sum": Stat("sum", "total_incidencias"), "_n": Stat("count"),
                                                       "_avg": Stat("avg_dec", "total_incidencias")})
    tot, cnt, sm = F.col("total_incidencias"), F.col("_n"), F.col("_sum")
    risk = (F.when((tot >= 3) & ~F.col("esta_disponible"), F.lit("retirado_problematico"))
            .when((tot * cnt >= 2 * sm) & (F.col("incidencias_alta_gravedad") >= 1), F.lit("critico"))
            .when(tot * cnt >= sm, F.lit("frecuente")).otherwise(F.lit("normal")))
    out = s.select(*agg.columns, round_dec(F.col("_avg"), 2).alias("media_incidencias_categoria"),
                   pct(tot, sm).alias("pct_incidencias_sobre_categoria"), risk.alias("categoria_equipo_riesgo"))
    return add_ranks(out, [
        RankSpec("ranking_volumen_global", [Order("total_incidencias", True, False)]),
        RankSpec("ranking_volumen_dentro_categoria", [Order("total_incidencias", True, False)], ["categoria_equipo"]),
        RankSpec("ranking_volumen_dentro_parque", [Order("total_incidencias", True, False)], ["nombre_parque"]),
    ])


def v13_bottlenecks(fact: DataFrame, dim_emp: DataFrame, dim_parque: DataFrame, dim_vehiculo: DataFrame,
                    dim_equipo: DataFrame, as_of: str | None = None) -> DataFrame:
    """Open incidents by age at ``as_of`` (the current date unless given)."""
    f = fact.filter(F.col("estado").isin("pendiente", "tramitada"))
    f = (f.join(dim_emp.select(F.col("empleado_key").alias("empleado_creador_key"),
                               F.col("nombre_token").alias("creador_nombre_token"),
                               F.col("puesto").alias("creador_puesto"),
                               F.col("categoria_puesto").alias("creador_categoria_puesto")),
                "empleado_creador_key", "left")
          .join(dim_parque.select("id_parque", "nombre_parque"), "id_parque", "left")
          .join(dim_vehiculo.select("vehiculo_key", "nombre_vehiculo", "tipo_vehiculo"), "vehiculo_key", "left")
          .join(dim_equipo.select("equipo_key", "nombre_equipo", "categoria_equipo"), "equipo_key", "left"))
    days = F.datediff(F.current_date() if as_of is None else F.lit(as_of).cast("date"), F.col("fecha_creacion")).cast("bigint")
    lvl = F.coalesce(F.col("nivel_gravedad"), F.lit("sin_clasificar"))
    f = f.select(
        "id_incidencia", "tipo_incidencia", lvl.alias("nivel_gravedad"), "estado", "fecha_incidencia",
        "fecha_creacion", "fecha_actualizacion", "id_parque", "id_empleado_creador", "matricula_vehiculo",
        "id_equipo", "nombre_equipo_comun", days.alias("dias_atascada"), "creador_nombre_token",
        "creador_puesto", "creador_categoria_puesto", "nombre_parque", "nombre_vehiculo", "tipo_vehiculo",
        "nombre_equipo", "categoria_equipo")
    d, lv = F.col("dias_atascada"), F.col("nivel_gravedad")
    f = f.withColumn("categoria_antiguedad", band(d, AGE_BANDS, "muy_antigua")) \
         .withColumn("prioridad_atencion", attention_priority(lv, d))
    tie = Order("id_incidencia")
    return add_ranks(f, [
        RankSpec("ranking_antiguedad_global", [Order("dias_atascada", True, False), Order("prioridad_atencion"), tie],
                 method="row_number"),
        RankSpec("ranking_antiguedad_dentro_tipo", [Order("dias_atascada", True, False), tie], ["tipo_incidencia"],
                 method="row_number"),
        RankSpec("ranking_antiguedad_dentro_parque", [Order("dias_atascada", True, False), tie], ["nombre_parque"],
                 method="row_number"),
    ])
