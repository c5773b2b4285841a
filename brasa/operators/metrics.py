"""Semantic-layer metrics as DataFrame aggregations.

A simple metric is an aggregation (sum, count, count_distinct, average) of an
expression over a fact, optionally filtered; a ratio metric divides two
simple metrics.  Metrics are evaluated together in one ``groupBy().agg()``
over any dimensions (including a time grain); ratios are computed on the
aggregated row.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brasa.functions.columns import avg_dec, ratio


@dataclass(frozen=True)
class Simple:
    name: str
    agg: str                      # sum | count | count_distinct | average
    expr: str
    filter: str | None = None
    scale: int = 0                # decimal scale of the measure


@dataclass(frozen=True)
class Ratio:
    name: str
    numerator: str
    denominator: str


def _measure(m: Simple) -> Column:
    e = F.expr(m.expr)
    if m.filter:
        e = F.when(F.expr(m.filter), e)
    if m.agg == "sum":
        return F.sum(e)
    if m.agg == "count":
        return F.count(e).cast("bigint")
    if m.agg == "count_distinct":
        return F.count_distinct(e).cast("bigint")
    if m.agg == "average":
        return avg_dec(e, m.scale)
    raise ValueError(m.agg)


def evaluate(df: DataFrame, metrics: Sequence, by: Sequence = ()) -> DataFrame:
    simple = [m for m in metrics if isinstance(m, Simple)]
    scales = {m.name: m.scale for m in simple}
    out = df.groupBy(*by).agg(*[_measure(m).alias(m.name) for m in simple]) if by else \
        df.agg(*[_measure(m).alias(m.name) for m in simple])
    for r in (m for m in metrics if isinstance(m, Ratio)):
        out = out.withColumn(r.name, ratio(F.col(r.numerator), F.col(r.denominator),
                                           scales.get(r.numerator, 0), scales.get(r.denominator, 0)))
    return out


def by_time_grain(df: DataFrame, metrics: Sequence, time_col: str, grain: str,
                  spine: DataFrame | None = None, spine_col: str = "date_day") -> DataFrame:
    """Metrics per time bucket; with a spine every bucket appears (gaps kept as NULL)."""
    bucket = F.trunc(F.col(time_col), grain) if grain != "day" else F.col(time_col)
    values = evaluate(df.withColumn("periodo", bucket), metrics, ["periodo"])
    if spine is None:
        return values
    sp = F.trunc(F.col(spine_col), grain) if grain != "day" else F.col(spine_col)
    buckets = spine.select(sp.alias("periodo")).distinct()
    return buckets.join(values, "periodo", "left")


# The metric catalogue of the warehouse (names, aggregations, filters).
OVERTIME_METRICS = (
    Simple("coste_total_horas_extra", "sum", "coste_total", scale=2),
    Simple("coste_diurno_horas_extra", "sum", "coste_diurno", scale=2),
    Simple("coste_nocturno_horas_extra", "sum", "coste_nocturno", scale=2),
    Simple("total_horas_extra", "sum", "total_horas"),
    Simple("bomberos_con_horas_extra", "count_distinct", "id_empleado"),
    Ratio("coste_medio_por_hora", "coste_total_horas_extra", "total_horas_extra"),
)
REQUEST_METRICS = (
    Simple("total_solicitudes", "count", "solicitud_key"),
    Simple("solicitudes_confirmadas", "count", "solicitud_key", filter="estado = 'confirmada'"),
    Simple("solicitudes_denegadas", "count", "solicitud_key", filter="estado = 'denegada'"),
    Simple("dias_ausencia_solicitados", "sum", "dias_solicitados"),
    Simple("total_asignaciones_generadas", "sum", "total_asignaciones_generadas"),
    Simple("total_requerimientos", "sum", "total_requerimientos_generados"),
    Ratio("tasa_aprobacion", "solicitudes_confirmadas", "total_solicitudes"),
    Ratio("tasa_denegacion", "solicitudes_denegadas", "total_solicitudes"),
    Ratio("ratio_requerimientos_por_solicitud", "total_requerimientos", "total_solicitudes"),
)
INCIDENT_METRICS = (
    Simple("total_incidencias", "count", "incidencia_key"),
    Simple("incidencias_resueltas", "sum", "es_resuelta"),
    Simple("incidencias_pendientes", "sum", "es_pendiente"),
    Simple("incidencias_tramitadas", "sum", "es_tramitada"),
    Simple("mttr_dias", "average", "dias_resolucion"),
    Ratio("tasa_resolucion", "incidencias_resueltas", "total_incidencias"),
    Ratio("tasa_pendientes", "incidencias_pendientes", "total_incidencias"),
)
