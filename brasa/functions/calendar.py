"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_parts(col: str = "fecha") -> dict[str, Column]:
    d = F.col(col)
    iso_dow = F.extract(F.lit("DAYOFWEEK_ISO"), d)
    return {
        "anio": F.year(d).cast("bigint"),
        "trimestre": F.quarter(d).cast("bigint"),
        "mes": F.month(d).cast("bigint"),
        "mes_nombre": F.date_format(d, "MMM"),
        "semana_anio": F.weekofyear(d).cast("bigint"),
        "dia": F.dayofmonth(d).cast("bigint"),
        "dia_semana_num": iso_dow.cast("bigint"),
        "dia_semana_nombre": F.date_format(d, "EEE"),
    }
