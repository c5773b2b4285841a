"""Bronze-shaped operational inputs derived from the driver's test tables.

The operational source system (users, stations, brigades, overtime, leave
requests, duty roster, assignments, incidents, vehicles, equipment) is not
part of the test data, so each bronze table is a deterministic projection of
a TPC-H-style table.  Every formula is a plain column expression: the bronze
inputs scale with the given tables and keep their partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.functions.columns import date_lit, ts_ntz
from brasa.sources.tables import read_table

# Fixed values of the bindings (kept identical in the oracle SQL).
ORDERS_SHIFT_MONTHS = 300          # 1995..2001 -> 2020..2026
EVENTS_SHIFT_MONTHS = 24           # 2024-01 -> 2026-01
MASTER_CREATED = "2023-01-01 00:00:00"
LOADED_AT = "2026-09-01 00:00:00"
CALENDAR_ORIGIN = "2020-01-01"
USER_EXTRACT_TIMES = ("1900-01-01 00:00:00", "2023-07-01 10:00:00", "2025-11-15 10:00:00")


def _k(name: str) -> Column:
    return F.col(name)


def idiv(col: Column, n: int) -> Column:
    return F.floor(col / F.lit(n)).cast("bigint")


def audit(key: Column, created: Column) -> list[Column]:
    """CREATED_AT / UPDATED_AT / _LOADED_AT of a bronze row."""
    updated = (
        F.when(key % 211 == 0, F.lit(None).cast("timestamp_ntz"))
        .when(key % 103 == 0, created - F.make_dt_interval(F.lit(1)))
        .otherwise(created + F.make_dt_interval((key % 20).cast("int")))
    )
    return [created.alias("CREATED_AT"), updated.alias("UPDATED_AT"),
            ts_ntz(LOADED_AT).alias("_LOADED_AT")]


def shifted_order_date(col: str = "o_orderdate") -> Column:
    return F.add_months(F.to_date(F.col(col)), ORDERS_SHIFT_MONTHS)


def _case(col: Column, mapping: list[tuple], default=None) -> Column:
    expr = None
    for value, label in mapping:
        cond = col == F.lit(value)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


# ---------------------------------------------------------------- master data

def users_base(customer: DataFrame) -> DataFrame:
    k = _k("c_custkey")
    segment_post = _case(F.col("c_mktsegment"), [
        ("AUTOMOBILE", " Conductor "), ("BUILDING", "BOMBERO"),
        ("FURNITURE", "Oficial"), ("MACHINERY", "Coordinador")], None)
    post = (F.when(k % 19 == 0, F.lit("")).when(k % 17 == 0, F.lit("Subinspector"))
            .otherwise(segment_post))
    user_type = _case(k % 4, [(0, "jefe"), (1, "MANDO "), (2, " Bombero")], "empleado")

    def counter(mod: int) -> Column:
        return F.when(k % 5 == 0, F.lit(None).cast("int")).otherwise((k % mod).cast("int"))

    return customer.select(
        k.alias("ID_EMPLEADO"), F.col("c_name").alias("NOMBRE"), user_type.alias("TYPE"),
        post.alias("PUESTO"), counter(7).alias("AP"), counter(23).alias("VACACIONES"),
        counter(3).alias("MODULO"), counter(4).alias("SP"),
        counter(2).alias("COMPENSACION_GRUPOS"), counter(11).alias("HORAS_SINDICALES"),
        F.when(k % 5 == 0, F.lit(None).cast("boolean")).otherwise(k % 6 == 0).alias("MANDO_ESPECIAL"),
        *audit(k, ts_ntz(MASTER_CREATED)),
    )


def users_extract(customer: DataFrame, version: int) -> DataFrame:
    """Successive extracts of the users table (version 1, 2, 3), each one projection of customer.

    Version 2: keys % 11 = 0 are gone (hard delete), posts change for keys % 7 = 0 and a volatile
    counter for keys % 3 = 0.  Version 3: the even deleted keys come back with their first values,
    user types change for keys % 13 = 0 and the command flag flips for keys % 29 = 0.
    """
    base = users_base(customer)
    if version == 1:
        return base
    k = _k("ID_EMPLEADO")
    gone = k % 11 == 0
    changed = {
        "PUESTO": F.when(k % 7 == 0, F.lit("Subinspector")).otherwise(F.col("PUESTO")),
        "VACACIONES": F.when(k % 3 == 0, F.coalesce(F.col("VACACIONES"), F.lit(0)) + 1).otherwise(F.col("VACACIONES")),
    }
    if version == 2:
        return base.filter(~gone).select(*[changed.get(c, F.col(c)).alias(c) for c in base.columns])
    # version 3: returning keys keep their first-extract values
    cols = {c: F.when(gone, F.col(c)).otherwise(e) for c, e in changed.items()}
    cols["TYPE"] = F.when(k % 13 == 0, F.lit("mando")).otherwise(F.col("TYPE"))
    cols["MANDO_ESPECIAL"] = (F.when(k % 29 == 0, ~F.coalesce(F.col("MANDO_ESPECIAL"), F.lit(False)))
                              .otherwise(F.col("MANDO_ESPECIAL")))
    return base.filter(~gone | (k % 2 == 0)).select(*[cols.get(c, F.col(c)).alias(c) for c in base.columns])


def parks(region: DataFrame) -> DataFrame:
    r = _k("r_regionkey")
    return region.select(
        r.cast("bigint").alias("ID_PARQUE"),
        F.when(r % 2 == 0, F.concat(F.lit("  "), F.col("r_name"), F.lit(" "))).otherwise(F.col("r_name")).alias("NOMBRE"),
        F.when(r == 0, F.lit("")).otherwise(F.lower(F.col("r_name"))).alias("UBICACION"),
    )


def brigades(nation: DataFrame) -> DataFrame:
    n = _k("n_nationkey")
    letter = F.char(F.lit(65) + n % 8)
    name = (F.when(n % 5 == 0, letter)
            .when(n % 3 == 0, F.concat(F.lit(" Brigada "), letter, F.lit(" ")))
            .otherwise(F.concat(F.lit("Brigada "), letter)))
    return nation.select(
        n.cast("bigint").alias("ID_BRIGADA"), F.col("n_regionkey").cast("bigint").alias("ID_PARQUE"),
        name.alias("NOMBRE"),
        F.when(n % 4 == 0, F.lit(None).cast("boolean")).otherwise(n % 6 == 0).alias("ESPECIAL"),
    )


def salaries(region: DataFrame) -> DataFrame:
    r = _k("r_regionkey")
    day_cents = F.lit(2000) + F.lit(1000) * ((r + 1) % 2) + F.lit(250) * idiv(r, 2)
    night_cents = idiv(day_cents * 3, 2)
    cent = F.lit(Decimal("0.01"))
    return region.select(
        (r + 1).cast("bigint").alias("ID_SALARIO"), date_lit(CALENDAR_ORIGIN).alias("FECHA_INI"),
        F.when(r % 2 == 0, F.lit("Subinspector")).otherwise(F.lit(" Tropa ")).alias("TIPO"),
        (day_cents.cast("decimal(12,0)") * cent).cast("decimal(10,2)").alias("PRECIO_DIURNO"),
        (night_cents.cast("decimal(12,0)") * cent).cast("decimal(10,2)").alias("PRECIO_NOCTURNO"),
        F.when(r == 4, F.lit(None).cast("int")).otherwise(F.lit(8)).alias("HORAS_DIURNAS"),
        F.lit(16).alias("HORAS_NOCTURNAS"),
    )


def vehicles(supplier: DataFrame) -> DataFrame:
    s = _k("s_suppkey")
    return supplier.select(
        F.concat(F.lit(" V-"), s.cast("string"), F.lit(" ")).alias("MATRICULA"),
        F.col("s_name").alias("NOMBRE"),
        F.when(s % 7 == 0, F.lit("")).otherwise((F.col("s_nationkey") % 5).cast("string")).alias("ID_PARQUE"),
        _case(s % 3, [(0, "Autobomba"), (1, "ESCALA ")], "furgon").alias("TIPO"),
        F.when(s % 9 == 0, F.lit("n/a")).otherwise((F.lit(2000) + s % 25).cast("string")).alias("ANO"),
        *audit(s, ts_ntz(MASTER_CREATED)),
    )


def equipment(part: DataFrame) -> DataFrame:
    p = _k("p_partkey")
    return part.select(
        p.alias("ID"), F.col("p_name").alias("NOMBRE"),
        F.when(p % 23 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" "), F.col("p_type"))).alias("CATEGORIA"),
        F.when(p % 10 == 0, F.lit(None).cast("boolean")).otherwise(F.col("p_size") % 3 != 0).alias("DISPONIBLE"),
        F.when(p % 11 == 0, F.lit("")).when(p % 13 == 0, F.lit("x")).otherwise((p % 5).cast("string")).alias("PARQUE"),
        *audit(p, ts_ntz(MASTER_CREATED)),
    )


# ------------------------------------------------------------ operational data

def _shift(orders: DataFrame) -> DataFrame:
    return orders.withColumn("_d", shifted_order_date())


def _turno(k: Column) -> Column:
    return _case(k % 3, [(0, "Mañana"), (1, " tarde")], "NOCHE ")


def extra_hours(orders: DataFrame) -> DataFrame:
    k = _k("o_orderkey")
    d = F.col("_d")
    return _shift(orders).select(
        k.alias("ID"),
        F.when(k % 53 == 0, F.add_months(d, -360)).otherwise(d).alias("DATE"),
        F.col("o_custkey").alias("ID_EMPLEADO"),
        F.when(k % 97 == 0, F.lit(None).cast("bigint")).when(k % 89 == 0, F.lit(9).cast("bigint"))
        .otherwise(k % 5 + 1).alias("ID_SALARIO"),
        F.when(k % 37 == 0, F.lit(None).cast("int")).otherwise((k % 16).cast("int")).alias("HORAS_DIURNAS"),
        (k % 9).cast("int").alias("HORAS_NOCTURNAS"),
        *audit(k, d.cast("timestamp_ntz")),
    )


def guards(orders: DataFrame) -> DataFrame:
    """Duty roster: two brigades per operating day, some days missing."""
    days = (_shift(orders).select(F.col("_d").alias("DATE")).distinct()
            .withColumn("_n", F.datediff(F.col("DATE"), date_lit(CALENDAR_ORIGIN)).cast("bigint"))
            .filter(F.col("_n") % 13 != 0))
    n = F.col("_n")
    rows = days.withColumn("_j", F.explode(F.array(F.lit(0), F.lit(1))))
    j = F.col("_j")
    brigade = (n + 8 * j) % 25
    gid = 2 * n + j
    return rows.select(
        gid.alias("ID"), F.col("DATE"), brigade.cast("bigint").alias("ID_BRIGADA"),
        (brigade % 5).cast("bigint").alias("ID_PARQUE"), (j + 1).cast("bigint").alias("ID_SALARIO"),
        _case(n % 4, [(0, "Laborable "), (1, "festivo"), (2, " PREFESTIVO")], "Festivo Víspera").alias("TIPO"),
        _case(n % 3, [(0, " "), (2, "retén")], None).alias("ESPECIALES"),
        *audit(gid, F.col("DATE").cast("timestamp_ntz")),
    )


def requests(orders: DataFrame) -> DataFrame:
    k = _k("o_orderkey")
    d = F.col("_d")
    start = (F.when(k % 71 == 0, F.lit(None).cast("date"))
             .when(k % 59 == 0, F.add_months(d, -360)).otherwise(d))
    end = (F.when(k % 5 == 0, F.lit(None).cast("date"))
           .when(k % 101 == 0, F.date_sub(start, 3))
           .otherwise(F.date_add(start, (k % 10).cast("int"))))
    kind = _case(k % 9, [
        (0, "Vacaciones"), (1, "asuntos propios "), (2, "HORAS SINDICALES"),
        (3, "salidas personales"), (4, "vestuario"), (5, " licencias por jornadas"),
        (6, "licencias por dias"), (7, "modulo")], "compensacion grupos especiales")
    state = (F.when(F.col("o_orderstatus") == "F", F.lit("Confirmada"))
             .when(F.col("o_orderstatus") == "O", F.lit(" pendiente"))
             .when(k % 2 == 0, F.lit("DENEGADA")).otherwise(F.lit("cancelada ")))
    created = d.cast("timestamp_ntz") - F.make_dt_interval((k % 30).cast("int"))
    return _shift(orders).select(
        k.alias("ID"), F.col("o_custkey").alias("ID_EMPLEADO"),
        F.when(k % 7 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey") + 1).alias("ID_EMPLEADO2"),
        kind.alias("TIPO"), start.alias("FECHA_INI"), end.alias("FECHA_FIN"),
        F.when(k % 6 == 0, F.lit(None).cast("int")).otherwise((k % 8).cast("int")).alias("HORAS"),
        _turno(k).alias("TURNO"), state.alias("ESTADO"),
        *audit(k, created),
    )


def assignments(orders: DataFrame) -> DataFrame:
    k = _k("o_orderkey")
    d = F.col("_d")
    rows = _shift(orders).withColumn("_j", F.explode(F.array(F.lit(0), F.lit(1))))
    j = F.col("_j")
    aid = 2 * k + j
    return rows.select(
        aid.alias("ID_ASIGNACION"),
        F.when(k % 53 == 0, F.add_months(d, -360)).otherwise(F.date_add(d, j)).alias("FECHA_INI"),
        F.col("o_custkey").alias("ID_EMPLEADO"),
        F.when(k % 17 == 0, F.lit(None).cast("bigint")).otherwise(k % 25).alias("ID_BRIGADA_ORIGEN"),
        ((k + 3) % 25).alias("ID_BRIGADA_DESTINO"),
        _turno(k).alias("TURNO"),
        F.when(k % 3 == 0, k).alias("ID_REQUEST"),
        F.when(k % 10 == 0, k).alias("ID_CHANGE_REQUEST"),
        F.when(k % 7 == 0, F.lit(None).cast("boolean")).otherwise((k + j) % 4 == 0).alias("REQUERIMIENTO"),
        F.when(j == 0, F.lit(" IDA")).otherwise(F.lit("Vuelta ")).alias("TIPO_ASIGNACION"),
        F.when(k % 8 == 0, k).alias("ID_TRANSFER"),
        *audit(aid, d.cast("timestamp_ntz")),
    )


def shift_changes(orders: DataFrame) -> DataFrame:
    k = _k("o_orderkey")
    d = F.col("_d")
    state = _case(idiv(k, 10) % 4, [(0, "Rechazado"), (1, "aceptado_por_empleados"), (2, " EN_TRAMITE")], "aceptado")
    return _shift(orders).select(
        k.alias("ID"), F.col("o_custkey").alias("ID_EMPLEADO1"),
        (F.col("o_custkey") + 1).alias("ID_EMPLEADO2"),
        F.when(k % 20 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey") + 2).alias("ID_EMPLEADO3"),
        (k % 25).alias("BRIGADA1"), ((k + 1) % 25).alias("BRIGADA2"),
        d.alias("FECHA"), F.date_add(d, 7).alias("FECHA2"),
        state.alias("ESTADO"), _turno(k).alias("TURNO"),
        *audit(k, d.cast("timestamp_ntz")),
    )


def incidents(events: DataFrame, supplier: DataFrame, part: DataFrame, customer: DataFrame) -> DataFrame:
    """Incidents know as many vehicles, pieces of equipment and resolvers as there are suppliers, parts and customers."""
    i = _k("event_id")
    vehicles_n, equipment_n, people_n = (t.agg(F.count(F.lit(1))).scalar() for t in (supplier, part, customer))
    created = (F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz")
               + F.make_ym_interval(F.lit(EVENTS_SHIFT_MONTHS // 12), F.lit(0)))
    kind = (F.when(i % 10 == 9, F.lit("equipos_comunes"))
            .otherwise(_case(F.col("event_type"), [
                ("click", "Vehiculo"), ("error", " equipo"), ("purchase", "PERSONAL"),
                ("signup", "instalacion ")], "vestuario")))
    level = (F.when(i % 8 == 3, F.lit("")).when(i % 8 == 7, F.lit(None).cast("string"))
             .otherwise(_case(i % 4, [(0, "ALTO"), (1, "medio ")], " bajo")))
    equipo = (F.when(i % 5 == 0, F.lit(None).cast("string"))
              .when(i % 13 == 0, F.lit("n/a"))
              .when(i % 17 == 0, F.concat((i % equipment_n).cast("string"), F.lit(".7")))
              .when(i % 2 == 0, F.concat(F.lit(" "), (i % equipment_n).cast("string"), F.lit(" ")))
              .otherwise((i % equipment_n).cast("string")))
    resolver = (F.when(i % 3 == 1, F.lit(None).cast("string"))
                .when(i % 50 == 0, F.lit("x"))
                .otherwise(((F.col("user_id") * 7) % people_n + i % 3).cast("string")))
    return events.select(
        i.alias("ID_INCIDENCIA"), F.col("user_id").alias("ID_EMPLEADO"), kind.alias("TIPO"),
        _case(i % 3, [(0, "Resuelta"), (1, "pendiente ")], "TRAMITADA").alias("ESTADO"),
        level.alias("NIVEL"), F.to_date(created).alias("FECHA"),
        (F.col("user_id") % 5).alias("ID_PARQUE"),
        F.when(i % 4 == 0, F.lit(None).cast("string")).when(i % 9 == 0, F.lit(" "))
        .otherwise(F.concat(F.lit("V-"), (i % vehicles_n).cast("string"))).alias("MATRICULA"),
        F.when(i % 10 == 0, F.lit("x")).otherwise((F.col("user_id") + 1).cast("string")).alias("ID_EMPLEADO2"),
        equipo.alias("EQUIPO"), resolver.alias("RESULTA_POR"),
        F.when(i % 7 == 0, F.lit(None).cast("boolean")).otherwise(i % 2 == 0).alias("LEIDO"),
        _case(i % 6, [(0, " Radio "), (1, "")], None).alias("NOMBRE_EQUIPO"),
        *audit(i, created),
    )


@dataclass
class Bronze:
    """Lazy handles on every bronze input of one dataset directory."""

    spark: SparkSession
    sf_dir: str

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def table(self, name: str, version: int = 3) -> DataFrame:
        r = self.raw
        if name == "users":
            return users_extract(r("customer"), version)
        builders = {
            "parks": lambda: parks(r("region")),
            "brigades": lambda: brigades(r("nation")),
            "salaries": lambda: salaries(r("region")),
            "vehicles": lambda: vehicles(r("supplier")),
            "equipos_personales": lambda: equipment(r("part")),
            "extra_hours": lambda: extra_hours(r("orders")),
            "guards": lambda: guards(r("orders")),
            "requests": lambda: requests(r("orders")),
            "firefighters_assignments": lambda: assignments(r("orders")),
            "shift_change_requests": lambda: shift_changes(r("orders")),
            "incidents": lambda: incidents(r("events"), r("supplier"), r("part"), r("customer")),
        }
        return builders[name]()
