"""Queries that exercise each operator of the library on the raw test tables.

Every query reads whole tables (no sampling, no id subsets) and is checked
against an independent DuckDB statement in ``oracles/operators.py``.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brasa.functions.calendar import calendar_parts
from brasa.functions.columns import (
    DEC2, attention_priority, avg_dec, band, clean_text, date_lit, flag_eq, indicator, pct, ratio,
    round_dec, safe_number, surrogate_key, trim_null,
)
from brasa.operators import incremental as inc
from brasa.operators import metrics as M
from brasa.operators.quality import Check, failures, quality_report
from brasa.operators.asof import asof_join
from brasa.operators.dedup import first_per_key
from brasa.operators.ranking import Order, RankSpec, add_ranks, attach_group_stats
from brasa.plans.staging import resolution_days
from brasa.sources.freshness import freshness
from brasa.sources.tables import read_table

OPERATOR_QUERIES: dict = {}


def q(name: str):
    def deco(fn):
        OPERATOR_QUERIES[name] = fn
        return fn
    return deco


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def money(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("decimal(18,2)")


def odate() -> Column:
    return F.to_date("o_orderdate")


# ---------------------------------------------------------------- S: sources and sinks

def typed_orders(spark, sf) -> DataFrame:
    return T(spark, sf, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("id_pedido"), F.col("o_custkey").cast("bigint").alias("id_cliente"),
        odate().alias("fecha"), money("o_totalprice").alias("importe"), clean_text("o_orderstatus").alias("estado"),
        clean_text("o_orderpriority").alias("prioridad"))


@q("s1_source_scan")
def s1(spark, sf):
    return typed_orders(spark, sf)


@q("s3_source_freshness")
def s3(spark, sf):
    ev = T(spark, sf, "events")
    out = None
    for as_of in ("2024-02-15", "2024-03-15", "2024-06-01"):
        f = freshness(ev, "ts", as_of)
        out = f if out is None else out.unionByName(f)
    return out


@q("s3b_freshness_of_all_sources")
def s3b(spark, sf):
    """Every bronze table on its load column; the shift changes' check is switched off."""
    from brasa.sources.freshness import freshness_of_all
    return freshness_of_all(_wh(spark, sf).bronze, "2026-10-15", disabled=("shift_change_requests",))


@q("s3c_freshness_from_footers")
def s3c(spark, sf):
    """The checks of s3 on a stored table, whose newest load time and row count come from the files' footers."""
    from brasa.session import new_table_path
    from brasa.sources.footers import footer_extremes, marked_time, with_mark
    path = new_table_path(spark, "s3c_events")
    with_mark(T(spark, sf, "events"), "ts", "marca").write.parquet(path)
    ends = footer_extremes(spark, [path], ["marca"])
    ends = spark.range(1).select(*[ends.select(c).scalar().alias(c) for c in ("n", "max_marca")])
    rows = ends.select(F.col("n").alias("filas"), marked_time(F.col("max_marca")).alias("ts"))
    return reduce(DataFrame.unionByName, [
        freshness(rows, "ts", as_of).withColumn("filas", rows.select("filas").scalar()) for as_of in ("2024-02-15", "2024-03-15", "2024-06-01")])


@q("s4_view_sink")
def s4(spark, sf):
    typed_orders(spark, sf).createOrReplaceTempView("brasa_pedidos")
    return spark.sql("SELECT estado, prioridad, count(*) AS pedidos, sum(importe) AS importe "
                     "FROM brasa_pedidos GROUP BY estado, prioridad")


@q("s5_table_sink")
def s5(spark, sf):
    return inc.publish(spark, typed_orders(spark, sf), "s5_orders")


def _orders_split(spark, sf):
    o = typed_orders(spark, sf)
    target = o.filter(F.col("fecha") < date_lit("1999-01-01"))
    delta = (o.filter(F.col("fecha") >= date_lit("1998-12-25"))
             .withColumn("importe", (F.col("importe") + F.lit(Decimal("1.00"))).cast("decimal(18,2)")))
    return target, delta


@q("s6_incremental_merge_sink")
def s6(spark, sf):
    target, delta = _orders_split(spark, sf)
    published = inc.publish(spark, target, "s6_target")
    return inc.publish(spark, inc.upsert(published, delta, "id_pedido"), "s6_merged")


@q("s7_guarded_create")
def s7(spark, sf):
    from brasa.session import new_table_path
    path = new_table_path(spark, "s7_guarded")
    nation = T(spark, sf, "nation")
    inc.guarded_create(spark, nation.filter(F.col("n_regionkey") == 0), path)
    refused = False
    try:
        inc.guarded_create(spark, nation, path)
    except RuntimeError:
        refused = True
    inc.guarded_create(spark, nation, path, force=True)
    return spark.read.parquet(path).select("n_nationkey", "n_name", "n_regionkey", F.lit(refused).alias("refused_without_force"))


# ---------------------------------------------------------------- P: projections and predicates

@q("p2_derived_columns")
def p2(spark, sf):
    o = typed_orders(spark, sf)
    return o.select("*", (F.col("importe") * F.lit(Decimal("1.21"))).cast("decimal(18,4)").alias("importe_con_iva"),
                    F.year("fecha").cast("bigint").alias("anio"))


@q("p3_date_floor_filter")
def p3(spark, sf):
    return typed_orders(spark, sf).filter(F.col("fecha") >= date_lit("1996-01-01")).select("id_pedido", "fecha")


def nullable_date(spark, sf) -> DataFrame:
    o = T(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(k.alias("id_pedido"), F.when(k % 7 == 0, F.lit(None).cast("date")).otherwise(odate()).alias("fecha"))


@q("p4_null_tolerant_filter")
def p4(spark, sf):
    d = nullable_date(spark, sf)
    return d.filter(F.col("fecha").isNull() | (F.col("fecha") >= date_lit("1998-01-01")))


@q("p5_half_open_window")
def p5(spark, sf):
    l = T(spark, sf, "lineitem")
    d = F.to_date("l_shipdate")
    return l.filter((d >= date_lit("1996-01-01")) & (d < date_lit("1997-01-01"))).select(
        "l_orderkey", "l_linenumber", d.alias("fecha_envio"))


@q("p6_membership")
def p6(spark, sf):
    return T(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_orderpriority")


@q("p7_range_predicate")
def p7(spark, sf):
    return T(spark, sf, "lineitem").filter(F.col("l_discount").between(0.02, 0.05)).select(
        "l_orderkey", "l_linenumber", money("l_discount").alias("descuento"))


def keyed_orders(spark, sf) -> DataFrame:
    k = F.col("o_custkey")
    key = F.when(k % 13 == 0, F.lit(None).cast("string")).when(k % 10 == 0, F.lit("-1")).otherwise(surrogate_key(k))
    return T(spark, sf, "orders").select("o_orderkey", key.alias("cliente_key"))


@q("p8_known_member_filter")
def p8(spark, sf):
    o = keyed_orders(spark, sf)
    return o.filter(F.col("cliente_key").isNotNull() & (F.col("cliente_key") != "-1"))


def dirty_segment(spark, sf) -> DataFrame:
    c = T(spark, sf, "customer")
    k = F.col("c_custkey")
    seg = F.when(k % 9 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("  "), F.upper("c_mktsegment"), F.lit(" ")))
    return c.select(k.alias("id_cliente"), seg.alias("segmento_sucio"))


@q("p9_category_mapping")
def p9(spark, sf):
    d = dirty_segment(spark, sf)
    s = clean_text("segmento_sucio")
    cat = (F.when(s.isin("automobile", "building"), F.lit("industria"))
           .when(s.isin("furniture", "household"), F.lit("hogar"))
           .when(s.isNull(), F.lit("sin_dato")).otherwise(F.lit("otros")))
    return d.select("id_cliente", cat.alias("categoria"))


@q("p10_numeric_bands")
def p10(spark, sf):
    o = T(spark, sf, "orders")
    bands = [(50000, "bajo"), (150000, "medio"), (300000, "alto"), (450000, "muy_alto")]
    return o.select("o_orderkey", band(F.col("o_totalprice"), bands, "extremo").alias("tramo_importe"))


def event_age(spark, sf) -> DataFrame:
    e = T(spark, sf, "events")
    level = F.when(F.col("event_type") == "error", F.lit("alto")).when(F.col("event_type") == "purchase", F.lit("medio")) \
             .when(F.col("event_type") == "view", F.lit("bajo"))
    days = F.floor(F.col("value") / 2).cast("bigint")
    return e.select("event_id", level.alias("nivel"), days.alias("dias"))


@q("p11_priority_matrix")
def p11(spark, sf):
    e = event_age(spark, sf)
    return e.select("event_id", attention_priority("nivel", "dias").alias("prioridad"))


@q("p12_boolean_flags")
def p12(spark, sf):
    o = T(spark, sf, "orders")
    st = F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus"))
    o = o.select("o_orderkey", st.alias("estado"))
    return o.select("o_orderkey", flag_eq("estado", "F").alias("es_f"), flag_eq("estado", "O").alias("es_o"),
                    flag_eq("estado", "P").alias("es_p"))


@q("p13_indicator_measures")
def p13(spark, sf):
    l = T(spark, sf, "lineitem")
    return l.select("l_orderkey", "l_linenumber",
                    indicator(F.col("l_returnflag") == "R").cast("bigint").alias("es_devuelta"),
                    indicator(F.col("l_linestatus") == "O").cast("bigint").alias("es_abierta"),
                    F.lit(1).cast("bigint").alias("total_lineas"))


def orders_lines(spark, sf) -> DataFrame:
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return T(spark, sf, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")


@q("p14_guarded_duration")
def p14(spark, sf):
    j = orders_lines(spark, sf)
    state = F.when(F.col("l_linestatus") == "F", F.lit("resuelta")).otherwise(F.lit("abierta"))
    days = resolution_days(state, F.col("o_orderdate"), F.col("l_shipdate"), max_days=120, floor_date="1995-01-01")
    return j.select("l_orderkey", "l_linenumber", days.alias("dias_resolucion"))


@q("p15_inclusive_duration")
def p15(spark, sf):
    j = orders_lines(spark, sf)
    ship = F.when(F.col("l_linenumber") % 5 == 0, F.lit(None).cast("date")).otherwise(F.to_date("l_shipdate"))
    start = F.to_date("o_orderdate")
    d = F.when(ship.isNotNull() & start.isNotNull(), F.datediff(ship, start) + 1).otherwise(F.lit(1))
    return j.select("l_orderkey", "l_linenumber", d.cast("bigint").alias("dias"))


@q("p16_null_group_label")
def p16(spark, sf):
    l = T(spark, sf, "lineitem")
    flag = F.when(F.col("l_linenumber") % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("l_returnflag"))
    return l.groupBy(F.coalesce(flag, F.lit("sin_clasificar")).alias("indicador")).agg(
        F.count(F.lit(1)).alias("lineas"))


@q("p17_row_cost")
def p17(spark, sf):
    l = T(spark, sf, "lineitem")
    hours_day = F.col("l_linenumber").cast("decimal(38,0)")
    hours_night = (F.col("l_orderkey") % 5).cast("decimal(38,0)")
    price_day = ((F.col("l_partkey") % 4000 + 1000).cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)")
    price_night = ((F.col("l_suppkey") % 3000 + 1500).cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)")
    return l.select("l_orderkey", "l_linenumber",
                    (hours_day * price_day).cast("decimal(12,2)").alias("coste_diurno"),
                    (hours_night * price_night).cast("decimal(12,2)").alias("coste_nocturno"),
                    (hours_day * price_day + hours_night * price_night).cast("decimal(12,2)").alias("coste_total"))


@q("p18_conditional_effective_date")
def p18(spark, sf):
    e = T(spark, sf, "events")
    eff = F.when((F.col("event_type") == "purchase") & F.col("user_id").isNotNull(), F.col("ts"))
    return e.select("event_id", eff.alias("fecha_efecto"))


# ---------------------------------------------------------------- F: scalar functions

@q("f1_clean_text")
def f1(spark, sf):
    return dirty_segment(spark, sf).select("id_cliente", clean_text("segmento_sucio").alias("segmento"))


@q("f2_trim_null")
def f2(spark, sf):
    return dirty_segment(spark, sf).select("id_cliente", trim_null("segmento_sucio").alias("segmento"))


@q("f3_upper_twin")
def f3(spark, sf):
    c = T(spark, sf, "customer")
    return c.select("c_custkey", "c_name", F.upper(trim_null("c_name")).alias("nombre_normalizado"))


@q("f4_coalesce_default")
def f4(spark, sf):
    c = T(spark, sf, "customer")
    bal = F.when(F.col("c_custkey") % 6 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal"))
    return c.select("c_custkey", money(F.coalesce(bal, F.lit(0.0))).alias("saldo"))


def text_numbers(spark, sf) -> DataFrame:
    e = T(spark, sf, "events")
    i = F.col("event_id")
    txt = (F.when(i % 10 == 0, F.lit("x")).when(i % 10 == 1, F.lit(""))
           .when(i % 10 == 2, F.concat(F.lit(" "), i.cast("string"), F.lit(" ")))
           .when(i % 10 == 3, F.concat(i.cast("string"), F.lit(".7")))
           .when(i % 10 == 4, F.lit(None).cast("string")).otherwise(i.cast("string")))
    return e.select("event_id", txt.alias("texto"))


@q("f5_safe_number")
def f5(spark, sf):
    return text_numbers(spark, sf).select("event_id", "texto", safe_number("texto").cast("bigint").alias("numero"))


@q("f6_strict_casts")
def f6(spark, sf):
    o = T(spark, sf, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("clave_texto"), odate().alias("fecha"),
                    F.col("o_orderdate").cast("timestamp_ntz").alias("momento"),
                    money("o_totalprice").alias("importe"), (F.col("o_orderstatus") == "F").cast("boolean").alias("cerrado"),
                    F.col("o_custkey").cast("decimal(38,0)").cast("bigint").alias("cliente"))


@q("f7_surrogate_key")
def f7(spark, sf):
    o = T(spark, sf, "orders")
    k = F.when(F.col("o_orderkey") % 9 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey"))
    return o.select("o_orderkey", surrogate_key("o_orderkey").alias("pedido_key"),
                    surrogate_key(k, odate()).alias("cliente_fecha_key"))


@q("f8_md5_concat")
def f8(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit("|"),
                                                 F.col("o_orderdate").cast("string"))).alias("scd_id"))


def order_days(spark, sf) -> DataFrame:
    return T(spark, sf, "orders").select(odate().alias("fecha")).distinct()


@q("f9_calendar_parts")
def f9(spark, sf):
    parts = calendar_parts("fecha")
    keep = ["anio", "trimestre", "mes", "semana_anio", "dia", "dia_semana_num"]
    return order_days(spark, sf).select("fecha", *[parts[k].alias(k) for k in keep])


@q("f10_month_day_names")
def f10(spark, sf):
    parts = calendar_parts("fecha")
    return order_days(spark, sf).select("fecha", parts["mes_nombre"].alias("mes_nombre"),
                                        parts["dia_semana_nombre"].alias("dia_semana_nombre"))


@q("f11_trunc_month")
def f11(spark, sf):
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.trunc("l_shipdate", "MM").alias("mes"))


@q("f12_day_difference")
def f12(spark, sf):
    j = orders_lines(spark, sf)
    return j.select("l_orderkey", "l_linenumber", F.datediff("l_shipdate", "o_orderdate").cast("bigint").alias("dias"))


@q("f13_subtract_days")
def f13(spark, sf):
    e = T(spark, sf, "events")
    return e.select("event_id", F.date_format(F.col("ts") - F.make_dt_interval(F.lit(7)), "yyyy-MM-dd HH:mm:ss")
                    .cast("timestamp_ntz").alias("hace_una_semana"))


@q("f14_as_of_date")
def f14(spark, sf):
    return T(spark, sf, "orders").select(
        "o_orderkey", F.datediff(date_lit("2002-01-01"), F.col("o_orderdate")).cast("bigint").alias("antiguedad_dias"))


@q("f15_round_half_up")
def f15(spark, sf):
    l = T(spark, sf, "lineitem")
    g = l.groupBy("l_suppkey").agg(F.sum(money("l_quantity")).alias("q"), F.count(F.lit(1)).alias("n"))
    return g.select("l_suppkey", round_dec(ratio("q", "n", 2, 0), 3).alias("media_3"),
                    round_dec(ratio("q", "n", 2, 0), 2).alias("media_2"))


@q("f16_abs_arith_nullif")
def f16(spark, sf):
    c = T(spark, sf, "customer")
    bal = money("c_acctbal")
    return c.select("c_custkey", F.abs(bal).alias("saldo_abs"),
                    round_dec(ratio(bal, F.col("c_nationkey") % 3, 2, 0), 2).alias("saldo_por_grupo"),
                    (bal - F.lit(Decimal("100.00"))).cast("decimal(18,2)").alias("saldo_menos_100"))


@q("f17_bounds_defence")
def f17(spark, sf):
    j = orders_lines(spark, sf)
    d = F.datediff("l_shipdate", "o_orderdate")
    ok = (F.col("o_orderdate") >= date_lit("1995-01-01").cast("timestamp_ntz")) & d.between(0, 90)
    return j.select("l_orderkey", "l_linenumber", F.when(ok, d).cast("bigint").alias("dias_validos"))


# ---------------------------------------------------------------- J: joins

@q("j1_parent_name_join")
def j1(spark, sf):
    n = T(spark, sf, "nation")
    r = T(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), trim_null("r_name").alias("nombre_region"))
    return n.join(r, "n_regionkey", "left").select("n_nationkey", trim_null("n_name").alias("nombre"), "nombre_region")


@q("j2_fact_dimension_join")
def j2(spark, sf):
    l = T(spark, sf, "lineitem").select(surrogate_key("l_partkey").alias("parte_key"), "l_quantity")
    p = T(spark, sf, "part").select(surrogate_key("p_partkey").alias("parte_key"), "p_brand")
    return l.join(p, "parte_key", "left").groupBy("p_brand").agg(
        F.sum(money("l_quantity")).cast("decimal(28,2)").alias("cantidad"), F.count(F.lit(1)).alias("lineas"))


@q("j2b_colocated_join")
def j2b(spark, sf):
    """j2 with fact and dimension stored in buckets of the key: the join moves no fact row."""
    from brasa.operators.colocated import BucketedFact, bucketed
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    l = T(spark, sf, "lineitem").select(surrogate_key("l_partkey").alias("parte_key"), "l_quantity")
    p = T(spark, sf, "part").select(surrogate_key("p_partkey").alias("parte_key"), "p_brand")
    fact = BucketedFact(spark, l, "j2b_lines", "parte_key", n)
    return fact.left_join(bucketed(spark, p, "j2b_parts", "parte_key", n)).groupBy("p_brand").agg(
        F.sum(money("l_quantity")).cast("decimal(28,2)").alias("cantidad"), F.count(F.lit(1)).alias("lineas"))


@q("j3_star_join")
def j3(spark, sf):
    l = T(spark, sf, "lineitem")
    p = T(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), surrogate_key("p_partkey").alias("pk"), "p_type")
    s = T(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    o = T(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    n = T(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    star = (l.withColumn("pk", surrogate_key("l_partkey")).join(p.drop("l_partkey"), "pk", "left")
            .join(s, "l_suppkey", "left").join(o, "l_orderkey", "left").join(n, "s_nationkey", "left"))
    return star.groupBy("p_type", "n_regionkey", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("lineas"), F.sum(money("l_extendedprice")).cast("decimal(28,2)").alias("importe"))


def days_of(*dates: DataFrame) -> DataFrame:
    """One row (fecha) for each day from the first to the last date of one-column frames."""
    ends = [d.toDF("d").agg(F.min("d").alias("lo"), F.max("d").alias("hi")) for d in dates]
    ends = reduce(DataFrame.unionByName, ends).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo is not null")
    return ends.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("fecha"))


def order_calendar(spark, sf) -> DataFrame:
    """The days from the first to the last order or shipment."""
    return days_of(T(spark, sf, "orders").select(odate()), T(spark, sf, "lineitem").select(F.to_date("l_shipdate")))


@q("j4_calendar_join")
def j4(spark, sf):
    cal = order_calendar(spark, sf).select("fecha", calendar_parts("fecha")["dia_semana_num"].alias("dia_semana_num"))
    o = T(spark, sf, "orders").select(odate().alias("fecha"), "o_orderkey")
    return o.join(cal, "fecha", "left").groupBy("dia_semana_num").agg(F.count(F.lit(1)).alias("pedidos"))


def _shifted_orders(spark, sf) -> DataFrame:
    from brasa.sources.bronze import shifted_order_date
    return T(spark, sf, "orders").select("o_orderkey", "o_custkey", shifted_order_date().alias("fecha"))


@q("j5_asof_join")
def j5(spark, sf):
    from brasa.registry import warehouse
    dim = warehouse(spark, sf).dim_empleado
    o = _shifted_orders(spark, sf)
    return asof_join(o, dim, "o_custkey", "fecha", "empleado_key").select("o_orderkey", "fecha", "empleado_key")


@q("j5b_asof_by_order")
def j5b(spark, sf):
    """j5 by merging orders and versions in order of time."""
    from brasa.operators.asof import asof_by_order
    from brasa.registry import warehouse
    dim = warehouse(spark, sf).dim_empleado
    o = _shifted_orders(spark, sf)
    return asof_by_order(o, dim, "o_custkey", "fecha", "empleado_key").select("o_orderkey", "fecha", "empleado_key")


@q("j6_role_playing_asof")
def j6(spark, sf):
    from brasa.registry import warehouse
    dim = warehouse(spark, sf).dim_empleado
    o = _shifted_orders(spark, sf).withColumn("revisor", (F.col("o_custkey") * 7 + 3) % T(spark, sf, "customer").agg(F.count(F.lit(1))).scalar()) \
        .withColumn("fecha_revision", F.when(F.col("o_orderkey") % 4 == 0, F.lit(None).cast("date"))
                    .otherwise(F.date_add("fecha", 30)))
    o = asof_join(o, dim, "o_custkey", "fecha", "creador_key")
    o = asof_join(o, dim, "revisor", "fecha_revision", "_rev")
    rev = F.when(F.col("fecha_revision").isNotNull(), F.col("_rev"))
    return o.select("o_orderkey", "creador_key", rev.alias("revisor_key"))


@q("j7_interval_calendar_join")
def j7(spark, sf):
    """Closed orders as day intervals, counted per calendar day without expanding them."""
    from brasa.operators.intervals import active_per_day
    o = T(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", odate().alias("inicio"),
        F.when(F.col("o_orderkey") % 6 == 0, F.lit(None).cast("date"))
        .when(F.col("o_orderkey") % 23 == 0, F.date_sub(odate(), 2))
        .otherwise(F.date_add(odate(), (F.col("o_orderkey") % 10).cast("int"))).alias("fin"))
    return active_per_day(o, "inicio", "fin", order_calendar(spark, sf),
                          {"activos": F.lit(1)})


@q("j7b_distinct_active_per_day")
def j7b(spark, sf):
    """Customers with an open order per day; a customer's orders overlap, and each customer counts once."""
    from brasa.operators.intervals import distinct_active_per_day
    key = F.col("o_orderkey")
    o = T(spark, sf, "orders").select(
        "o_custkey", "o_orderpriority", odate().alias("inicio"),
        F.when(key % 6 == 0, F.lit(None).cast("date")).when(key % 23 == 0, F.date_sub(odate(), 2))
        .otherwise(F.date_add(odate(), (key % 200).cast("int"))).alias("fin"))
    return distinct_active_per_day(o, "o_custkey", "inicio", "fin", order_calendar(spark, sf), {
        "clientes": F.lit(True), "clientes_urgentes": F.col("o_orderpriority") == "1-URGENT"})


@q("j8_grand_total_share")
def j8(spark, sf):
    l = T(spark, sf, "lineitem").select("l_returnflag", money("l_quantity").alias("q"))
    grouped = l.groupBy("l_returnflag").agg(F.sum("q").alias("_q"))
    grouped = attach_group_stats(grouped, [], {"_total": F.sum("_q")})  # the total of the groups, not of the rows
    return grouped.select("l_returnflag", F.col("_q").cast("decimal(28,2)").alias("cantidad"),
                          pct(F.col("_q"), F.col("_total"), 2, 2).alias("pct_sobre_total"))


@q("j9_preaggregated_child_join")
def j9(spark, sf):
    child = T(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("_r"))
    o = T(spark, sf, "orders").select("o_orderkey")
    return o.join(child, "o_orderkey", "left").select(
        "o_orderkey", F.coalesce("_n", F.lit(0)).cast("bigint").alias("lineas"),
        F.coalesce("_r", F.lit(0)).cast("bigint").alias("devueltas"))


@q("j10_deduplicated_child_join")
def j10(spark, sf):
    o = T(spark, sf, "orders").select(odate().alias("fecha"), "o_orderpriority", "o_orderstatus", "o_orderkey")
    collapsed = o.groupBy("fecha", "o_orderpriority").agg(F.min("o_orderstatus").alias("estado"),
                                                          F.min("o_orderkey").alias("pedido_representante"))
    first = first_per_key(collapsed, ["fecha"], ["o_orderpriority"],
                          columns=["fecha", "estado", "pedido_representante"])
    l = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("fecha"))
    return l.join(first, "fecha", "left").select("l_orderkey", "l_linenumber", "estado", "pedido_representante")


@q("j11_daily_three_way_join")
def j11(spark, sf):
    cal = order_calendar(spark, sf)
    o = T(spark, sf, "orders").groupBy(odate().alias("fecha")).agg(F.count(F.lit(1)).alias("_pedidos"))
    l = T(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("fecha")).agg(F.count(F.lit(1)).alias("_envios"))
    j = cal.join(o, "fecha", "left").join(l, "fecha", "left")
    return j.select("fecha", F.coalesce("_pedidos", F.lit(0)).cast("bigint").alias("pedidos"),
                    F.coalesce("_envios", F.lit(0)).cast("bigint").alias("envios"))


def monthly_order_totals(spark, sf):
    o = T(spark, sf, "orders").groupBy(F.trunc("o_orderdate", "MM").alias("mes")).agg(
        F.sum(money("o_totalprice")).cast("decimal(28,2)").alias("total_pedidos"))
    l = (T(spark, sf, "lineitem").join(T(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"),
                                       "l_orderkey")
         .groupBy(F.trunc("o_orderdate", "MM").alias("mes"))
         .agg(F.sum(money("l_extendedprice")).cast("decimal(28,2)").alias("total_lineas")))
    return o, l


@q("j12_reconciliation_join")
def j12(spark, sf):
    o, l = monthly_order_totals(spark, sf)
    j = o.join(l, "mes", "inner")
    return j.filter(F.abs(F.col("total_pedidos") - F.col("total_lineas")) > F.lit(Decimal("0.01"))).select(
        "mes", "total_pedidos", "total_lineas", (F.col("total_pedidos") - F.col("total_lineas")).alias("diferencia"))


@q("j13_scalar_subquery_filter")
def j13(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return inc.lookback_delta(o, o, "o_orderdate", days=7)


@q("j14_referential_anti_join")
def j14(spark, sf):
    from brasa.operators.quality import relationship_failures
    l = T(spark, sf, "lineitem")
    orders = T(spark, sf, "orders")
    part = T(spark, sf, "part")
    # lines with a key that no part has: faults for the check to find
    l = l.withColumn("l_partkey", F.when(F.col("l_orderkey") % 50 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey")))
    a = relationship_failures(l, "l_orderkey", orders, "o_orderkey").select(
        F.lit("l_orderkey").alias("columna"), F.col("l_orderkey").alias("clave"), "l_linenumber")
    b = relationship_failures(l, "l_partkey", part, "p_partkey").select(
        F.lit("l_partkey").alias("columna"), F.col("l_partkey").alias("clave"), "l_linenumber")
    return a.unionByName(b)


# ---------------------------------------------------------------- A: aggregations

@q("a1_grouped_aggregates")
def a1(spark, sf):
    l = T(spark, sf, "lineitem")
    return l.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(money("l_quantity")).cast("decimal(28,2)").alias("suma"), F.count(F.lit(1)).alias("lineas"),
        round_dec(avg_dec(money("l_quantity"), 2), 2).alias("media"),
        F.min(money("l_extendedprice")).alias("minimo"), F.max(money("l_extendedprice")).alias("maximo"))


@q("a2_global_aggregate")
def a2(spark, sf):
    l = T(spark, sf, "lineitem")
    return l.agg(F.count(F.lit(1)).alias("lineas"), F.sum(money("l_extendedprice")).cast("decimal(28,2)").alias("importe"),
                 F.count_distinct("l_orderkey").alias("pedidos"))


@q("a3_monthly_bucket")
def a3(spark, sf):
    o = T(spark, sf, "orders")
    return o.groupBy(F.trunc("o_orderdate", "MM").alias("mes")).agg(
        F.count(F.lit(1)).alias("pedidos"), F.sum(money("o_totalprice")).cast("decimal(28,2)").alias("importe"))


@q("a4_conditional_sum")
def a4(spark, sf):
    l = T(spark, sf, "lineitem")
    q_ = money("l_quantity")
    return l.groupBy("l_returnflag").agg(
        F.sum(F.when(F.col("l_linestatus") == "O", q_).otherwise(F.lit(0))).cast("decimal(28,2)").alias("cantidad_abierta"),
        F.sum(F.when(F.col("l_linestatus") == "F", q_).otherwise(F.lit(0))).cast("decimal(28,2)").alias("cantidad_cerrada"))


@q("a5_count_if")
def a5(spark, sf):
    o = T(spark, sf, "orders")
    st = F.col("o_orderstatus")
    return o.groupBy("o_orderpriority").agg(*[F.count_if(st == s).cast("bigint").alias(f"estado_{s.lower()}")
                                              for s in ("F", "O", "P")])


@q("a6_count_via_null")
def a6(spark, sf):
    o = T(spark, sf, "orders")
    return o.groupBy("o_orderpriority").agg(F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("cerrados"))


@q("a7_count_distinct")
def a7(spark, sf):
    return T(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("partes"))


@q("a7b_distinct_by_period")
def a7b(spark, sf):
    """Different users per day, month and quarter, by event type and over all types, from one stored table of bitmaps."""
    from brasa.operators.distinct import distinct_ids, id_bitmaps, united
    by = ["event_type"]
    days = inc.publish(spark, id_bitmaps(T(spark, sf, "events"), "user_id", F.to_date("ts"), by), "user_bitmaps")
    periods = {"dia": F.col("dia"), "mes": F.trunc("dia", "month"), "trimestre": F.trunc("dia", "quarter")}
    counts = []
    for grain, period in periods.items():
        typed = united(days, period, by) if grain != "dia" else days
        counts.append(distinct_ids(typed, "usuarios", by).withColumn("grano", F.lit(grain)))
        counts.append(distinct_ids(united(days, period), "usuarios").withColumns(
            {"grano": F.lit(grain), "event_type": F.lit("todos")}))
    return reduce(DataFrame.unionByName, counts).select("grano", F.col("dia").alias("periodo"), "event_type", "usuarios")


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@q("a8_many_conditional_distinct")
def a8(spark, sf):
    e = T(spark, sf, "events").select(F.to_date("ts").alias("dia"), "user_id", "event_type")
    # de-duplicate (day, user, type) once, then every distinct count is a plain conditional count
    dedup = e.distinct()
    return dedup.groupBy("dia").agg(
        F.count_distinct("user_id").alias("usuarios"),
        *[F.count_if(F.col("event_type") == t).cast("bigint").alias(f"usuarios_{t}") for t in EVENT_TYPES])


@q("a9_exact_median")
def a9(spark, sf):
    return T(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.median("l_quantity").cast("decimal(38,2)").alias("mediana_cantidad"))


@q("a9b_median_by_selection")
def a9b(spark, sf):
    """The median price of each supplier's lines, by selection in passes."""
    from brasa.operators.selection import exact_medians
    l = T(spark, sf, "lineitem").select("l_suppkey", money("l_extendedprice").alias("importe"))
    return exact_medians(l, ["l_suppkey"], "importe", "mediana")


@q("a10_sample_stddev")
def a10(spark, sf):
    o = T(spark, sf, "orders")
    return o.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.round(F.stddev_samp((F.col("o_orderkey") % 97).cast("double")), 2).cast(DEC2).alias("desviacion"))


@q("a11_ordered_distinct_list")
def a11(spark, sf):
    o = T(spark, sf, "orders")
    pri = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
    s = F.collect_set(pri)
    return o.groupBy("o_custkey").agg(F.array_join(F.array_sort(s), ", ").alias("prioridades"),
                                      F.size(s).cast("bigint").alias("n_prioridades"))


@q("a12_ratio_percent")
def a12(spark, sf):
    l = T(spark, sf, "lineitem")
    n = F.count(F.lit(1))
    return l.groupBy("l_returnflag").agg(
        pct(F.count_if(F.col("l_discount") > 0.05), n).alias("pct_descuento_alto"),
        pct(F.sum(money("l_tax")), F.sum(money("l_discount")), 2, 2).alias("pct_impuesto_sobre_descuento"))


@q("a13_share_of_total")
def a13(spark, sf):
    l = T(spark, sf, "lineitem").select("l_linestatus", money("l_extendedprice").alias("imp"))
    grouped = l.groupBy("l_linestatus").agg(F.sum("imp").alias("_imp"))
    grouped = attach_group_stats(grouped, [], {"_t": F.sum("_imp")})  # the total of the groups, not of the rows
    return grouped.select("l_linestatus", pct(F.col("_imp"), F.col("_t"), 2, 2).alias("pct_importe"))


@q("a14_having")
def a14(spark, sf):
    return T(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("pedidos")).filter(
        F.col("pedidos") >= 15)


@q("a15_distinct_projection")
def a15(spark, sf):
    return T(spark, sf, "customer").select("c_mktsegment", "c_nationkey").distinct()


@q("a16_group_by_expression")
def a16(spark, sf):
    c = T(spark, sf, "customer")
    seg = F.when(F.col("c_custkey") % 8 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    return c.groupBy(F.coalesce(seg, F.lit("desconocido")).alias("segmento")).agg(F.count(F.lit(1)).alias("clientes"))


@q("a17_min_representative")
def a17(spark, sf):
    return T(spark, sf, "orders").groupBy(odate().alias("fecha")).agg(
        F.min("o_orderpriority").alias("prioridad"), F.min("o_orderkey").alias("pedido"))


@q("a18_label_from_aggregate")
def a18(spark, sf):
    j = orders_lines(spark, sf)
    d = F.datediff("l_shipdate", "o_orderdate") - 60
    g = j.groupBy("l_suppkey").agg(avg_dec(F.when(d >= 0, d)).alias("_m"))
    label = (F.when(F.col("_m").isNull(), F.lit("sin_datos")).otherwise(
        band(F.col("_m"), [(3, "rapido"), (7, "normal"), (14, "lento")], "muy_lento")))
    return g.select("l_suppkey", round_dec("_m", 2).alias("media"), label.alias("categoria"))


@q("a19_lead_time_subset")
def a19(spark, sf):
    j = orders_lines(spark, sf)
    lead = F.when(F.col("o_orderstatus") == "F", F.datediff("l_shipdate", "o_orderdate") - 61)
    return j.groupBy("l_returnflag").agg(round_dec(avg_dec(lead), 2).alias("media_antelacion"),
                                         F.median(lead).cast("decimal(38,2)").alias("mediana_antelacion"))


# ---------------------------------------------------------------- W / R / O: windows and ranks

@q("w1_first_row_per_key")
def w1(spark, sf):
    l = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return first_per_key(l, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"],
                         columns=["l_orderkey", "l_linenumber", "l_partkey"])


@q("w2_qualify_filter")
def w2(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    last = first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], descending=True)
    return last.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("ultima_fecha"))


@q("w3_version_numbering")
def w3(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    ranked = add_ranks(o, [RankSpec("numero_pedido", [Order("o_orderdate"), Order("o_orderkey")], ["o_custkey"],
                                    method="row_number")])
    return ranked.select("o_custkey", "o_orderkey", "numero_pedido")


def _events_ordered(spark, sf) -> DataFrame:
    return T(spark, sf, "events").select("event_id", "event_type", money("value").alias("valor"), "ts")


@q("w4_global_row_number")
def w4(spark, sf):
    e = _events_ordered(spark, sf)
    return add_ranks(e, [RankSpec("orden", [Order("valor", True, False), Order("event_id")], method="row_number")])


@q("w5_row_number_in_partition")
def w5(spark, sf):
    e = _events_ordered(spark, sf)
    return add_ranks(e, [RankSpec("orden_tipo", [Order("ts", True, False), Order("event_id")], ["event_type"],
                                  method="row_number")])


def customer_revenue(spark, sf) -> DataFrame:
    o = T(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(money("o_totalprice")).cast("decimal(28,2)").alias("ingresos"))
    c = T(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return c.join(o, "c_custkey", "left")


@q("w6_global_rank")
def w6(spark, sf):
    return add_ranks(customer_revenue(spark, sf), [RankSpec("ranking", [Order("ingresos", True, False)])])


@q("w7_rank_in_partition")
def w7(spark, sf):
    return add_ranks(customer_revenue(spark, sf),
                     [RankSpec("ranking_segmento", [Order("ingresos", True, False)], ["c_mktsegment"])])


@q("w8_rank_over_aggregate")
def w8(spark, sf):
    s = T(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum(money("l_quantity")).cast("decimal(28,2)").alias("cantidad"))
    return add_ranks(s, [RankSpec("ranking", [Order("cantidad", True, False)])])


def part_stats(spark, sf) -> DataFrame:
    return T(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("lineas"), F.sum(money("l_quantity")).cast("decimal(28,2)").alias("cantidad"),
        round_dec(avg_dec(money("l_quantity"), 2), 2).alias("media"))


@q("w9_qualified_rank")
def w9(spark, sf):
    p = part_stats(spark, sf).withColumn("_q", F.when(F.col("lineas") >= 35, F.col("media")))
    return add_ranks(p, [RankSpec("ranking_media", [Order("_q", False, True)])]).drop("_q")


@q("w10_composite_rank")
def w10(spark, sf):
    return add_ranks(part_stats(spark, sf), [RankSpec("ranking", [Order("lineas", True, False),
                                                                  Order("cantidad", True, False)])])


@q("w11_partition_statistics")
def w11(spark, sf):
    r = customer_revenue(spark, sf)
    s = attach_group_stats(r, ["c_mktsegment"], {"_avg": avg_dec("ingresos", 2), "_n": F.count(F.lit(1)),
                                                 "_std": F.stddev_samp(F.col("ingresos").cast("double"))})
    return s.select("c_custkey", "c_mktsegment", "ingresos", round_dec("_avg", 2).alias("media_segmento"),
                    F.col("_n").cast("bigint").alias("clientes_segmento"),
                    F.round("_std", 2).cast(DEC2).alias("desviacion_segmento"))


def supplier_lines(spark, sf) -> DataFrame:
    return T(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lineas"), F.count_if(F.col("l_returnflag") == "R").cast("bigint").alias("devueltas"))


@q("w12_overall_mean")
def w12(spark, sf):
    s = attach_group_stats(supplier_lines(spark, sf), [], {"_avg": avg_dec("lineas")})
    return s.select("l_suppkey", "lineas", round_dec("_avg", 2).alias("media_global"))


@q("w13_share_of_partition")
def w13(spark, sf):
    r = customer_revenue(spark, sf)
    s = attach_group_stats(r, ["c_mktsegment"], {"_sum": F.sum("ingresos")})
    return s.select("c_custkey", "c_mktsegment", pct("ingresos", "_sum", 2, 2).alias("pct_segmento"))


@q("w14_zscore_in_partition")
def w14(spark, sf):
    r = customer_revenue(spark, sf)
    s = attach_group_stats(r, ["c_mktsegment"], {"_avg": avg_dec("ingresos", 2),
                                                 "_std": F.stddev_samp(F.col("ingresos").cast("double"))})
    z = (F.col("ingresos").cast("double") - F.col("_avg").cast("double")) / F.nullif(F.col("_std"), F.lit(0.0))
    return s.select("c_custkey", "c_mktsegment", F.round(z, 2).cast(DEC2).alias("z_score"))


@q("w15_relative_class_overall")
def w15(spark, sf):
    s = attach_group_stats(supplier_lines(spark, sf), [], {"_sum": F.sum("lineas"), "_n": F.count(F.lit(1))})
    t, n, sm = F.col("lineas"), F.col("_n"), F.col("_sum")
    klass = (F.when((t * n >= 2 * sm) & (F.col("devueltas") >= 1), F.lit("critico"))
             .when(t * n >= sm, F.lit("problematico")).when(2 * t * n >= sm, F.lit("normal"))
             .otherwise(F.lit("bajo_volumen")))
    return s.select("l_suppkey", "lineas", klass.alias("clase"))


@q("w16_relative_class_partition")
def w16(spark, sf):
    p = T(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand",
                                    (F.col("p_size") % 3 != 0).alias("disponible"))
    lines = T(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("lineas"), F.count_if(F.col("l_returnflag") == "R").cast("bigint").alias("devueltas"))
    j = p.join(lines, "l_partkey", "inner")
    s = attach_group_stats(j, ["p_brand"], {"_sum": F.sum("lineas"), "_n": F.count(F.lit(1))})
    t, n, sm = F.col("lineas"), F.col("_n"), F.col("_sum")
    klass = (F.when((t >= 3) & ~F.col("disponible"), F.lit("retirado_problematico"))
             .when((t * n >= 2 * sm) & (F.col("devueltas") >= 1), F.lit("critico"))
             .when(t * n >= sm, F.lit("frecuente")).otherwise(F.lit("normal")))
    return s.select("l_partkey", "p_brand", "lineas", klass.alias("clase"))


@q("r1_scalable_global_rank")
def r1(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("importe"),
                                      (F.col("o_orderkey") % 7).alias("grupo"))
    return add_ranks(o, [
        RankSpec("ranking_global", [Order("grupo", True, False)]),
        RankSpec("ranking_estado", [Order("grupo"), Order("importe", True, False)], ["o_orderstatus"]),
        RankSpec("orden_global", [Order("importe", True, False), Order("o_orderkey")], method="row_number"),
    ])


@q("o1_top_n")
def o1(spark, sf):
    ranked = add_ranks(customer_revenue(spark, sf), [RankSpec("ranking", [Order("ingresos", True, False)])])
    return ranked.filter(F.col("ranking") <= 10)


# ---------------------------------------------------------------- U: unknown member row

@q("u1_unknown_member_row")
def u1(spark, sf):
    from brasa.plans.dimensions import _unknown_row
    s = T(spark, sf, "supplier").select(surrogate_key("s_suppkey").alias("proveedor_key"),
                                        F.col("s_suppkey").cast("bigint").alias("id_proveedor"), "s_name")
    return _unknown_row(spark, s, {"proveedor_key": "-1", "id_proveedor": -1, "s_name": "DESCONOCIDO"})


# ---------------------------------------------------------------- I: incremental loads and history

INCREMENTAL_CUTOFF = "2026-01-15 00:00:00"


def _wh(spark, sf):
    from brasa.registry import warehouse
    return warehouse(spark, sf)


def _initial_incidents(w):
    """First full build of the incident fact: the source as it stood at the cutoff."""
    from brasa.functions.columns import ts_ntz
    src = w.stg("incidents")
    return w.fact_incidencias(src.filter(F.col("fecha_creacion") < ts_ntz(INCREMENTAL_CUTOFF)))


@q("i1_lookback_delta")
def i1(spark, sf):
    w = _wh(spark, sf)
    target = _initial_incidents(w)
    delta = inc.lookback_delta(w.stg("incidents"), target, "fecha_actualizacion", days=7)
    return delta.select("id_incidencia", "fecha_actualizacion")


@q("i1b_lookback_from_footers")
def i1b(spark, sf):
    """i1 with the target's high-water mark from the footers of its files."""
    from brasa.session import new_table_path
    from brasa.sources.footers import newest_time, with_mark
    w = _wh(spark, sf)
    path = new_table_path(spark, "i1b_incidents")
    with_mark(_initial_incidents(w), "fecha_actualizacion", "marca").write.parquet(path)
    delta = inc.lookback_delta(w.stg("incidents"), spark.read.parquet(path), "fecha_actualizacion", days=7,
                               newest=newest_time(spark, [path], "marca"))
    return delta.select("id_incidencia", "fecha_actualizacion")


@q("i2_upsert_by_key")
def i2(spark, sf):
    target, delta = _orders_split(spark, sf)
    return inc.upsert(target, delta, "id_pedido")


@q("i3_append_new_columns")
def i3(spark, sf):
    target, delta = _orders_split(spark, sf)
    return inc.upsert(target.drop("prioridad"), delta, "id_pedido")


@q("i4_scd2_check_columns")
def i4(spark, sf):
    from brasa.plans.dimensions import EMPLOYEE_CHECK_COLS, SNAPSHOT_COLS
    from brasa.operators.scd2 import build_history
    ex = _wh(spark, sf).user_extracts()
    return build_history([(df.select(*SNAPSHOT_COLS), at) for df, at in ex], "id_empleado", EMPLOYEE_CHECK_COLS)


@q("i4b_history_at_once")
def i4b(spark, sf):
    """The employee history from all extracts in one shuffle; equal to i4."""
    from brasa.plans.dimensions import EMPLOYEE_CHECK_COLS, SNAPSHOT_COLS
    from brasa.operators.scd2 import history_at_once
    ex = _wh(spark, sf).user_extracts()
    return history_at_once([(df.select(*SNAPSHOT_COLS), at) for df, at in ex], "id_empleado", EMPLOYEE_CHECK_COLS)


@q("i5b_many_extracts")
def i5b(spark, sf):
    """Two years of monthly customer extracts: customers come and go, change segment, and their balance moves."""
    from brasa.operators.scd2 import history_at_once
    key = F.col("c_custkey")
    extracts = []
    for n in range(24):
        there = T(spark, sf, "customer").filter((key * 7 + F.floor((key + n) / 5)) % 6 != 0)
        extracts.append((there.select(
            "c_custkey", F.concat("c_mktsegment", (F.floor((key + n) / 9) % 2).cast("string")).alias("segmento"),
            (key + n).cast("bigint").alias("saldo")), f"{2022 + n // 12}-{n % 12 + 1:02d}-01 00:00:00"))
    return history_at_once(extracts, "c_custkey", ["segmento"])


@q("i5_hard_delete")
def i5(spark, sf):
    h = _wh(spark, sf).snp_empleado
    deleted = h.filter(F.col("dbt_is_deleted")).select("id_empleado").distinct()
    return h.join(deleted, "id_empleado", "left_semi").select(
        "id_empleado", "puesto", "dbt_valid_from", "dbt_valid_to", "dbt_is_deleted")


@q("i6_history_bootstrap")
def i6(spark, sf):
    from brasa.plans.dimensions import SNAPSHOT_COLS
    from brasa.operators.scd2 import bootstrap_history
    first, at = _wh(spark, sf).user_extracts()[0]
    return bootstrap_history(first.select(*SNAPSHOT_COLS), "id_empleado", at)


@q("i7_version_dimension")
def i7(spark, sf):
    h = _wh(spark, sf).snp_empleado
    w = Window.partitionBy("id_empleado").orderBy("dbt_valid_from")
    deleted = F.coalesce(F.col("dbt_is_deleted"), F.lit(False))
    from brasa.functions.columns import ts_ntz
    v = h.withColumn("numero_version", F.row_number().over(w).cast("bigint"))
    return v.select("id_empleado", "numero_version",
                    F.when(F.col("numero_version") == 1, ts_ntz("1900-01-01 00:00:00"))
                    .otherwise(F.col("dbt_valid_from")).alias("fecha_inicio_validez"),
                    F.col("dbt_valid_to").alias("fecha_fin_validez"),
                    (F.col("dbt_valid_to").isNull() & ~deleted).alias("es_version_actual"),
                    deleted.alias("es_eliminado"))


@q("i8_late_correction_replay")
def i8(spark, sf):
    """First build at the cutoff, then one incremental run with the 7-day look-back."""
    w = _wh(spark, sf)
    first = inc.publish(spark, _initial_incidents(w), "i8_first")
    delta = inc.lookback_delta(w.stg("incidents"), first, "fecha_actualizacion", days=7)
    return inc.publish(spark, inc.upsert(first, w.fact_incidencias(delta), "incidencia_key"), "i8_second")


# ---------------------------------------------------------------- C: calendar

@q("c1_time_spine")
def c1(spark, sf):
    return days_of(T(spark, sf, "orders").select(odate())).select(F.col("fecha").alias("date_day"))


def order_duty(spark, sf) -> DataFrame:
    o = T(spark, sf, "orders")
    kind = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("festivo"))
            .when(F.col("o_orderpriority") == "2-HIGH", F.lit("prefestivo"))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("festivo víspera")).otherwise(F.lit("laborable")))
    return o.select(odate().alias("fecha"), kind.alias("tipo_dia"), F.col("o_orderkey").alias("id_guardia"))


@q("c2_calendar_dimension")
def c2(spark, sf):
    from brasa.plans.dimensions import dim_fecha
    return dim_fecha(order_calendar(spark, sf).select(F.col("fecha").alias("date_day")), order_duty(spark, sf))


@q("c3_gap_free_daily_report")
def c3(spark, sf):
    cal = order_calendar(spark, sf)
    o = T(spark, sf, "orders").groupBy(odate().alias("fecha")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(money("o_totalprice")).alias("_imp"))
    j = cal.join(o, "fecha", "left")
    return j.select("fecha", F.coalesce("_n", F.lit(0)).cast("bigint").alias("pedidos"),
                    F.coalesce("_imp", F.lit(0)).cast("decimal(28,2)").alias("importe"))


# ---------------------------------------------------------------- Q: data quality



class Tables(dict):
    """Tables by name; each is built when it is asked for."""

    def __getitem__(self, name: str) -> DataFrame:
        return super().__getitem__(name)()


def _tables(spark, sf) -> Tables:
    w = _wh(spark, sf)
    return Tables({"stg_incidents": lambda: w.stg("incidents"), "stg_requests": lambda: w.stg("requests"),
                   "stg_assignments": lambda: w.stg("firefighters_assignments"), "stg_users": lambda: w.stg("users"),
                   "stg_extra_hours": lambda: w.stg("extra_hours"), "fact_horas_extra": w.fact_horas_extra,
                   "orders": lambda: T(spark, sf, "orders"), "lineitem": lambda: T(spark, sf, "lineitem")})


@q("q1_unique")
def q1(spark, sf):
    from brasa.operators.quality import unique_failures
    return unique_failures(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@q("q1b_gold_keys")
def q1b(spark, sf):
    """The primary key of every dimension and fact: missing and repeated keys."""
    from brasa.operators.quality import key_report
    from brasa.plans.contracts import GOLD_KEYS
    w = _wh(spark, sf)
    return reduce(DataFrame.unionByName, [key_report(t, w.gold(t), key) for t, key in GOLD_KEYS.items()])


@q("q4b_gold_references")
def q4b(spark, sf):
    """Every foreign key of the facts: rows that point nowhere."""
    from brasa.operators.quality import reference_reports
    from brasa.plans.contracts import GOLD_KEYS, GOLD_REFERENCES
    w = _wh(spark, sf)
    return reduce(DataFrame.unionByName, [
        reference_reports([(c, w.gold(c), col) for c, col, parent in GOLD_REFERENCES if parent == p], p, w.gold(p), GOLD_KEYS[p])
        for p in dict.fromkeys(parent for _, _, parent in GOLD_REFERENCES)])


@q("q2_not_null")
def q2(spark, sf):
    c = Check("fecha_actualizacion_not_null", "stg_incidents", "not_null", column="fecha_actualizacion")
    return failures(c, _tables(spark, sf)).select("id_incidencia", "fecha_creacion")


@q("q3_accepted_values")
def q3(spark, sf):
    c = Check("estado_aceptado", "orders", "accepted_values", column="o_orderstatus", values=("F", "O"))
    return failures(c, _tables(spark, sf)).select("o_orderkey", "o_orderstatus")


@q("q4_relationships")
def q4(spark, sf):
    c = Check("asignacion_empleado", "stg_assignments", "relationship", column="id_empleado",
              parent="stg_users", parent_column="id_empleado")
    return failures(c, _tables(spark, sf)).select("id_asignacion", "id_empleado")


@q("q5_expression_is_true")
def q5(spark, sf):
    c = Check("jornada_maxima", "fact_horas_extra", "expression", expression="total_horas <= 20")
    return failures(c, _tables(spark, sf)).select("id_hora_extra", "total_horas")


@q("q6_conditional_test")
def q6(spark, sf):
    c = Check("resueltas_con_dias", "stg_incidents", "not_null", column="dias_resolucion", where="estado = 'resuelta'")
    return failures(c, _tables(spark, sf)).select("id_incidencia", "fecha_creacion", "fecha_actualizacion")


SEVERITY_CHECKS = (
    Check("incidencia_unica", "stg_incidents", "unique", column="id_incidencia"),
    Check("actualizacion_informada", "stg_incidents", "not_null", column="fecha_actualizacion", severity="warn"),
    Check("estado_pedido", "orders", "accepted_values", column="o_orderstatus", values=("F", "O", "P")),
    Check("prioridad_pedido", "orders", "accepted_values", column="o_orderpriority",
          values=("1-URGENT", "2-HIGH", "3-MEDIUM"), severity="warn"),
    Check("linea_pedido", "lineitem", "unique", columns=("l_orderkey", "l_linenumber")),
)


@q("q7_severity_status")
def q7(spark, sf):
    return quality_report(SEVERITY_CHECKS, _tables(spark, sf))


@q("q8_counter_reconciliation")
def q8(spark, sf):
    w = _wh(spark, sf)
    real = (w.stg("firefighters_assignments").filter(F.col("id_solicitud").isNotNull())
            .groupBy("id_solicitud").agg(F.count(F.lit(1)).alias("total_real")))
    # counters that were changed by hand: faults for the check to find
    wrong = F.when(F.col("id_solicitud") % 40 == 0, 1).otherwise(0)
    fact = w.fact_solicitudes().filter(F.col("total_asignaciones_generadas") > 0).select(
        "id_solicitud", (F.col("total_asignaciones_generadas") + wrong).alias("total_fact"))
    return fact.join(real, "id_solicitud", "inner").filter(F.col("total_fact") != F.col("total_real")).select(
        "id_solicitud", "total_fact", "total_real", (F.col("total_fact") - F.col("total_real")).alias("diferencia"))


@q("q9_cost_reconciliation")
def q9(spark, sf):
    w = _wh(spark, sf)
    # costs that were changed by hand: faults for the check to find
    wrong = F.when((F.dayofmonth("fecha") == 31) & (F.col("id_hora_extra") % 3 == 0), F.lit(Decimal("0.02"))).otherwise(
        F.lit(Decimal("0.00")))
    fact = w.fact_horas_extra().withColumn("coste_total", F.col("coste_total") + wrong).groupBy(
        F.trunc("fecha", "MM").alias("mes")).agg(
        round_dec(F.sum("coste_total"), 2).alias("coste_fact"))
    s = w.stg("salaries").select("id_salario", "precio_hora_diurna", "precio_hora_nocturna")
    stg = (w.stg("extra_hours").join(s, "id_salario", "inner").groupBy(F.trunc("fecha", "MM").alias("mes"))
           .agg(round_dec(F.sum(F.col("horas_diurnas").cast("decimal(38,0)") * F.col("precio_hora_diurna"))
                          + F.sum(F.col("horas_nocturnas").cast("decimal(38,0)") * F.col("precio_hora_nocturna")), 2)
                .alias("coste_calculado")))
    diff = F.abs(F.col("coste_fact") - F.col("coste_calculado"))
    return fact.join(stg, "mes", "inner").filter(diff > F.lit(Decimal("0.01"))).select(
        "mes", "coste_fact", "coste_calculado", diff.cast(DEC2).alias("diferencia"))


@q("q10_daily_hours_cap")
def q10(spark, sf):
    e = _wh(spark, sf).stg("extra_hours")
    return e.groupBy("id_empleado", "fecha").agg(F.sum("total_horas").cast("bigint").alias("total_horas_dia"),
                                                 F.count(F.lit(1)).alias("num_registros")).filter(
        F.col("total_horas_dia") > 24)


@q("q11_resolved_before_created")
def q11(spark, sf):
    i = _wh(spark, sf).stg("incidents")
    return i.filter((F.col("estado") == "resuelta") & F.col("fecha_creacion").isNotNull()
                    & F.col("fecha_actualizacion").isNotNull()
                    & (F.col("fecha_actualizacion") < F.col("fecha_creacion"))).select(
        "id_incidencia", "fecha_creacion", "fecha_actualizacion", "estado",
        F.datediff("fecha_actualizacion", "fecha_creacion").cast("bigint").alias("desfase_dias"))


@q("q12_end_before_start")
def q12(spark, sf):
    r = _wh(spark, sf).stg("requests")
    return r.filter(F.col("fecha_inicio").isNotNull() & F.col("fecha_fin").isNotNull()
                    & (F.col("fecha_fin") < F.col("fecha_inicio"))).select(
        "id_solicitud", "id_empleado", "tipo_permiso", "fecha_inicio", "fecha_fin",
        F.datediff("fecha_fin", "fecha_inicio").cast("bigint").alias("dias_desfase"))


@q("q13_one_current_version")
def q13(spark, sf):
    d = _wh(spark, sf).dim_empleado
    # versions that were not closed: faults for the check to find
    d = d.withColumn("es_version_actual", F.col("es_version_actual") | (F.col("id_empleado") % 10 == 0))
    return (d.filter(F.col("es_version_actual") & (F.col("id_empleado") != -1)).groupBy("id_empleado")
            .agg(F.count(F.lit(1)).alias("versiones_actuales")).filter(F.col("versiones_actuales") > 1))


@q("q14_contract_enforcement")
def q14(spark, sf):
    from brasa.plans.analytics import AS_OF
    from brasa.plans.contracts import NOT_NULL, contract
    w = _wh(spark, sf)
    tables = {name: w.gold(name) for name in NOT_NULL if name != "v13"} | {"v13": w.v13(AS_OF)}
    return reduce(DataFrame.unionByName, [contract(name).report(df) for name, df in tables.items()])


WAREHOUSE_CHECKS = (
    Check("stg_incidents_id_unique", "stg_incidents", "unique", column="id_incidencia"),
    Check("stg_incidents_estado_accepted", "stg_incidents", "accepted_values", column="estado",
          values=("pendiente", "tramitada", "resuelta")),
    Check("stg_incidents_nivel_accepted", "stg_incidents", "accepted_values", column="nivel_gravedad",
          values=("bajo", "medio", "alto")),
    Check("stg_incidents_dias_range", "stg_incidents", "expression", expression="dias_resolucion BETWEEN 0 AND 1825",
          where="dias_resolucion IS NOT NULL", severity="warn"),
    Check("stg_requests_estado_accepted", "stg_requests", "accepted_values", column="estado",
          values=("pendiente", "confirmada", "cancelada", "denegada")),
    Check("stg_requests_inicio_not_null", "stg_requests", "not_null", column="fecha_inicio", severity="warn"),
    Check("stg_assignments_tipo_accepted", "stg_assignments", "accepted_values", column="tipo_asignacion",
          values=("ida", "vuelta")),
    Check("stg_assignments_empleado_exists", "stg_assignments", "relationship", column="id_empleado",
          parent="stg_users", parent_column="id_empleado", severity="warn"),
    Check("stg_users_id_unique", "stg_users", "unique", column="id_empleado"),
    Check("stg_users_categoria_accepted", "stg_users", "accepted_values", column="categoria_puesto",
          values=("Tropa", "Mando", "Administrativo", "Desconocido")),
    Check("fact_horas_extra_key_unique", "fact_horas_extra", "unique", column="horas_extra_key"),
    Check("fact_horas_extra_tipo_dia_not_null", "fact_horas_extra", "not_null", column="tipo_dia"),
    Check("fact_horas_extra_coste_sum", "fact_horas_extra", "expression",
          expression="coste_total = coste_diurno + coste_nocturno"),
    Check("fact_horas_extra_empleado_exists", "fact_horas_extra", "relationship", column="id_empleado",
          parent="stg_users", parent_column="id_empleado", severity="warn"),
)


@q("q15_quality_report")
def q15(spark, sf):
    return quality_report(WAREHOUSE_CHECKS, _tables(spark, sf))


# ---------------------------------------------------------------- M: metrics



def _cast_metrics(df: DataFrame, types: dict) -> DataFrame:
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


@q("m1_metric_sum")
def m1(spark, sf):
    f = _wh(spark, sf).fact_horas_extra()
    out = M.evaluate(f, [m for m in M.OVERTIME_METRICS if isinstance(m, M.Simple) and m.agg == "sum"])
    return _cast_metrics(out, {"coste_total_horas_extra": DEC2, "coste_diurno_horas_extra": DEC2,
                               "coste_nocturno_horas_extra": DEC2, "total_horas_extra": "bigint"})


@q("m2_metric_count")
def m2(spark, sf):
    f = _wh(spark, sf).fact_incidencias()
    return M.evaluate(f, [M.Simple("total_incidencias", "count", "incidencia_key")], ["tipo_incidencia"])


@q("m3_metric_count_distinct")
def m3(spark, sf):
    f = _wh(spark, sf).fact_horas_extra()
    return M.evaluate(f, [M.Simple("bomberos_con_horas_extra", "count_distinct", "id_empleado")], ["tipo_dia"])


@q("m4_metric_average")
def m4(spark, sf):
    f = _wh(spark, sf).fact_incidencias()
    return M.evaluate(f, [M.Simple("mttr_dias", "average", "dias_resolucion")], ["tipo_incidencia", "nivel_gravedad"])


@q("m5_filtered_metric")
def m5(spark, sf):
    f = _wh(spark, sf).fact_solicitudes()
    ms = [m for m in M.REQUEST_METRICS if isinstance(m, M.Simple) and m.filter]
    return M.evaluate(f, ms, ["tipo_permiso"])


@q("m6_ratio_metric")
def m6(spark, sf):
    w = _wh(spark, sf)
    r = _cast_metrics(M.evaluate(w.fact_solicitudes(), M.REQUEST_METRICS),
                      {"dias_ausencia_solicitados": "bigint", "total_asignaciones_generadas": "bigint",
                       "total_requerimientos": "bigint"})
    i = _cast_metrics(M.evaluate(w.fact_incidencias(), M.INCIDENT_METRICS),
                      {"incidencias_resueltas": "bigint", "incidencias_pendientes": "bigint",
                       "incidencias_tramitadas": "bigint"})
    r = r.withColumn("_one", F.lit(1))
    return r.join(i.withColumn("_one", F.lit(1)), "_one").drop("_one")


@q("m7_metric_by_dimension")
def m7(spark, sf):
    w = _wh(spark, sf)
    f = w.fact_horas_extra().join(w.dim_empleado.select("empleado_key", "categoria_puesto"), "empleado_key", "left")
    out = M.evaluate(f, M.OVERTIME_METRICS, ["categoria_puesto"])
    return _cast_metrics(out, {"coste_total_horas_extra": DEC2, "coste_diurno_horas_extra": DEC2,
                               "coste_nocturno_horas_extra": DEC2, "total_horas_extra": "bigint"})


@q("m8_metric_by_time_grain")
def m8(spark, sf):
    """All 22 metrics per month on the time spine; each fact on its own time dimension, gaps kept."""
    w = _wh(spark, sf)
    months = w.dim_time.select(F.trunc("date_day", "month").alias("periodo")).distinct()
    parts = [M.by_time_grain(w.fact_horas_extra(), M.OVERTIME_METRICS, "fecha", "month"),
             M.by_time_grain(w.fact_solicitudes(), M.REQUEST_METRICS, "fecha_inicio", "month"),
             M.by_time_grain(w.fact_incidencias(), M.INCIDENT_METRICS, "fecha_incidencia", "month")]
    out = months
    for part in parts:
        out = out.join(part, "periodo", "left")
    return _cast_metrics(out, {
        "coste_total_horas_extra": DEC2, "coste_diurno_horas_extra": DEC2, "coste_nocturno_horas_extra": DEC2,
        "total_horas_extra": "bigint", "dias_ausencia_solicitados": "bigint", "total_asignaciones_generadas": "bigint",
        "total_requerimientos": "bigint", "incidencias_resueltas": "bigint", "incidencias_pendientes": "bigint",
        "incidencias_tramitadas": "bigint"})


@q("m8b_metric_by_day")
def m8b(spark, sf):
    """The overtime metrics per day on the time spine, gaps kept."""
    w = _wh(spark, sf)
    out = M.by_time_grain(w.fact_horas_extra(), M.OVERTIME_METRICS, "fecha", "day", w.dim_time)
    return _cast_metrics(out, {"coste_total_horas_extra": DEC2, "coste_diurno_horas_extra": DEC2,
                               "coste_nocturno_horas_extra": DEC2, "total_horas_extra": "bigint"})


@q("s6c_month_merge_cases")
def s6c(spark, sf):
    """A month merge with rows without a date, rows that move into and out of them, repeated keys and a new column."""
    from brasa.session import new_table_path
    k = F.col("o_orderkey")
    o = T(spark, sf, "orders").select("o_orderkey", odate().alias("fecha"), money("o_totalprice").alias("importe"))
    first = o.withColumn("fecha", F.when(k % 10 != 0, F.col("fecha"))).withColumn("version", F.lit(1))
    moved = F.when(k % 9 != 0, F.date_add("fecha", 40))
    delta = o.filter(k % 3 == 0).withColumn("fecha", moved).withColumn("nota", F.lit("corregido"))
    delta = delta.withColumn("version", F.explode(F.array(F.lit(2), F.lit(3)))).withColumn(
        "importe", (F.col("importe") + F.col("version")).cast("decimal(18,2)"))
    path = new_table_path(spark, "s6c_orders")
    inc.merge_partitioned(spark, path, first, "o_orderkey", "fecha")
    return inc.merge_partitioned(spark, path, delta, "o_orderkey", "fecha", "version")


@q("i9_micro_batch_fact_load")
def i9(spark, sf):
    """The incident fact loaded by Structured Streaming, one arrival per third of the month.

    The stream is started again on its root after each arrival and takes all files of it in one batch: a batch rewrites its
    month, so as many batches as files would be work that grows with the square of the input.
    """
    from brasa.plans.staging import stg_incidents
    from brasa.session import new_table_path
    from brasa.sources.bronze import Bronze
    from brasa.streaming import start_fact_stream
    w = _wh(spark, sf)
    src = new_table_path(spark, "i9_arrivals")
    bronze = Bronze(spark, sf).table("incidents")
    day = F.dayofmonth("CREATED_AT")
    root = new_table_path(spark, "i9_stream")
    for i, cond in enumerate([day <= 10, (day > 10) & (day <= 20), (day > 20) | day.isNull()]):
        bronze.filter(cond).write.parquet(f"{src}/part={i}")
        state, query = start_fact_stream(spark, f"{src}/*", bronze.schema, lambda b: w.fact_incidencias(stg_incidents(b)),
                                         "i9_incidents", "incidencia_key", "fecha_incidencia", max_files_per_trigger=None,
                                         root=root)
        query.awaitTermination()
    return state.table()


@q("q5b_gold_expression_tests")
def q5b(spark, sf):
    """Every expression test declared on the facts and views, as one report."""
    from brasa.plans.contracts import EXPRESSION_TESTS, expression_test_name
    w = _wh(spark, sf)
    names = {t for t, _, _, _ in EXPRESSION_TESTS}
    tables = {n: (getattr(w, n)() if n.startswith("fact_") else getattr(w, n.split("_")[0])()) for n in names}
    checks = [Check(expression_test_name(t, e, wh), t, "expression", expression=e, where=wh, severity=sev)
              for t, e, wh, sev in EXPRESSION_TESTS]
    return quality_report(checks, tables)


@q("s6b_partitioned_merge_sink")
def s6b(spark, sf):
    """The late-correction replay of i8, merged into a month-partitioned table (touched months only)."""
    from brasa.session import new_table_path
    w = _wh(spark, sf)
    path = new_table_path(spark, "s6b_incidents")
    first = inc.merge_partitioned(spark, path, _initial_incidents(w), "incidencia_key", "fecha_incidencia")
    delta = inc.lookback_delta(w.stg("incidents"), first, "fecha_actualizacion", days=7)
    return inc.merge_partitioned(spark, path, w.fact_incidencias(delta), "incidencia_key", "fecha_incidencia",
                                 "fecha_actualizacion")


@q("s6d_merge_with_key_filters")
def s6d(spark, sf):
    """The orders of the last 30 days are postponed by 40; filters of the months' keys say which months held them."""
    from brasa.session import new_table_path
    path = new_table_path(spark, "s6d_orders")
    orders = typed_orders(spark, sf).select("id_pedido", "fecha", "importe")
    inc.merge_partitioned(spark, path, orders, "id_pedido", "fecha", filtered=True)
    last = orders.select(F.date_sub(F.max("fecha"), 30)).scalar()
    late = orders.filter(F.col("fecha") > last).withColumn("fecha", F.date_add("fecha", 40))
    return inc.merge_partitioned(spark, path, late, "id_pedido", "fecha", filtered=True)
