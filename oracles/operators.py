"""Oracle SQL of the generic operator queries."""

from __future__ import annotations

from brasa.plans.contracts import NOT_NULL
from oracles.base import ddiv, pct, skey, with_ctes
from oracles.views import VIEWS

OPERATORS: dict[str, str] = {}


def o(name: str, sql: str) -> None:
    OPERATORS[name] = sql


def clean(x: str) -> str:
    return f"NULLIF(LOWER(TRIM({x})), '')"


def trim_null(x: str) -> str:
    return f"NULLIF(TRIM({x}), '')"


def m(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


TYPED_ORDERS = (f"SELECT CAST(o_orderkey AS BIGINT) AS id_pedido, CAST(o_custkey AS BIGINT) AS id_cliente, "
                f"CAST(o_orderdate AS DATE) AS fecha, {m('o_totalprice')} AS importe, {clean('o_orderstatus')} AS estado, "
                f"{clean('o_orderpriority')} AS prioridad FROM orders")

# ---------------------------------------------------------------- S
o("s1_source_scan", TYPED_ORDERS)
o("s3_source_freshness", " UNION ALL ".join(
    f"""SELECT DATE '{a}' AS as_of, max_loaded_at, age_days,
      CASE WHEN age_days > 60 THEN 'error' WHEN age_days > 30 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT MAX(ts) AS max_loaded_at, CAST(date_diff('day', CAST(MAX(ts) AS DATE), DATE '{a}') AS BIGINT) AS age_days
          FROM events)""" for a in ("2024-02-15", "2024-03-15", "2024-06-01")))
o("s4_view_sink", f"SELECT estado, prioridad, COUNT(*) AS pedidos, CAST(SUM(importe) AS DECIMAL(28,2)) AS importe "
                  f"FROM ({TYPED_ORDERS}) GROUP BY estado, prioridad")
o("s5_table_sink", TYPED_ORDERS)
_SPLIT = (f"WITH t AS ({TYPED_ORDERS}), "
          "tg AS (SELECT * FROM t WHERE fecha < DATE '1999-01-01'), "
          "dl AS (SELECT * REPLACE (CAST(importe + 1.00 AS DECIMAL(18,2)) AS importe) FROM t WHERE fecha >= DATE '1998-12-25') ")
o("s6_incremental_merge_sink", _SPLIT + "SELECT * FROM tg WHERE id_pedido NOT IN (SELECT id_pedido FROM dl) UNION ALL SELECT * FROM dl")
o("s7_guarded_create", "SELECT n_nationkey, n_name, n_regionkey, TRUE AS refused_without_force FROM nation")

# ---------------------------------------------------------------- P
o("p2_derived_columns", f"SELECT *, CAST(importe * 1.21 AS DECIMAL(18,4)) AS importe_con_iva, "
                        f"CAST(year(fecha) AS BIGINT) AS anio FROM ({TYPED_ORDERS})")
o("p3_date_floor_filter", f"SELECT id_pedido, fecha FROM ({TYPED_ORDERS}) WHERE fecha >= DATE '1996-01-01'")
_NULLABLE = ("SELECT o_orderkey AS id_pedido, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END "
             "AS fecha FROM orders")
o("p4_null_tolerant_filter", f"SELECT * FROM ({_NULLABLE}) WHERE fecha IS NULL OR fecha >= DATE '1998-01-01'")
o("p5_half_open_window", "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS fecha_envio FROM lineitem "
                         "WHERE CAST(l_shipdate AS DATE) >= DATE '1996-01-01' AND CAST(l_shipdate AS DATE) < DATE '1997-01-01'")
o("p6_membership", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
o("p7_range_predicate", f"SELECT l_orderkey, l_linenumber, {m('l_discount')} AS descuento FROM lineitem "
                        "WHERE l_discount BETWEEN 0.02 AND 0.05")
_KEYED = (f"SELECT o_orderkey, CASE WHEN o_custkey % 13 = 0 THEN NULL WHEN o_custkey % 10 = 0 THEN '-1' "
          f"ELSE {skey('o_custkey')} END AS cliente_key FROM orders")
o("p8_known_member_filter", f"SELECT * FROM ({_KEYED}) WHERE cliente_key IS NOT NULL AND cliente_key <> '-1'")
_DIRTY = ("SELECT c_custkey AS id_cliente, CASE WHEN c_custkey % 9 = 0 THEN NULL "
          "ELSE '  ' || upper(c_mktsegment) || ' ' END AS segmento_sucio FROM customer")
o("p9_category_mapping", f"""SELECT id_cliente,
  CASE WHEN {clean('segmento_sucio')} IN ('automobile', 'building') THEN 'industria'
       WHEN {clean('segmento_sucio')} IN ('furniture', 'household') THEN 'hogar'
       WHEN {clean('segmento_sucio')} IS NULL THEN 'sin_dato' ELSE 'otros' END AS categoria
FROM ({_DIRTY})""")
o("p10_numeric_bands", """SELECT o_orderkey, CASE WHEN o_totalprice <= 50000 THEN 'bajo' WHEN o_totalprice <= 150000 THEN 'medio'
  WHEN o_totalprice <= 300000 THEN 'alto' WHEN o_totalprice <= 450000 THEN 'muy_alto' ELSE 'extremo' END AS tramo_importe
FROM orders""")
o("p11_priority_matrix", """SELECT event_id, CAST(CASE WHEN nivel = 'alto' AND dias > 7 THEN 1 WHEN nivel = 'alto' THEN 2
  WHEN nivel = 'medio' AND dias > 30 THEN 3 WHEN nivel = 'medio' THEN 4 WHEN dias > 90 THEN 5
  WHEN nivel = 'bajo' AND dias > 30 THEN 6 ELSE 7 END AS BIGINT) AS prioridad
FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'alto' WHEN 'purchase' THEN 'medio' WHEN 'view' THEN 'bajo' END AS nivel,
             CAST(floor(value / 2) AS BIGINT) AS dias FROM events)""")
o("p12_boolean_flags", """SELECT o_orderkey, COALESCE(estado = 'F', FALSE) AS es_f, COALESCE(estado = 'O', FALSE) AS es_o,
  COALESCE(estado = 'P', FALSE) AS es_p
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS estado FROM orders)""")
o("p13_indicator_measures", """SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS es_devuelta,
  CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS BIGINT) AS es_abierta, CAST(1 AS BIGINT) AS total_lineas FROM lineitem""")
_OL = "lineitem JOIN orders ON l_orderkey = o_orderkey"
o("p14_guarded_duration", f"""SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linestatus = 'F' AND o_orderdate IS NOT NULL AND l_shipdate IS NOT NULL
        AND o_orderdate >= TIMESTAMP '1995-01-01 00:00:00' AND l_shipdate >= TIMESTAMP '1995-01-01 00:00:00'
        AND date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) BETWEEN 0 AND 120
       THEN CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS BIGINT) END AS dias_resolucion
FROM {_OL}""")
o("p15_inclusive_duration", f"""SELECT l_orderkey, l_linenumber,
  CAST(CASE WHEN l_linenumber % 5 <> 0 AND o_orderdate IS NOT NULL
       THEN date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) + 1 ELSE 1 END AS BIGINT) AS dias
FROM {_OL}""")
o("p16_null_group_label", """SELECT COALESCE(CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_returnflag END, 'sin_clasificar') AS indicador,
  COUNT(*) AS lineas FROM lineitem GROUP BY 1""")
_HD, _HN = "CAST(l_linenumber AS DECIMAL(38,0))", "CAST(l_orderkey % 5 AS DECIMAL(38,0))"
_PD = "CAST(CAST(l_partkey % 4000 + 1000 AS DECIMAL(12,0)) * 0.01 AS DECIMAL(10,2))"
_PN = "CAST(CAST(l_suppkey % 3000 + 1500 AS DECIMAL(12,0)) * 0.01 AS DECIMAL(10,2))"
o("p17_row_cost", f"""SELECT l_orderkey, l_linenumber, CAST({_HD} * {_PD} AS DECIMAL(12,2)) AS coste_diurno,
  CAST({_HN} * {_PN} AS DECIMAL(12,2)) AS coste_nocturno, CAST({_HD} * {_PD} + {_HN} * {_PN} AS DECIMAL(12,2)) AS coste_total
FROM lineitem""")
o("p18_conditional_effective_date", "SELECT event_id, CASE WHEN event_type = 'purchase' AND user_id IS NOT NULL THEN ts END "
                                    "AS fecha_efecto FROM events")

# ---------------------------------------------------------------- F
o("f1_clean_text", f"SELECT id_cliente, {clean('segmento_sucio')} AS segmento FROM ({_DIRTY})")
o("f2_trim_null", f"SELECT id_cliente, {trim_null('segmento_sucio')} AS segmento FROM ({_DIRTY})")
o("f3_upper_twin", f"SELECT c_custkey, c_name, upper({trim_null('c_name')}) AS nombre_normalizado FROM customer")
o("f4_coalesce_default", "SELECT c_custkey, CAST(COALESCE(CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_acctbal END, 0.0) "
                         "AS DECIMAL(18,2)) AS saldo FROM customer")
_TXT = """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'x' WHEN event_id % 10 = 1 THEN ''
  WHEN event_id % 10 = 2 THEN ' ' || CAST(event_id AS VARCHAR) || ' '
  WHEN event_id % 10 = 3 THEN CAST(event_id AS VARCHAR) || '.7'
  WHEN event_id % 10 = 4 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS texto FROM events"""
o("f5_safe_number", f"SELECT event_id, texto, CAST(TRY_CAST(texto AS DECIMAL(38,0)) AS BIGINT) AS numero FROM ({_TXT})")
o("f6_strict_casts", f"""SELECT CAST(o_orderkey AS VARCHAR) AS clave_texto, CAST(o_orderdate AS DATE) AS fecha,
  CAST(o_orderdate AS TIMESTAMP) AS momento, {m('o_totalprice')} AS importe, CAST(o_orderstatus = 'F' AS BOOLEAN) AS cerrado,
  CAST(CAST(o_custkey AS DECIMAL(38,0)) AS BIGINT) AS cliente FROM orders""")
o("f7_surrogate_key", f"""SELECT o_orderkey, {skey('o_orderkey')} AS pedido_key,
  {skey('CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey END', 'CAST(o_orderdate AS DATE)')} AS cliente_fecha_key FROM orders""")
o("f8_md5_concat", "SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_orderdate AS VARCHAR)) AS scd_id FROM orders")
_DAYS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha FROM orders"
o("f9_calendar_parts", f"""SELECT fecha, CAST(year(fecha) AS BIGINT) AS anio, CAST(quarter(fecha) AS BIGINT) AS trimestre,
  CAST(month(fecha) AS BIGINT) AS mes, CAST(weekofyear(fecha) AS BIGINT) AS semana_anio, CAST(day(fecha) AS BIGINT) AS dia,
  CAST(isodow(fecha) AS BIGINT) AS dia_semana_num FROM ({_DAYS})""")
o("f10_month_day_names", f"SELECT fecha, strftime(fecha, '%b') AS mes_nombre, strftime(fecha, '%a') AS dia_semana_nombre FROM ({_DAYS})")
o("f11_trunc_month", "SELECT l_orderkey, l_linenumber, CAST(date_trunc('month', l_shipdate) AS DATE) AS mes FROM lineitem")
o("f12_day_difference", f"SELECT l_orderkey, l_linenumber, CAST(date_diff('day', CAST(o_orderdate AS DATE), "
                        f"CAST(l_shipdate AS DATE)) AS BIGINT) AS dias FROM {_OL}")
o("f13_subtract_days", "SELECT event_id, date_trunc('second', ts - INTERVAL 7 DAY) AS hace_una_semana FROM events")
o("f14_as_of_date", "SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS BIGINT) "
                    "AS antiguedad_dias FROM orders")
_F15 = f"SELECT l_suppkey, SUM({m('l_quantity')}) AS q, COUNT(*) AS n FROM lineitem GROUP BY l_suppkey"
o("f15_round_half_up", f"""SELECT l_suppkey, CAST(ROUND({ddiv('q', 'n', 2, 0)}, 3) AS DECIMAL(38,3)) AS media_3,
  CAST(ROUND({ddiv('q', 'n', 2, 0)}, 2) AS DECIMAL(38,2)) AS media_2 FROM ({_F15})""")
o("f16_abs_arith_nullif", f"""SELECT c_custkey, abs({m('c_acctbal')}) AS saldo_abs,
  CAST(ROUND({ddiv(m('c_acctbal'), 'c_nationkey % 3', 2, 0)}, 2) AS DECIMAL(38,2)) AS saldo_por_grupo,
  CAST({m('c_acctbal')} - 100.00 AS DECIMAL(18,2)) AS saldo_menos_100 FROM customer""")
o("f17_bounds_defence", f"""SELECT l_orderkey, l_linenumber,
  CASE WHEN o_orderdate >= TIMESTAMP '1995-01-01 00:00:00'
        AND date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) BETWEEN 0 AND 90
       THEN CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS BIGINT) END AS dias_validos
FROM {_OL}""")

# ---------------------------------------------------------------- J
o("j1_parent_name_join", f"""SELECT n_nationkey, {trim_null('n_name')} AS nombre, {trim_null('r_name')} AS nombre_region
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")
o("j2_fact_dimension_join", f"""SELECT p.p_brand, CAST(SUM({m('l.l_quantity')}) AS DECIMAL(28,2)) AS cantidad, COUNT(*) AS lineas
FROM (SELECT {skey('l_partkey')} AS parte_key, l_quantity FROM lineitem) l
LEFT JOIN (SELECT {skey('p_partkey')} AS parte_key, p_brand FROM part) p ON l.parte_key = p.parte_key
GROUP BY p.p_brand""")
o("j3_star_join", f"""SELECT p.p_type, n.n_regionkey, o.o_orderstatus, COUNT(*) AS lineas,
  CAST(SUM({m('l.l_extendedprice')}) AS DECIMAL(28,2)) AS importe
FROM lineitem l
LEFT JOIN (SELECT {skey('p_partkey')} AS pk, p_type FROM part) p ON {skey('l.l_partkey')} = p.pk
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY p.p_type, n.n_regionkey, o.o_orderstatus""")
_CAL = """SELECT CAST(UNNEST(generate_series(CAST(MIN(d) AS TIMESTAMP), CAST(MAX(d) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS fecha
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)"""
o("j4_calendar_join", f"""SELECT CAST(isodow(c.fecha) AS BIGINT) AS dia_semana_num, COUNT(*) AS pedidos
FROM (SELECT CAST(o_orderdate AS DATE) AS fecha FROM orders) x LEFT JOIN ({_CAL}) c ON x.fecha = c.fecha
GROUP BY 1""")
_SHIFT = ("SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 25 YEAR AS DATE) AS fecha FROM orders")


def _asof(alias: str, fid: str, fdate: str) -> str:
    return (f"LEFT JOIN dim_empleado {alias} ON {alias}.id_empleado = {fid} AND {fdate} >= {alias}.fecha_inicio_validez "
            f"AND ({fdate} < {alias}.fecha_fin_validez OR {alias}.fecha_fin_validez IS NULL)")


o("j5_asof_join", with_ctes(f"""SELECT x.o_orderkey, x.fecha, COALESCE(de.empleado_key, '-1') AS empleado_key
FROM ({_SHIFT}) x {_asof('de', 'x.o_custkey', 'x.fecha')}""", "dim_empleado"))
o("j5b_asof_by_order", with_ctes(f"""SELECT x.o_orderkey, x.fecha, COALESCE(de.empleado_key, '-1') AS empleado_key
FROM ({_SHIFT}) x {_asof('de', 'x.o_custkey', 'x.fecha')}""", "dim_empleado"))
o("j6_role_playing_asof", with_ctes(f"""SELECT x.o_orderkey, COALESCE(dc.empleado_key, '-1') AS creador_key,
  CASE WHEN x.fecha_revision IS NOT NULL THEN COALESCE(dr.empleado_key, '-1') END AS revisor_key
FROM (SELECT *, (o_custkey * 7 + 3) % (SELECT COUNT(*) FROM customer) AS revisor,
             CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE fecha + 30 END AS fecha_revision FROM ({_SHIFT})) x
{_asof('dc', 'x.o_custkey', 'x.fecha')} {_asof('dr', 'x.revisor', 'x.fecha_revision')}""", "dim_empleado"))
_IV = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS inicio,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN CAST(o_orderdate AS DATE) - 2
       ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER) END AS fin
FROM orders WHERE o_orderstatus = 'F'"""
o("j7_interval_calendar_join", f"""SELECT c.fecha, CAST(COUNT(i.o_orderkey) AS BIGINT) AS activos
FROM ({_CAL}) c LEFT JOIN ({_IV}) i ON c.fecha BETWEEN i.inicio AND COALESCE(i.fin, i.inicio)
GROUP BY c.fecha""")
_OPEN = """SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS inicio,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN CAST(o_orderdate AS DATE) - 2
       ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 200 AS INTEGER) END AS fin FROM orders"""
o("j7b_distinct_active_per_day", f"""SELECT c.fecha, COUNT(DISTINCT i.o_custkey) AS clientes,
  COUNT(DISTINCT CASE WHEN i.o_orderpriority = '1-URGENT' THEN i.o_custkey END) AS clientes_urgentes
FROM ({_CAL}) c LEFT JOIN (
  SELECT o_custkey, o_orderpriority, CAST(UNNEST(generate_series(CAST(inicio AS TIMESTAMP), CAST(COALESCE(fin, inicio) AS TIMESTAMP),
         INTERVAL 1 DAY)) AS DATE) AS fecha FROM ({_OPEN}) WHERE COALESCE(fin, inicio) >= inicio) i ON c.fecha = i.fecha
GROUP BY c.fecha""")
o("j8_grand_total_share", f"""SELECT l_returnflag, CAST(SUM(q) AS DECIMAL(28,2)) AS cantidad,
  {pct('SUM(q)', 't.total', 2, 2)} AS pct_sobre_total
FROM (SELECT l_returnflag, {m('l_quantity')} AS q FROM lineitem)
CROSS JOIN (SELECT SUM({m('l_quantity')}) AS total FROM lineitem) t
GROUP BY l_returnflag, t.total""")
o("j9_preaggregated_child_join", """SELECT o.o_orderkey, CAST(COALESCE(c.n, 0) AS BIGINT) AS lineas,
  CAST(COALESCE(c.r, 0) AS BIGINT) AS devueltas
FROM orders o LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n, COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS r
                         FROM lineitem GROUP BY l_orderkey) c ON o.o_orderkey = c.l_orderkey""")
o("j10_deduplicated_child_join", """SELECT l.l_orderkey, l.l_linenumber, f.estado, f.pedido_representante
FROM (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS fecha FROM lineitem) l
LEFT JOIN (SELECT fecha, estado, pedido_representante FROM (
    SELECT CAST(o_orderdate AS DATE) AS fecha, o_orderpriority, MIN(o_orderstatus) AS estado,
           MIN(o_orderkey) AS pedido_representante
    FROM orders GROUP BY 1, 2)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY fecha ORDER BY o_orderpriority) = 1) f ON l.fecha = f.fecha""")
o("j11_daily_three_way_join", f"""SELECT c.fecha, CAST(COALESCE(o.n, 0) AS BIGINT) AS pedidos,
  CAST(COALESCE(l.n, 0) AS BIGINT) AS envios
FROM ({_CAL}) c
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS fecha, COUNT(*) AS n FROM orders GROUP BY 1) o ON c.fecha = o.fecha
LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS fecha, COUNT(*) AS n FROM lineitem GROUP BY 1) l ON c.fecha = l.fecha""")
o("j12_reconciliation_join", f"""SELECT o.mes, o.total_pedidos, l.total_lineas,
  CAST(o.total_pedidos - l.total_lineas AS DECIMAL(29,2)) AS diferencia
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mes,
             CAST(SUM({m('o_totalprice')}) AS DECIMAL(28,2)) AS total_pedidos FROM orders GROUP BY 1) o
JOIN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mes,
             CAST(SUM({m('l_extendedprice')}) AS DECIMAL(28,2)) AS total_lineas
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) l ON o.mes = l.mes
WHERE abs(o.total_pedidos - l.total_lineas) > 0.01""")
o("j13_scalar_subquery_filter", """SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= (SELECT COALESCE(MAX(o_orderdate), TIMESTAMP '1900-01-01 00:00:00') FROM orders) - INTERVAL 7 DAY""")
o("j14_referential_anti_join", """SELECT 'l_orderkey' AS columna, l_orderkey AS clave, l_linenumber FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL
SELECT 'l_partkey', key, l_linenumber
FROM (SELECT CASE WHEN l_orderkey % 50 = 0 THEN -l_partkey ELSE l_partkey END AS key, l_linenumber FROM lineitem)
WHERE key IS NOT NULL AND key NOT IN (SELECT p_partkey FROM part)""")

# ---------------------------------------------------------------- A
o("a1_grouped_aggregates", f"""SELECT l_returnflag, l_linestatus, CAST(SUM({m('l_quantity')}) AS DECIMAL(28,2)) AS suma,
  COUNT(*) AS lineas, CAST(ROUND({ddiv(f"SUM(CAST({m('l_quantity')} AS DECIMAL(38,2)))", f"COUNT({m('l_quantity')})", 2, 0)}, 2) AS DECIMAL(38,2)) AS media,
  MIN({m('l_extendedprice')}) AS minimo, MAX({m('l_extendedprice')}) AS maximo
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
o("a2_global_aggregate", f"""SELECT COUNT(*) AS lineas, CAST(SUM({m('l_extendedprice')}) AS DECIMAL(28,2)) AS importe,
  COUNT(DISTINCT l_orderkey) AS pedidos FROM lineitem""")
o("a3_monthly_bucket", f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mes, COUNT(*) AS pedidos,
  CAST(SUM({m('o_totalprice')}) AS DECIMAL(28,2)) AS importe FROM orders GROUP BY 1""")
o("a4_conditional_sum", f"""SELECT l_returnflag,
  CAST(SUM(CASE WHEN l_linestatus = 'O' THEN {m('l_quantity')} ELSE 0 END) AS DECIMAL(28,2)) AS cantidad_abierta,
  CAST(SUM(CASE WHEN l_linestatus = 'F' THEN {m('l_quantity')} ELSE 0 END) AS DECIMAL(28,2)) AS cantidad_cerrada
FROM lineitem GROUP BY l_returnflag""")
o("a5_count_if", """SELECT o_orderpriority, CAST(COUNT_IF(o_orderstatus = 'F') AS BIGINT) AS estado_f,
  CAST(COUNT_IF(o_orderstatus = 'O') AS BIGINT) AS estado_o, CAST(COUNT_IF(o_orderstatus = 'P') AS BIGINT) AS estado_p
FROM orders GROUP BY o_orderpriority""")
o("a6_count_via_null", "SELECT o_orderpriority, COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS cerrados FROM orders GROUP BY 1")
o("a7_count_distinct", "SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS partes FROM lineitem GROUP BY 1")
o("a7b_distinct_by_period", """WITH e AS (SELECT CAST(ts AS DATE) AS d, event_type, user_id FROM events),
p AS (SELECT 'dia' AS grano, d AS periodo, event_type, user_id FROM e
      UNION ALL SELECT 'mes', CAST(date_trunc('month', d) AS DATE), event_type, user_id FROM e
      UNION ALL SELECT 'trimestre', CAST(date_trunc('quarter', d) AS DATE), event_type, user_id FROM e)
SELECT grano, periodo, event_type, COUNT(DISTINCT user_id) AS usuarios FROM p GROUP BY 1, 2, 3
UNION ALL SELECT grano, periodo, 'todos', COUNT(DISTINCT user_id) FROM p GROUP BY 1, 2""")
o("a8_many_conditional_distinct", f"""SELECT CAST(ts AS DATE) AS dia, COUNT(DISTINCT user_id) AS usuarios,
  {', '.join(f"COUNT(DISTINCT CASE WHEN event_type = '{t}' THEN user_id END) AS usuarios_{t}" for t in ('click', 'error', 'purchase', 'signup', 'view'))}
FROM events GROUP BY 1""")
o("a9_exact_median", "SELECT l_returnflag, CAST(MEDIAN(l_quantity) AS DECIMAL(38,2)) AS mediana_cantidad FROM lineitem GROUP BY 1")
o("a9b_median_by_selection", f"""SELECT l_suppkey,
  CAST(CAST(MEDIAN(CAST({m('l_extendedprice')} * 100 AS BIGINT)) * 10 AS BIGINT) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(38,3)) AS mediana
FROM lineitem GROUP BY 1""")
o("a10_sample_stddev", """SELECT o_orderpriority, o_orderstatus,
  CAST(ROUND(STDDEV_SAMP(CAST(o_orderkey % 97 AS DOUBLE)), 2) AS DECIMAL(38,2)) AS desviacion FROM orders GROUP BY 1, 2""")
o("a11_ordered_distinct_list", """SELECT o_custkey, COALESCE(STRING_AGG(DISTINCT p, ', ' ORDER BY p), '') AS prioridades,
  COUNT(DISTINCT p) AS n_prioridades
FROM (SELECT o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders) GROUP BY 1""")
o("a12_ratio_percent", f"""SELECT l_returnflag, {pct('COUNT_IF(l_discount > 0.05)', 'COUNT(*)')} AS pct_descuento_alto,
  {pct(f"SUM({m('l_tax')})", f"SUM({m('l_discount')})", 2, 2)} AS pct_impuesto_sobre_descuento
FROM lineitem GROUP BY 1""")
o("a13_share_of_total", f"""SELECT l_linestatus, {pct('SUM(imp)', 't.total', 2, 2)} AS pct_importe
FROM (SELECT l_linestatus, {m('l_extendedprice')} AS imp FROM lineitem)
CROSS JOIN (SELECT SUM({m('l_extendedprice')}) AS total FROM lineitem) t GROUP BY l_linestatus, t.total""")
o("a14_having", "SELECT o_custkey, COUNT(*) AS pedidos FROM orders GROUP BY 1 HAVING COUNT(*) >= 15")
o("a15_distinct_projection", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
o("a16_group_by_expression", """SELECT COALESCE(CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_mktsegment END, 'desconocido') AS segmento,
  COUNT(*) AS clientes FROM customer GROUP BY 1""")
o("a17_min_representative", "SELECT CAST(o_orderdate AS DATE) AS fecha, MIN(o_orderpriority) AS prioridad, "
                            "MIN(o_orderkey) AS pedido FROM orders GROUP BY 1")
_D60 = "date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) - 60"
_M = ddiv(f"SUM(CAST(CASE WHEN {_D60} >= 0 THEN {_D60} END AS DECIMAL(38,0)))",
          f"COUNT(CASE WHEN {_D60} >= 0 THEN {_D60} END)")
o("a18_label_from_aggregate", f"""SELECT l_suppkey, CAST(ROUND({_M}, 2) AS DECIMAL(38,2)) AS media,
  CASE WHEN {_M} IS NULL THEN 'sin_datos' WHEN {_M} <= 3 THEN 'rapido' WHEN {_M} <= 7 THEN 'normal'
       WHEN {_M} <= 14 THEN 'lento' ELSE 'muy_lento' END AS categoria
FROM {_OL} GROUP BY l_suppkey""")
_LEAD = "CASE WHEN o_orderstatus = 'F' THEN date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) - 61 END"
o("a19_lead_time_subset", f"""SELECT l_returnflag,
  CAST(ROUND({ddiv(f'SUM(CAST({_LEAD} AS DECIMAL(38,0)))', f'COUNT({_LEAD})')}, 2) AS DECIMAL(38,2)) AS media_antelacion,
  CAST(MEDIAN({_LEAD}) AS DECIMAL(38,2)) AS mediana_antelacion
FROM {_OL} GROUP BY l_returnflag""")

# ---------------------------------------------------------------- W / R / O / U
o("w1_first_row_per_key", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1""")
o("w2_qualify_filter", """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS ultima_fecha FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
o("w3_version_numbering", """SELECT o_custkey, o_orderkey,
  CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS numero_pedido FROM orders""")
_EV = f"SELECT event_id, event_type, {m('value')} AS valor, ts FROM events"
o("w4_global_row_number", f"""SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY valor DESC NULLS FIRST, event_id) AS BIGINT) AS orden FROM ({_EV})""")
o("w5_row_number_in_partition", f"""SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts DESC NULLS FIRST, event_id)
  AS BIGINT) AS orden_tipo FROM ({_EV})""")
_REV = f"""SELECT c.c_custkey, c.c_mktsegment, r.ingresos FROM customer c
LEFT JOIN (SELECT o_custkey, CAST(SUM({m('o_totalprice')}) AS DECIMAL(28,2)) AS ingresos FROM orders GROUP BY 1) r
  ON c.c_custkey = r.o_custkey"""
o("w6_global_rank", f"SELECT *, CAST(RANK() OVER (ORDER BY ingresos DESC NULLS FIRST) AS BIGINT) AS ranking FROM ({_REV})")
o("w7_rank_in_partition", f"""SELECT *, CAST(RANK() OVER (PARTITION BY c_mktsegment ORDER BY ingresos DESC NULLS FIRST) AS BIGINT)
  AS ranking_segmento FROM ({_REV})""")
o("w8_rank_over_aggregate", f"""SELECT l_suppkey, CAST(SUM({m('l_quantity')}) AS DECIMAL(28,2)) AS cantidad,
  CAST(RANK() OVER (ORDER BY SUM({m('l_quantity')}) DESC NULLS FIRST) AS BIGINT) AS ranking FROM lineitem GROUP BY 1""")
_PS = f"""SELECT l_partkey, COUNT(*) AS lineas, CAST(SUM({m('l_quantity')}) AS DECIMAL(28,2)) AS cantidad,
  CAST(ROUND({ddiv(f"SUM(CAST({m('l_quantity')} AS DECIMAL(38,2)))", f"COUNT({m('l_quantity')})", 2, 0)}, 2) AS DECIMAL(38,2)) AS media
FROM lineitem GROUP BY 1"""
o("w9_qualified_rank", f"""SELECT *, CAST(RANK() OVER (ORDER BY CASE WHEN lineas >= 35 THEN media END ASC NULLS LAST) AS BIGINT)
  AS ranking_media FROM ({_PS})""")
o("w10_composite_rank", f"""SELECT *, CAST(RANK() OVER (ORDER BY lineas DESC NULLS FIRST, cantidad DESC NULLS FIRST) AS BIGINT)
  AS ranking FROM ({_PS})""")
_AVGP = ddiv("SUM(CAST(ingresos AS DECIMAL(38,2))) OVER s", "COUNT(ingresos) OVER s", 2, 0)
o("w11_partition_statistics", f"""SELECT c_custkey, c_mktsegment, ingresos, CAST(ROUND({_AVGP}, 2) AS DECIMAL(38,2)) AS media_segmento,
  COUNT(*) OVER s AS clientes_segmento,
  CAST(ROUND(STDDEV_SAMP(CAST(ingresos AS DOUBLE)) OVER s, 2) AS DECIMAL(38,2)) AS desviacion_segmento
FROM ({_REV}) WINDOW s AS (PARTITION BY c_mktsegment)""")
_SL = "SELECT l_suppkey, COUNT(*) AS lineas, CAST(COUNT_IF(l_returnflag = 'R') AS BIGINT) AS devueltas FROM lineitem GROUP BY 1"
o("w12_overall_mean", f"""SELECT l_suppkey, lineas, CAST(ROUND({ddiv('SUM(lineas) OVER ()', 'COUNT(lineas) OVER ()')}, 2)
  AS DECIMAL(38,2)) AS media_global FROM ({_SL})""")
o("w13_share_of_partition", f"""SELECT c_custkey, c_mktsegment, {pct('ingresos', 'SUM(ingresos) OVER (PARTITION BY c_mktsegment)', 2, 2)}
  AS pct_segmento FROM ({_REV})""")
o("w14_zscore_in_partition", f"""SELECT c_custkey, c_mktsegment,
  CAST(ROUND((CAST(ingresos AS DOUBLE) - CAST({_AVGP} AS DOUBLE)) / NULLIF(STDDEV_SAMP(CAST(ingresos AS DOUBLE)) OVER s, 0), 2)
    AS DECIMAL(38,2)) AS z_score
FROM ({_REV}) WINDOW s AS (PARTITION BY c_mktsegment)""")
o("w15_relative_class_overall", f"""SELECT l_suppkey, lineas,
  CASE WHEN lineas * COUNT(*) OVER () >= 2 * SUM(lineas) OVER () AND devueltas >= 1 THEN 'critico'
       WHEN lineas * COUNT(*) OVER () >= SUM(lineas) OVER () THEN 'problematico'
       WHEN 2 * lineas * COUNT(*) OVER () >= SUM(lineas) OVER () THEN 'normal' ELSE 'bajo_volumen' END AS clase
FROM ({_SL})""")
o("w16_relative_class_partition", """SELECT l_partkey, p_brand, lineas,
  CASE WHEN lineas >= 3 AND NOT disponible THEN 'retirado_problematico'
       WHEN lineas * COUNT(*) OVER b >= 2 * SUM(lineas) OVER b AND devueltas >= 1 THEN 'critico'
       WHEN lineas * COUNT(*) OVER b >= SUM(lineas) OVER b THEN 'frecuente' ELSE 'normal' END AS clase
FROM (SELECT p.p_partkey AS l_partkey, p.p_brand, p.p_size % 3 <> 0 AS disponible, x.lineas, x.devueltas
      FROM part p JOIN (SELECT l_partkey, COUNT(*) AS lineas, CAST(COUNT_IF(l_returnflag = 'R') AS BIGINT) AS devueltas
                        FROM lineitem GROUP BY 1) x ON p.p_partkey = x.l_partkey)
WINDOW b AS (PARTITION BY p_brand)""")
o("r1_scalable_global_rank", f"""SELECT *, CAST(RANK() OVER (ORDER BY grupo DESC NULLS FIRST) AS BIGINT) AS ranking_global,
  CAST(RANK() OVER (PARTITION BY o_orderstatus ORDER BY grupo ASC NULLS FIRST, importe DESC NULLS FIRST) AS BIGINT) AS ranking_estado,
  CAST(ROW_NUMBER() OVER (ORDER BY importe DESC NULLS FIRST, o_orderkey) AS BIGINT) AS orden_global
FROM (SELECT o_orderkey, o_orderstatus, {m('o_totalprice')} AS importe, o_orderkey % 7 AS grupo FROM orders)""")
o("o1_top_n", f"""SELECT * FROM (SELECT *, CAST(RANK() OVER (ORDER BY ingresos DESC NULLS FIRST) AS BIGINT) AS ranking
  FROM ({_REV})) WHERE ranking <= 10""")
o("u1_unknown_member_row", f"""SELECT {skey('s_suppkey')} AS proveedor_key, CAST(s_suppkey AS BIGINT) AS id_proveedor, s_name FROM supplier
UNION ALL SELECT '-1', -1, 'DESCONOCIDO'""")

# ---------------------------------------------------------------- I
from oracles.base import fact_incidencias_sql  # noqa: E402

_CUT = "TIMESTAMP '2026-01-15 00:00:00'"
_INITIAL = f"({fact_incidencias_sql(f'(SELECT * FROM stg_incidents WHERE fecha_creacion < {_CUT})')})"
_HWM = f"(SELECT COALESCE(MAX(fecha_actualizacion), TIMESTAMP '1900-01-01 00:00:00') FROM {_INITIAL}) - INTERVAL 7 DAY"
o("i1_lookback_delta", with_ctes(f"SELECT id_incidencia, fecha_actualizacion FROM stg_incidents "
                                 f"WHERE fecha_actualizacion >= {_HWM}", "stg_incidents", "dim_empleado"))
o("i2_upsert_by_key", _SPLIT + "SELECT * FROM tg WHERE id_pedido NOT IN (SELECT id_pedido FROM dl) UNION ALL SELECT * FROM dl")
o("i3_append_new_columns", _SPLIT + "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS prioridad) FROM tg "
                                    "WHERE id_pedido NOT IN (SELECT id_pedido FROM dl) UNION ALL SELECT * FROM dl")
o("i4_scd2_check_columns", with_ctes("SELECT * FROM snp_empleado", "snp_empleado"))
o("i4b_history_at_once", with_ctes("SELECT * FROM snp_empleado", "snp_empleado"))
o("i5b_many_extracts", """WITH months AS (
  SELECT c_custkey, n, (c_custkey * 7 + (c_custkey + n) // 5) % 6 <> 0 AS present,
    c_mktsegment || CAST(((c_custkey + n) // 9) % 2 AS VARCHAR) AS segmento, CAST(c_custkey + n AS BIGINT) AS saldo,
    TIMESTAMP '2022-01-01 00:00:00' + to_months(CAST(n AS INTEGER)) AS t
  FROM customer, range(24) m(n)),
states AS (SELECT *, LAG(present, 1, FALSE) OVER w AS was, LAG(segmento) OVER w AS old FROM months WINDOW w AS (PARTITION BY c_custkey ORDER BY n)),
changes AS (SELECT *, present AND (NOT was OR segmento <> old) AS opens FROM states
            WHERE (present AND (NOT was OR segmento <> old)) OR (was AND NOT present))
SELECT c_custkey,
  LAST_VALUE(CASE WHEN opens THEN segmento END IGNORE NULLS) OVER (PARTITION BY c_custkey ORDER BY n) AS segmento,
  LAST_VALUE(CASE WHEN opens THEN saldo END IGNORE NULLS) OVER (PARTITION BY c_custkey ORDER BY n) AS saldo,
  md5(CAST(c_custkey AS VARCHAR) || '|' || strftime(t, '%Y-%m-%d %H:%M:%S')) AS dbt_scd_id,
  t AS dbt_updated_at, t AS dbt_valid_from, LEAD(t) OVER (PARTITION BY c_custkey ORDER BY n) AS dbt_valid_to,
  NOT opens AS dbt_is_deleted FROM changes""")
o("i5_hard_delete", with_ctes("""SELECT id_empleado, puesto, dbt_valid_from, dbt_valid_to, dbt_is_deleted FROM snp_empleado
WHERE id_empleado IN (SELECT id_empleado FROM snp_empleado WHERE dbt_is_deleted)""", "snp_empleado"))
o("i6_history_bootstrap", with_ctes("""SELECT *, md5(CAST(id_empleado AS VARCHAR) || '|1900-01-01 00:00:00') AS dbt_scd_id,
  TIMESTAMP '1900-01-01 00:00:00' AS dbt_updated_at, TIMESTAMP '1900-01-01 00:00:00' AS dbt_valid_from,
  CAST(NULL AS TIMESTAMP) AS dbt_valid_to, FALSE AS dbt_is_deleted
FROM (SELECT id_empleado, nombre_token, tipo_usuario, puesto, dias_asuntos_propios, dias_vacaciones, dias_modulo,
             salidas_personales, dias_compensacion_grupos, horas_sindicales, es_mando_especial, fecha_creacion,
             fecha_actualizacion, categoria_puesto FROM stg_users_v1)""", "stg_users_v1"))
o("i7_version_dimension", with_ctes("""SELECT id_empleado, numero_version,
  CASE WHEN numero_version = 1 THEN TIMESTAMP '1900-01-01 00:00:00' ELSE dbt_valid_from END AS fecha_inicio_validez,
  dbt_valid_to AS fecha_fin_validez, dbt_valid_to IS NULL AND NOT COALESCE(dbt_is_deleted, FALSE) AS es_version_actual,
  COALESCE(dbt_is_deleted, FALSE) AS es_eliminado
FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY id_empleado ORDER BY dbt_valid_from) AS BIGINT) AS numero_version
      FROM snp_empleado)""", "snp_empleado"))
_DELTA = f"({fact_incidencias_sql(f'(SELECT * FROM stg_incidents WHERE fecha_actualizacion >= {_HWM})')})"
o("i8_late_correction_replay", with_ctes(
    f"SELECT * FROM {_INITIAL} WHERE incidencia_key NOT IN (SELECT incidencia_key FROM {_DELTA}) "
    f"UNION ALL SELECT * FROM {_DELTA}", "stg_incidents", "dim_empleado"))

# ---------------------------------------------------------------- C
_CAL2 = f"SELECT fecha AS date_day FROM ({_CAL})"
o("c1_time_spine", f"""SELECT date_day FROM ({_CAL2})
WHERE date_day BETWEEN (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders) AND (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)""")
_DUTY = """SELECT CAST(o_orderdate AS DATE) AS fecha, o_orderkey AS id_guardia,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'festivo' WHEN '2-HIGH' THEN 'prefestivo' WHEN '3-MEDIUM' THEN 'festivo víspera'
       ELSE 'laborable' END AS tipo_dia FROM orders"""
o("c2_calendar_dimension", f"""SELECT {skey('s.fecha')} AS fecha_key, s.fecha,
  CAST(year(s.fecha) AS BIGINT) AS anio, CAST(quarter(s.fecha) AS BIGINT) AS trimestre,
  CAST(month(s.fecha) AS BIGINT) AS mes, strftime(s.fecha, '%b') AS mes_nombre,
  CAST(weekofyear(s.fecha) AS BIGINT) AS semana_anio, CAST(day(s.fecha) AS BIGINT) AS dia,
  CAST(isodow(s.fecha) AS BIGINT) AS dia_semana_num, strftime(s.fecha, '%a') AS dia_semana_nombre,
  g.tipo_dia AS tipo_dia, g.tipo_dia IS NULL AS sin_datos_guardia,
  COALESCE(g.tipo_dia = 'festivo', FALSE) AS es_festivo, COALESCE(g.tipo_dia = 'prefestivo', FALSE) AS es_prefestivo,
  COALESCE(g.tipo_dia = 'festivo víspera', FALSE) AS es_festivo_vispera,
  COALESCE(g.tipo_dia = 'laborable', FALSE) AS es_laborable, isodow(s.fecha) IN (6, 7) AS es_fin_de_semana
FROM (SELECT date_day AS fecha FROM ({_CAL2})) s
LEFT JOIN (SELECT fecha, tipo_dia FROM ({_DUTY}) QUALIFY ROW_NUMBER() OVER (PARTITION BY fecha ORDER BY id_guardia) = 1) g
  ON s.fecha = g.fecha""")
o("c3_gap_free_daily_report", f"""SELECT c.fecha, CAST(COALESCE(o.n, 0) AS BIGINT) AS pedidos,
  CAST(COALESCE(o.imp, 0) AS DECIMAL(28,2)) AS importe
FROM ({_CAL}) c LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS fecha, COUNT(*) AS n, SUM({m('o_totalprice')}) AS imp
                           FROM orders GROUP BY 1) o ON c.fecha = o.fecha""")

# ---------------------------------------------------------------- Q
o("q1_unique", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_filas FROM lineitem "
               "WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) > 1")
o("q2_not_null", with_ctes("SELECT id_incidencia, fecha_creacion FROM stg_incidents WHERE fecha_actualizacion IS NULL",
                           "stg_incidents"))
o("q3_accepted_values", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL "
                        "AND o_orderstatus NOT IN ('F', 'O')")
o("q4_relationships", with_ctes("""SELECT id_asignacion, id_empleado FROM stg_assignments
WHERE id_empleado IS NOT NULL AND id_empleado NOT IN (SELECT id_empleado FROM stg_users WHERE id_empleado IS NOT NULL)""",
                                "stg_assignments", "stg_users"))
o("q5_expression_is_true", with_ctes("SELECT id_hora_extra, total_horas FROM fact_horas_extra WHERE NOT (total_horas <= 20)",
                                     "fact_horas_extra"))
o("q6_conditional_test", with_ctes("""SELECT id_incidencia, fecha_creacion, fecha_actualizacion FROM stg_incidents
WHERE estado = 'resuelta' AND dias_resolucion IS NULL""", "stg_incidents"))


def _report(rows) -> str:
    parts = [f"SELECT '{n}' AS check_name, '{t}' AS table_name, '{k}' AS check_kind, '{s}' AS severity, "
             f"CAST(({sql}) AS BIGINT) AS failing_rows" for n, t, k, s, sql in rows]
    body = " UNION ALL ".join(parts)
    return (f"SELECT *, CASE WHEN failing_rows = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END "
            f"AS status FROM ({body})")


o("q7_severity_status", with_ctes(_report([
    ("incidencia_unica", "stg_incidents", "unique", "error",
     "SELECT COUNT(*) FROM (SELECT id_incidencia FROM stg_incidents WHERE id_incidencia IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"),
    ("actualizacion_informada", "stg_incidents", "not_null", "warn",
     "SELECT COUNT(*) FROM stg_incidents WHERE fecha_actualizacion IS NULL"),
    ("estado_pedido", "orders", "accepted_values", "error",
     "SELECT COUNT(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P')"),
    ("prioridad_pedido", "orders", "accepted_values", "warn",
     "SELECT COUNT(*) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"),
    ("linea_pedido", "lineitem", "unique", "error",
     "SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)"),
]), "stg_incidents"))
o("q8_counter_reconciliation", with_ctes("""SELECT f.id_solicitud, f.total_fact, r.total_real, f.total_fact - r.total_real AS diferencia
FROM (SELECT id_solicitud, total_asignaciones_generadas + IF(id_solicitud % 40 = 0, 1, 0) AS total_fact FROM fact_solicitudes WHERE total_asignaciones_generadas > 0) f
JOIN (SELECT id_solicitud, COUNT(*) AS total_real FROM stg_assignments WHERE id_solicitud IS NOT NULL GROUP BY 1) r
  ON f.id_solicitud = r.id_solicitud
WHERE f.total_fact <> r.total_real""", "fact_solicitudes", "stg_assignments"))
o("q9_cost_reconciliation", with_ctes("""SELECT f.mes, f.coste_fact, c.coste_calculado,
  CAST(abs(f.coste_fact - c.coste_calculado) AS DECIMAL(38,2)) AS diferencia
FROM (SELECT CAST(date_trunc('month', fecha) AS DATE) AS mes, CAST(ROUND(SUM(coste_total + IF(day(fecha) = 31 AND id_hora_extra % 3 = 0, 0.02, 0.00)), 2) AS DECIMAL(38,2)) AS coste_fact
      FROM fact_horas_extra GROUP BY 1) f
JOIN (SELECT CAST(date_trunc('month', eh.fecha) AS DATE) AS mes,
             CAST(ROUND(SUM(CAST(eh.horas_diurnas AS DECIMAL(38,0)) * s.precio_hora_diurna)
                        + SUM(CAST(eh.horas_nocturnas AS DECIMAL(38,0)) * s.precio_hora_nocturna), 2) AS DECIMAL(38,2))
               AS coste_calculado
      FROM stg_extra_hours eh JOIN stg_salaries s ON eh.id_salario = s.id_salario GROUP BY 1) c ON f.mes = c.mes
WHERE abs(f.coste_fact - c.coste_calculado) > 0.01""", "fact_horas_extra", "stg_extra_hours", "stg_salaries"))
o("q10_daily_hours_cap", with_ctes("""SELECT id_empleado, fecha, CAST(SUM(total_horas) AS BIGINT) AS total_horas_dia,
  COUNT(*) AS num_registros FROM stg_extra_hours GROUP BY 1, 2 HAVING SUM(total_horas) > 24""", "stg_extra_hours"))
o("q11_resolved_before_created", with_ctes("""SELECT id_incidencia, fecha_creacion, fecha_actualizacion, estado,
  CAST(date_diff('day', CAST(fecha_creacion AS DATE), CAST(fecha_actualizacion AS DATE)) AS BIGINT) AS desfase_dias
FROM stg_incidents WHERE estado = 'resuelta' AND fecha_creacion IS NOT NULL AND fecha_actualizacion IS NOT NULL
  AND fecha_actualizacion < fecha_creacion""", "stg_incidents"))
o("q12_end_before_start", with_ctes("""SELECT id_solicitud, id_empleado, tipo_permiso, fecha_inicio, fecha_fin,
  CAST(date_diff('day', fecha_inicio, fecha_fin) AS BIGINT) AS dias_desfase
FROM stg_requests WHERE fecha_inicio IS NOT NULL AND fecha_fin IS NOT NULL AND fecha_fin < fecha_inicio""", "stg_requests"))
o("q13_one_current_version", with_ctes("""SELECT id_empleado, COUNT(*) AS versiones_actuales FROM dim_empleado
WHERE (es_version_actual OR id_empleado % 10 = 0) AND id_empleado <> -1 GROUP BY 1 HAVING COUNT(*) > 1""", "dim_empleado"))

# Every gold table and view by its own SQL: DuckDB's description of the columns, under Spark's names of the types
_TABLES = {t: with_ctes(f"SELECT * FROM {t}", t) for t in NOT_NULL if not t.startswith("v")}
_TABLES |= {name.split("_")[0]: sql for name, sql in VIEWS.items() if name.split("_")[0] in NOT_NULL}
_TYPE = """CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  ELSE lower(column_type) END"""


def _contract(table: str) -> str:
    nulls = " UNION ALL ".join(f"SELECT '{c}' AS of_column, COUNT(*) - COUNT({c}) AS n FROM t" for c in NOT_NULL[table])
    return f"""SELECT '{table}' AS table_name, column_name, {_TYPE} AS expected_type, {_TYPE} AS actual_type,
  n IS NOT NULL AS is_not_null, COALESCE(n, 0) AS null_violations, COALESCE(n, 0) = 0 AS passes
FROM (DESCRIBE {_TABLES[table]}) d
LEFT JOIN (WITH t AS ({_TABLES[table]}) {nulls}) m ON of_column = column_name"""


o("q14_contract_enforcement", "\nUNION ALL\n".join(_contract(t) for t in NOT_NULL))

o("q15_quality_report", with_ctes(_report([
    ("stg_incidents_id_unique", "stg_incidents", "unique", "error",
     "SELECT COUNT(*) FROM (SELECT id_incidencia FROM stg_incidents WHERE id_incidencia IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"),
    ("stg_incidents_estado_accepted", "stg_incidents", "accepted_values", "error",
     "SELECT COUNT(*) FROM stg_incidents WHERE estado NOT IN ('pendiente', 'tramitada', 'resuelta')"),
    ("stg_incidents_nivel_accepted", "stg_incidents", "accepted_values", "error",
     "SELECT COUNT(*) FROM stg_incidents WHERE nivel_gravedad NOT IN ('bajo', 'medio', 'alto')"),
    ("stg_incidents_dias_range", "stg_incidents", "expression", "warn",
     "SELECT COUNT(*) FROM stg_incidents WHERE dias_resolucion IS NOT NULL AND NOT (dias_resolucion BETWEEN 0 AND 1825)"),
    ("stg_requests_estado_accepted", "stg_requests", "accepted_values", "error",
     "SELECT COUNT(*) FROM stg_requests WHERE estado NOT IN ('pendiente', 'confirmada', 'cancelada', 'denegada')"),
    ("stg_requests_inicio_not_null", "stg_requests", "not_null", "warn",
     "SELECT COUNT(*) FROM stg_requests WHERE fecha_inicio IS NULL"),
    ("stg_assignments_tipo_accepted", "stg_assignments", "accepted_values", "error",
     "SELECT COUNT(*) FROM stg_assignments WHERE tipo_asignacion NOT IN ('ida', 'vuelta')"),
    ("stg_assignments_empleado_exists", "stg_assignments", "relationship", "warn",
     "SELECT COUNT(*) FROM stg_assignments WHERE id_empleado IS NOT NULL AND id_empleado NOT IN (SELECT id_empleado FROM stg_users)"),
    ("stg_users_id_unique", "stg_users", "unique", "error",
     "SELECT COUNT(*) FROM (SELECT id_empleado FROM stg_users WHERE id_empleado IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"),
    ("stg_users_categoria_accepted", "stg_users", "accepted_values", "error",
     "SELECT COUNT(*) FROM stg_users WHERE categoria_puesto NOT IN ('Tropa', 'Mando', 'Administrativo', 'Desconocido')"),
    ("fact_horas_extra_key_unique", "fact_horas_extra", "unique", "error",
     "SELECT COUNT(*) FROM (SELECT horas_extra_key FROM fact_horas_extra WHERE horas_extra_key IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"),
    ("fact_horas_extra_tipo_dia_not_null", "fact_horas_extra", "not_null", "error",
     "SELECT COUNT(*) FROM fact_horas_extra WHERE tipo_dia IS NULL"),
    ("fact_horas_extra_coste_sum", "fact_horas_extra", "expression", "error",
     "SELECT COUNT(*) FROM fact_horas_extra WHERE NOT (coste_total = coste_diurno + coste_nocturno)"),
    ("fact_horas_extra_empleado_exists", "fact_horas_extra", "relationship", "warn",
     "SELECT COUNT(*) FROM fact_horas_extra WHERE id_empleado IS NOT NULL AND id_empleado NOT IN (SELECT id_empleado FROM stg_users)"),
]), "stg_incidents", "stg_requests", "stg_assignments", "stg_users", "fact_horas_extra"))

# ---------------------------------------------------------------- M
_R6 = lambda a, b: ddiv(a, b)
o("m1_metric_sum", with_ctes("""SELECT CAST(SUM(coste_total) AS DECIMAL(38,2)) AS coste_total_horas_extra,
  CAST(SUM(coste_diurno) AS DECIMAL(38,2)) AS coste_diurno_horas_extra,
  CAST(SUM(coste_nocturno) AS DECIMAL(38,2)) AS coste_nocturno_horas_extra,
  CAST(SUM(total_horas) AS BIGINT) AS total_horas_extra FROM fact_horas_extra""", "fact_horas_extra"))
o("m2_metric_count", with_ctes("SELECT tipo_incidencia, COUNT(incidencia_key) AS total_incidencias FROM fact_incidencias GROUP BY 1",
                               "fact_incidencias"))
o("m3_metric_count_distinct", with_ctes("SELECT tipo_dia, COUNT(DISTINCT id_empleado) AS bomberos_con_horas_extra "
                                        "FROM fact_horas_extra GROUP BY 1", "fact_horas_extra"))
o("m4_metric_average", with_ctes(f"""SELECT tipo_incidencia, nivel_gravedad,
  {ddiv('SUM(CAST(dias_resolucion AS DECIMAL(38,0)))', 'COUNT(dias_resolucion)')} AS mttr_dias
FROM fact_incidencias GROUP BY 1, 2""", "fact_incidencias"))
o("m5_filtered_metric", with_ctes("""SELECT tipo_permiso,
  COUNT(CASE WHEN estado = 'confirmada' THEN solicitud_key END) AS solicitudes_confirmadas,
  COUNT(CASE WHEN estado = 'denegada' THEN solicitud_key END) AS solicitudes_denegadas
FROM fact_solicitudes GROUP BY 1""", "fact_solicitudes"))
o("m6_ratio_metric", with_ctes(f"""SELECT r.*, {_R6('r.solicitudes_confirmadas', 'r.total_solicitudes')} AS tasa_aprobacion,
  {_R6('r.solicitudes_denegadas', 'r.total_solicitudes')} AS tasa_denegacion,
  {_R6('r.total_requerimientos', 'r.total_solicitudes')} AS ratio_requerimientos_por_solicitud,
  i.*, {_R6('i.incidencias_resueltas', 'i.total_incidencias')} AS tasa_resolucion,
  {_R6('i.incidencias_pendientes', 'i.total_incidencias')} AS tasa_pendientes
FROM (SELECT COUNT(solicitud_key) AS total_solicitudes,
             COUNT(CASE WHEN estado = 'confirmada' THEN solicitud_key END) AS solicitudes_confirmadas,
             COUNT(CASE WHEN estado = 'denegada' THEN solicitud_key END) AS solicitudes_denegadas,
             CAST(SUM(dias_solicitados) AS BIGINT) AS dias_ausencia_solicitados,
             CAST(SUM(total_asignaciones_generadas) AS BIGINT) AS total_asignaciones_generadas,
             CAST(SUM(total_requerimientos_generados) AS BIGINT) AS total_requerimientos FROM fact_solicitudes) r,
     (SELECT COUNT(incidencia_key) AS total_incidencias, CAST(SUM(es_resuelta) AS BIGINT) AS incidencias_resueltas,
             CAST(SUM(es_pendiente) AS BIGINT) AS incidencias_pendientes,
             CAST(SUM(es_tramitada) AS BIGINT) AS incidencias_tramitadas,
             {ddiv('SUM(CAST(dias_resolucion AS DECIMAL(38,0)))', 'COUNT(dias_resolucion)')} AS mttr_dias
      FROM fact_incidencias) i""", "fact_solicitudes", "fact_incidencias"))
o("m7_metric_by_dimension", with_ctes(f"""SELECT e.categoria_puesto,
  CAST(SUM(f.coste_total) AS DECIMAL(38,2)) AS coste_total_horas_extra,
  CAST(SUM(f.coste_diurno) AS DECIMAL(38,2)) AS coste_diurno_horas_extra,
  CAST(SUM(f.coste_nocturno) AS DECIMAL(38,2)) AS coste_nocturno_horas_extra,
  CAST(SUM(f.total_horas) AS BIGINT) AS total_horas_extra, COUNT(DISTINCT f.id_empleado) AS bomberos_con_horas_extra,
  {ddiv('SUM(f.coste_total)', 'SUM(f.total_horas)', 2, 0)} AS coste_medio_por_hora
FROM fact_horas_extra f LEFT JOIN dim_empleado e ON f.empleado_key = e.empleado_key GROUP BY 1""",
                                      "fact_horas_extra", "dim_empleado"))
o("m8_metric_by_time_grain", with_ctes(f"""SELECT s.periodo, h.* EXCLUDE (periodo), r.* EXCLUDE (periodo), i.* EXCLUDE (periodo)
FROM (SELECT DISTINCT CAST(date_trunc('month', date_day) AS DATE) AS periodo FROM dim_time) s
LEFT JOIN (SELECT CAST(date_trunc('month', fecha) AS DATE) AS periodo,
  CAST(SUM(coste_total) AS DECIMAL(38,2)) AS coste_total_horas_extra,
  CAST(SUM(coste_diurno) AS DECIMAL(38,2)) AS coste_diurno_horas_extra,
  CAST(SUM(coste_nocturno) AS DECIMAL(38,2)) AS coste_nocturno_horas_extra,
  CAST(SUM(total_horas) AS BIGINT) AS total_horas_extra, COUNT(DISTINCT id_empleado) AS bomberos_con_horas_extra,
  {ddiv('SUM(coste_total)', 'SUM(total_horas)', 2, 0)} AS coste_medio_por_hora
  FROM fact_horas_extra GROUP BY 1) h ON s.periodo = h.periodo
LEFT JOIN (SELECT CAST(date_trunc('month', fecha_inicio) AS DATE) AS periodo,
  COUNT(solicitud_key) AS total_solicitudes,
  COUNT(CASE WHEN estado = 'confirmada' THEN solicitud_key END) AS solicitudes_confirmadas,
  COUNT(CASE WHEN estado = 'denegada' THEN solicitud_key END) AS solicitudes_denegadas,
  CAST(SUM(dias_solicitados) AS BIGINT) AS dias_ausencia_solicitados,
  CAST(SUM(total_asignaciones_generadas) AS BIGINT) AS total_asignaciones_generadas,
  CAST(SUM(total_requerimientos_generados) AS BIGINT) AS total_requerimientos,
  {_R6("COUNT(CASE WHEN estado = 'confirmada' THEN solicitud_key END)", 'COUNT(solicitud_key)')} AS tasa_aprobacion,
  {_R6("COUNT(CASE WHEN estado = 'denegada' THEN solicitud_key END)", 'COUNT(solicitud_key)')} AS tasa_denegacion,
  {_R6('SUM(total_requerimientos_generados)', 'COUNT(solicitud_key)')} AS ratio_requerimientos_por_solicitud
  FROM fact_solicitudes GROUP BY 1) r ON s.periodo = r.periodo
LEFT JOIN (SELECT CAST(date_trunc('month', fecha_incidencia) AS DATE) AS periodo,
  COUNT(incidencia_key) AS total_incidencias, CAST(SUM(es_resuelta) AS BIGINT) AS incidencias_resueltas,
  CAST(SUM(es_pendiente) AS BIGINT) AS incidencias_pendientes, CAST(SUM(es_tramitada) AS BIGINT) AS incidencias_tramitadas,
  {ddiv('SUM(CAST(dias_resolucion AS DECIMAL(38,0)))', 'COUNT(dias_resolucion)')} AS mttr_dias,
  {_R6('SUM(es_resuelta)', 'COUNT(incidencia_key)')} AS tasa_resolucion,
  {_R6('SUM(es_pendiente)', 'COUNT(incidencia_key)')} AS tasa_pendientes
  FROM fact_incidencias GROUP BY 1) i ON s.periodo = i.periodo""",
    "fact_horas_extra", "fact_solicitudes", "fact_incidencias", "dim_time"))
o("i9_micro_batch_fact_load", with_ctes("SELECT * FROM fact_incidencias", "fact_incidencias"))

from brasa.plans.contracts import EXPRESSION_TESTS, expression_test_name  # noqa: E402
from oracles.views import VIEWS  # noqa: E402

_VIEW_SQL = {k.split("_")[0]: v for k, v in VIEWS.items()}


def _source(table: str) -> str:
    if table.startswith("fact_"):
        return table
    key = table.split("_")[0]
    return f"({_VIEW_SQL[key]})"


_Q5B = []
for _i, (_t, _e, _w, _s) in enumerate(EXPRESSION_TESTS):
    _where = f"({_w}) AND " if _w else ""
    _name = expression_test_name(_t, _e, _w).replace("'", "''")
    _Q5B.append((_name, _t, "expression", _s, f"SELECT COUNT(*) FROM {_source(_t)} WHERE {_where}NOT ({_e})"))
o("q5b_gold_expression_tests", with_ctes(_report(_Q5B), "fact_horas_extra", "fact_solicitudes", "fact_asignaciones",
                                         "fact_incidencias", "dim_fecha", "dim_brigada", "dim_empleado", "dim_parque",
                                         "dim_vehiculo", "dim_equipo"))
o("s6b_partitioned_merge_sink", OPERATORS["i8_late_correction_replay"])

o("m8b_metric_by_day", with_ctes(f"""SELECT s.date_day AS periodo, CAST(SUM(coste_total) AS DECIMAL(38,2)) AS coste_total_horas_extra,
  CAST(SUM(coste_diurno) AS DECIMAL(38,2)) AS coste_diurno_horas_extra,
  CAST(SUM(coste_nocturno) AS DECIMAL(38,2)) AS coste_nocturno_horas_extra,
  CAST(SUM(total_horas) AS BIGINT) AS total_horas_extra,
  IF(COUNT(h.fecha) > 0, COUNT(DISTINCT id_empleado), NULL) AS bomberos_con_horas_extra,
  {ddiv('SUM(coste_total)', 'SUM(total_horas)', 2, 0)} AS coste_medio_por_hora
FROM dim_time s LEFT JOIN fact_horas_extra h ON h.fecha = s.date_day GROUP BY s.date_day""", "dim_time", "fact_horas_extra"))
o("s6c_month_merge_cases", """SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 = 0 THEN IF(o_orderkey % 9 = 0, NULL, CAST(o_orderdate AS DATE) + 40)
       WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS fecha,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) + IF(o_orderkey % 3 = 0, 3, 0) AS DECIMAL(18,2)) AS importe,
  CAST(IF(o_orderkey % 3 = 0, 3, 1) AS INTEGER) AS version, IF(o_orderkey % 3 = 0, 'corregido', NULL) AS nota FROM orders""")
o("s3b_freshness_of_all_sources", "WITH loaded AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS source, MAX(TIMESTAMP '2026-09-01 00:00:00') AS max_loaded_at FROM {t}" for n, t in (
        ("equipos_personales", "part"), ("extra_hours", "orders"), ("firefighters_assignments", "orders"),
        ("guards", "orders"), ("incidents", "events"), ("requests", "orders"),
        ("shift_change_requests", "orders"), ("users", "customer"), ("vehicles", "supplier"))) + """)
SELECT source, DATE '2026-10-15' AS as_of, max_loaded_at, CAST(date_diff('day', max_loaded_at, TIMESTAMP '2026-10-15 00:00:00') AS BIGINT) AS age_days,
  CASE WHEN source = 'shift_change_requests' THEN 'skipped' ELSE 'warn' END AS status FROM loaded""")

_GOLD = {"dim_fecha": "fecha_key", "dim_parque": "parque_key", "dim_brigada": "brigada_key", "dim_equipo": "equipo_key",
         "dim_vehiculo": "vehiculo_key", "dim_puesto": "puesto_key", "dim_salario": "salario_key",
         "dim_empleado": "empleado_key", "fact_horas_extra": "horas_extra_key", "fact_solicitudes": "solicitud_key",
         "fact_asignaciones": "asignacion_key", "fact_incidencias": "incidencia_key"}
_POINTS = {"fact_horas_extra": {"empleado_key": "dim_empleado", "fecha_key": "dim_fecha", "brigada_key": "dim_brigada",
                                "salario_key": "dim_salario"},
           "fact_solicitudes": {"empleado_key": "dim_empleado", "fecha_inicio_key": "dim_fecha", "fecha_fin_key": "dim_fecha"},
           "fact_asignaciones": {"empleado_key": "dim_empleado", "fecha_key": "dim_fecha", "brigada_origen_key": "dim_brigada",
                                 "brigada_destino_key": "dim_brigada", "solicitud_key": "fact_solicitudes"},
           "fact_incidencias": {"empleado_creador_key": "dim_empleado", "empleado_resolutor_key": "dim_empleado",
                                "fecha_key": "dim_fecha", "parque_key": "dim_parque", "vehiculo_key": "dim_vehiculo",
                                "equipo_key": "dim_equipo"}}
o("q1b_gold_keys", with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{k}' AS key_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({k}) AS null_keys, "
    f"COUNT({k}) - COUNT(DISTINCT {k}) AS repeated_keys FROM {t}" for t, k in _GOLD.items()), *_GOLD))
o("q4b_gold_references", with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS child, '{c}' AS column_name, '{p}' AS parent, (SELECT COUNT(*) FROM {t} WHERE {c} IS NOT NULL "
    f"AND {c} NOT IN (SELECT {_GOLD[p]} FROM {p})) AS orphans" for t, points in _POINTS.items() for c, p in points.items()), *_GOLD))
o("s3c_freshness_from_footers", f"SELECT f.*, (SELECT COUNT(*) FROM events) AS filas FROM ({OPERATORS['s3_source_freshness']}) f")
o("j2b_colocated_join", OPERATORS["j2_fact_dimension_join"])
o("i1b_lookback_from_footers", OPERATORS["i1_lookback_delta"])
o("s6d_merge_with_key_filters", f"""SELECT id_pedido, CAST(fecha + IF(fecha > (SELECT MAX(fecha) FROM ({TYPED_ORDERS})) - 30, 40, 0) AS DATE) AS fecha, importe
FROM ({TYPED_ORDERS})""")
