"""DuckDB text of every registered query, over the same tables.

``STAGE`` and the other shared blocks are common table expressions that the queries put in front.
"""

from __future__ import annotations

PERSON_KEY = "clave-de-prueba"

LINES = """
lines_all AS (
  SELECT l_orderkey * 8 + l_linenumber AS id_item, l_orderkey, l_partkey, l_suppkey,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS codigo,
         CAST(l_suppkey AS VARCHAR) AS codigo_proveedor,
         CAST(l_shipdate AS DATE) AS fecha_ultima_modificacion,
         CAST(l_quantity AS DECIMAL(20,4)) AS cantidad,
         CAST(l_extendedprice AS DECIMAL(20,4)) AS total_linea_neto,
         l_linestatus AS unidad_medida
  FROM lineitem
),
lines AS (
  SELECT * FROM lines_all
  QUALIFY row_number() OVER (
    PARTITION BY id_item
    ORDER BY fecha_ultima_modificacion DESC, total_linea_neto DESC, codigo_proveedor DESC) = 1
)"""

STAGE = LINES + """,
supplier_attrs AS (
  SELECT s_suppkey, s_name AS nombre_proveedor,
         CAST(1000000 + (s_suppkey * 7919003) % 98000000 AS VARCHAR) || '-' ||
           CASE WHEN s_suppkey % 11 = 10 THEN 'K' ELSE CAST(s_suppkey % 11 AS VARCHAR) END AS rut_proveedor,
         1000000 + (s_suppkey * 7919003) % 98000000 < 50000000 AS es_persona_natural,
         CAST(s_nationkey AS VARCHAR) AS region_proveedor
  FROM supplier
),
headers AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS mes, CAST(o_orderdate AS DATE) AS fecha_envio,
         o_orderstatus AS tipo, ascii(o_orderstatus) AS codigo_estado,
         o_orderpriority = '1-URGENT' AS es_trato_directo, o_orderpriority = '5-LOW' AS es_compra_agil,
         CAST(n_nationkey AS VARCHAR) AS codigo_organismo, n_name AS nombre_organismo, r_name AS sector,
         CAST(c_custkey AS VARCHAR) AS codigo_unidad, c_name AS nombre_unidad, c_mktsegment AS region_unidad
  FROM orders JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
),
stage AS (
  SELECT l.*, h.* EXCLUDE (o_orderkey), h.fecha_envio AS fecha_creacion, s.* EXCLUDE (s_suppkey),
         CAST(sum(l.total_linea_neto) OVER (PARTITION BY l.codigo) AS DECIMAL(20,4)) AS monto_total_oc_clp,
         p_name AS producto_generico, p_type AS rubro_n1, p_brand AS rubro_n2, CAST(p_size AS VARCHAR) AS rubro_n3,
         CAST(p_retailprice AS DECIMAL(20,4)) AS precio_neto, CAST(l_partkey AS VARCHAR) AS codigo_producto_onu
  FROM lines l JOIN headers h ON h.o_orderkey = l.l_orderkey
  JOIN supplier_attrs s ON s.s_suppkey = l.l_suppkey JOIN part ON p_partkey = l.l_partkey
)"""

ORDERS = STAGE + """,
oc AS (
  SELECT mes, codigo, max(codigo_organismo) AS codigo_organismo, max(nombre_organismo) AS nombre_organismo,
         max(sector) AS sector, max(codigo_unidad) AS codigo_unidad, max(codigo_proveedor) AS codigo_proveedor,
         max(nombre_proveedor) AS nombre_proveedor, max(rut_proveedor) AS rut_proveedor,
         max(fecha_creacion) AS fecha_creacion, max(fecha_envio) AS fecha_envio, max(tipo) AS tipo,
         bool_or(es_trato_directo) AS es_trato_directo, bool_or(es_compra_agil) AS es_compra_agil,
         max(codigo_estado) AS codigo_estado, max(monto_total_oc_clp) AS monto, count(*) AS cantidad_items
  FROM stage GROUP BY mes, codigo
)"""

# Shares are taken per supplier here, while the Spark side works from the sum of squared amounts.
SUMMARY = ORDERS + """,
pairs AS (
  SELECT mes, codigo_organismo, codigo_proveedor, max(nombre_organismo) AS nombre_organismo, max(sector) AS sector,
         max(nombre_proveedor) AS nombre_proveedor, max(rut_proveedor) AS rut_proveedor,
         sum(monto) AS m, count(*) AS n,
         sum(CASE WHEN es_trato_directo THEN monto ELSE 0 END) AS m_directo,
         sum(CASE WHEN es_compra_agil THEN monto ELSE 0 END) AS m_agil
  FROM oc WHERE monto > 0 GROUP BY mes, codigo_organismo, codigo_proveedor
),
shared AS (
  SELECT *, sum(n) OVER e AS ordenes, count(*) OVER e AS proveedores,
         sum(m_directo) OVER e AS directo, sum(m_agil) OVER e AS agil,
         sum(pow(100 * CAST(m AS DOUBLE) / CAST(total AS DOUBLE), 2)) OVER e AS hhi_raw,
         row_number() OVER (PARTITION BY mes, codigo_organismo ORDER BY m DESC, codigo_proveedor) AS posicion
  FROM (SELECT *, sum(m) OVER (PARTITION BY mes, codigo_organismo) AS total FROM pairs)
  WINDOW e AS (PARTITION BY mes, codigo_organismo)
),
summary AS (
  SELECT codigo_organismo, nombre_organismo, sector, mes, CAST(total AS DOUBLE) AS monto_clp,
         CAST(ordenes AS BIGINT) AS ordenes, proveedores,
         round(100 * CAST(directo AS DOUBLE) / CAST(total AS DOUBLE), 2) AS pct_monto_trato_directo,
         round(100 * CAST(agil AS DOUBLE) / CAST(total AS DOUBLE), 2) AS pct_monto_compra_agil,
         round(hhi_raw, 0) AS hhi, posicion, codigo_proveedor, nombre_proveedor, rut_proveedor,
         CAST(m AS DOUBLE) AS monto_proveedor_clp, n AS ordenes_proveedor,
         round(100 * CAST(m AS DOUBLE) / CAST(total AS DOUBLE), 2) AS pct_proveedor
  FROM shared WHERE posicion <= 5
)"""


def _with(block: str, query: str) -> str:
    return f"WITH {block.strip()}\n{query.strip()}"



EXPLODED = """
SELECT codigo_organismo, mes, nombre_organismo, sector, monto_clp, ordenes, proveedores, pct_monto_trato_directo,
       pct_monto_compra_agil, CAST(hhi AS INTEGER) AS hhi, CAST(posicion AS INTEGER) AS p_posicion,
       codigo_proveedor AS p_codigo_proveedor, nombre_proveedor AS p_nombre_proveedor, rut_proveedor AS p_rut_proveedor,
       monto_proveedor_clp AS p_monto_clp, ordenes_proveedor AS p_ordenes, pct_proveedor AS p_pct_monto
FROM summary"""

ALERTED = SUMMARY + """,
ranked AS (
  SELECT mes, codigo_organismo,
         CAST(row_number() OVER (PARTITION BY mes ORDER BY hhi DESC, monto_clp DESC, codigo_organismo) AS INTEGER) AS posicion_alerta
  FROM summary WHERE posicion = 1 AND hhi >= 2500
)"""

RAW = STAGE + """,
raw_rows AS (
  SELECT l.*, h.* EXCLUDE (o_orderkey), h.fecha_envio AS fecha_creacion, s.* EXCLUDE (s_suppkey),
         p_name AS producto_generico, p_type AS rubro_n1, p_brand AS rubro_n2,
         CAST(p_retailprice AS DECIMAL(20,4)) AS precio_neto
  FROM lines_all l JOIN headers h ON h.o_orderkey = l.l_orderkey
  JOIN supplier_attrs s ON s.s_suppkey = l.l_suppkey JOIN part ON p_partkey = l.l_partkey
)"""

TOKEN = f"sha256('{PERSON_KEY}' || regexp_replace(upper(rut_proveedor), '[^0-9K]', '', 'g'))"

UNITS = RAW + """,
loads AS (
  SELECT mes >= '1998-07' AS second, codigo_organismo, nombre_organismo, codigo AS sector, codigo_unidad, nombre_unidad,
         rubro_n2 AS rut_unidad, rubro_n1 AS region_unidad
  FROM raw_rows
  QUALIFY row_number() OVER (
    PARTITION BY id_item ORDER BY fecha_ultima_modificacion DESC, total_linea_neto DESC, codigo_proveedor DESC) = 1
)"""


def _history(unit: str) -> str:
    """Versions of the buyer snapshots: gaps and islands on the tracked attribute."""
    return f"""
snap AS (
  SELECT o_custkey AS codigo, CAST(date_trunc('{unit}', o_orderdate) AS DATE) AS desde, max(o_orderpriority) AS nombre,
         max(o_orderstatus) AS region, bool_or(o_totalprice > 300000) AS persona
  FROM orders GROUP BY 1, 2
),
marked AS (
  SELECT *, row_number() OVER k = 1 AS first_one,
         row_number() OVER k = 1 OR nombre <> lag(nombre) OVER k AS opens,
         row_number() OVER k = 1 OR region <> lag(region) OVER k AS moved
  FROM snap WINDOW k AS (PARTITION BY codigo ORDER BY desde)
),
islands AS (
  SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY codigo ORDER BY desde) AS version,
         sum(CAST(opens OR moved AS INTEGER)) OVER (PARTITION BY codigo ORDER BY desde) AS episode
  FROM marked
),
carried AS (
  SELECT *, first_value(persona) OVER (PARTITION BY codigo, episode ORDER BY desde) AS held FROM islands
),
closing AS (
  SELECT codigo, version - 1 AS version, desde AS next_start, region AS next_region,
         CASE WHEN moved THEN persona ELSE before END AS next_persona
  FROM (SELECT *, lag(held) OVER (PARTITION BY codigo ORDER BY desde) AS before FROM carried)
  WHERE opens
),
versions AS (
  SELECT codigo, version, min(desde) AS start, any_value(nombre) AS nombre, arg_max(region, desde) AS last_region,
         arg_max(held, desde) AS last_persona
  FROM carried GROUP BY codigo, version
)"""


HISTORY = """
SELECT v.codigo, nombre, CASE WHEN next_start IS NULL THEN last_region ELSE next_region END AS region,
       CASE WHEN next_start IS NULL THEN last_persona ELSE next_persona END AS persona,
       strftime(start, '%Y-%m-%d') AS vigente_desde,
       CASE WHEN next_start IS NULL THEN '9999-12-31' ELSE strftime(next_start - INTERVAL 1 DAY, '%Y-%m-%d') END AS vigente_hasta,
       next_start IS NULL AS es_vigente
FROM versions v LEFT JOIN closing c ON c.codigo = v.codigo AND c.version = v.version"""

LOG = """
log AS (
  SELECT event_id AS chequeo_id, ts AS ejecutado_en, event_type AS chequeo, strftime(ts, '%Y-%m') AS mes,
         CASE WHEN event_type = 'error' THEN 'falla' ELSE 'ok' END AS estado, CAST(value AS DECIMAL(20,2)) AS valor,
         props AS detalle
  FROM events
)"""
STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"

LISTING = """
months AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS mes FROM orders UNION SELECT strftime(l_shipdate, '%Y-%m') FROM lineitem
),
listing AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS mes, count(*) AS n,
         TIMESTAMP '2024-02-01 00:00:00' - to_minutes(CAST(count(*) % 80 * 31 AS INTEGER)) AS modificado
  FROM orders GROUP BY 1
)"""

CHECKS = STAGE + "," + LISTING + """,
items AS (SELECT mes, count(*) AS n FROM stage GROUP BY mes),
pending AS (SELECT mes, count(*) AS n FROM headers WHERE tipo = 'P' GROUP BY mes),
fresh AS (
  SELECT m.mes, date_diff('second', modificado, TIMESTAMP '2024-02-01 00:00:00') / 3600.0 AS horas
  FROM months m LEFT JOIN listing l ON l.mes = m.mes
),
volume AS (
  SELECT m.mes, coalesce(i.n, 0) AS n, CAST(CAST(l.n * 3.3 AS DECIMAL(20,2)) AS DOUBLE) AS prev
  FROM months m LEFT JOIN items i ON i.mes = m.mes LEFT JOIN listing l ON l.mes = m.mes
),
checks AS (
  SELECT 'frescura_raw' AS chequeo, mes, CASE WHEN horas <= 36 THEN 'ok' ELSE 'falla' END AS estado,
         CAST(CAST(round_even(horas, 1) AS DECIMAL(20,2)) AS DOUBLE) AS valor, '<= 36 h' AS esperado,
         CASE WHEN horas IS NULL THEN 'No existe archivo del mes ' || mes
              ELSE 'Archivo cargado hace ' || format('{:.1f}', round_even(horas, 1)) || ' h' END AS detalle
  FROM fresh
  UNION ALL
  SELECT 'volumen_items', mes, CASE WHEN n = 0 OR n < prev * 0.9 THEN 'falla' ELSE 'ok' END, CAST(n AS DOUBLE),
         CASE WHEN n = 0 THEN '> 0' WHEN n < prev * 0.9 THEN '>= ' || CAST(CAST(round_even(prev * CAST(0.9 AS DOUBLE), 0) AS BIGINT) AS VARCHAR)
              ELSE 'sin caída > 10%' END,
         CASE WHEN n = 0 THEN 'El mes no tiene ítems en la bodega'
              WHEN n < prev * 0.9 THEN 'Antes ' || CAST(CAST(round_even(prev, 0) AS BIGINT) AS VARCHAR) || ' ítems, ahora ' || CAST(n AS VARCHAR)
              ELSE CAST(n AS VARCHAR) || ' ítems' END
  FROM volume
  UNION ALL
  SELECT 'items_sin_ordenes', m.mes, CASE WHEN i.n > 0 AND p.n IS NULL THEN 'falla' ELSE 'ok' END,
         CAST(coalesce(p.n, 0) AS DOUBLE), '> 0 si hay ítems',
         CAST(coalesce(p.n, 0) AS VARCHAR) || ' órdenes y ' || CAST(coalesce(i.n, 0) AS VARCHAR) || ' ítems'
  FROM months m LEFT JOIN items i ON i.mes = m.mes LEFT JOIN pending p ON p.mes = m.mes
)"""


def _check(name: str) -> str:
    return _with(CHECKS, f"SELECT * FROM checks WHERE chequeo = '{name}'")


# Positions are rebuilt field by field instead of being parsed from text.
FIELDS = """
vehicles AS (
  SELECT event_id, user_id, ts, strftime(ts, '%d-%m-%Y %H:%M:%S') AS text_ts, date_trunc('second', ts) AS gps,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS poll, CAST(user_id AS VARCHAR) AS patente,
         CAST('-33.' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') AS DOUBLE) AS latitud,
         CAST('-70.' || lpad(CAST(event_id % 7919 AS VARCHAR), 4, '0') AS DOUBLE) AS longitud,
         CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS velocidad, CAST(event_id % 8 AS VARCHAR) AS direccion,
         CAST(event_id % 6 AS VARCHAR) AS operador, event_type AS servicio,
         CASE WHEN event_id % 2 = 0 THEN 'I' ELSE 'R' END AS sentido, event_type || ' 00' AS ruta_consola,
         '' AS ruta_sinoptico, event_id % 30 AS kind
  FROM events
),
good AS (SELECT * FROM vehicles WHERE kind NOT IN (3, 7, 17)),
fresh_positions AS (
  SELECT strftime(gps, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS fecha_gps, patente, latitud, longitud, velocidad, direccion,
         operador, servicio, sentido, ruta_consola, ruta_sinoptico, text_ts AS fecha_insercion,
         strftime(poll, '%Y%m%d%H%M%S') AS consulta, gps
  FROM good WHERE gps >= poll - INTERVAL 5 MINUTE
),
state AS (
  SELECT strftime(gps, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS fecha_gps, *
  FROM good
  QUALIFY row_number() OVER (PARTITION BY patente ORDER BY gps DESC, latitud DESC, longitud DESC, velocidad DESC, servicio DESC) = 1
)"""

DECO = """
deco AS (
  SELECT p_brand AS codigo_usuario, 'M' || CAST(p_size AS VARCHAR) AS codigo_mtt,
         CAST(p_partkey AS VARCHAR) || CASE p_partkey % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'R' ELSE 'X' END AS codigo_ruta,
         p_name AS servicio_deco, p_type AS tipo_servicio, p_type || ' SA' AS cli_dsc
  FROM part
),
loads AS (
  SELECT '2024-01-01 00:00:00.000000' AS loaded, * FROM deco WHERE codigo_mtt < 'M25'
  UNION ALL SELECT '2024-02-01 00:00:00.000000', * FROM deco WHERE codigo_mtt >= 'M2'
),
services AS (
  SELECT codigo_usuario, codigo_mtt, servicio_deco, tipo_servicio, cli_dsc AS unidad, loaded AS actualizado_en FROM loads
  QUALIFY row_number() OVER (PARTITION BY codigo_usuario ORDER BY loaded DESC, codigo_ruta) = 1
),
routes AS (
  SELECT codigo_ruta, codigo_usuario, CASE WHEN regexp_matches(codigo_ruta, '[IR]$') THEN right(codigo_ruta, 1) END AS sentido,
         max(loaded) AS actualizado_en
  FROM loads GROUP BY 1, 2
)"""

ITEM_COLUMNS = """id_item, codigo, mes, CAST(strftime(fecha_envio, '%Y%m%d') AS INTEGER) AS fecha_envio_id, codigo_producto_onu,
       producto_generico, rubro_n1, rubro_n2, rubro_n3, CAST(cantidad AS DOUBLE) AS cantidad, unidad_medida,
       'CLP' AS moneda_item, CAST(precio_neto AS DOUBLE) AS precio_neto, CAST(total_linea_neto AS DOUBLE) AS total_linea_neto,
       codigo_organismo, codigo_proveedor"""

LAYER = "SELECT mes, count(*) AS items, count(DISTINCT codigo) AS ordenes FROM {0} GROUP BY mes"


def _zero_rules(rules: list[tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{label}' AS prueba, CAST(({count}) AS BIGINT) AS infracciones" for label, count in rules)


def _repeated(table: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)"


def _several(column: str) -> str:
    return f"SELECT count(*) FROM (SELECT codigo FROM stage GROUP BY codigo HAVING count(DISTINCT {column}) > 1)"


SUITE = [
    ("item duplicado", _repeated("stage", "id_item")),
    ("orden duplicada", _repeated("oc", "codigo")),
    ("organismo duplicado", _repeated("nation", "n_nationkey")),
    ("unidad duplicada", _repeated("customer", "c_custkey")),
    ("proveedor con dos vigentes", _repeated("supplier", "s_suppkey")),
    ("sk de organismo repetida", _repeated("nation", "n_nationkey")),
    ("sk de unidad repetida", _repeated("customer", "c_custkey")),
    ("sk de proveedor repetida", _repeated("supplier", "s_suppkey")),
    ("item sin organismo", "SELECT count(*) FROM stage WHERE codigo_organismo IS NULL"),
    ("item sin proveedor", "SELECT count(*) FROM stage WHERE codigo_proveedor IS NULL"),
    ("orden sin organismo", "SELECT count(*) FROM oc WHERE codigo_organismo IS NULL"),
    ("orden sin unidad", "SELECT count(*) FROM oc WHERE codigo_unidad IS NULL"),
    ("orden sin proveedor", "SELECT count(*) FROM oc WHERE codigo_proveedor IS NULL"),
    ("item fuera del calendario", "SELECT count(*) FROM stage WHERE year(fecha_envio) NOT BETWEEN 1990 AND 2030"),
    ("envío fuera del calendario", "SELECT count(*) FROM oc WHERE year(fecha_envio) NOT BETWEEN 1990 AND 2030"),
    ("creación fuera del calendario", "SELECT count(*) FROM oc WHERE year(fecha_creacion) NOT BETWEEN 1990 AND 2030"),
    ("vigencia invertida", "SELECT count(*) FROM supplier WHERE DATE '1990-01-01' > DATE '9999-12-31'"),
    ("proveedor sin código", "SELECT count(*) FROM supplier WHERE s_suppkey IS NULL"),
    ("item sin clave", "SELECT count(*) FROM stage WHERE id_item IS NULL OR codigo IS NULL OR mes IS NULL"),
    ("item con texto largo", "SELECT count(*) FROM stage WHERE length(codigo) > 40 OR length(producto_generico) > 300"),
    ("orden sin clave", "SELECT count(*) FROM oc WHERE codigo IS NULL OR mes IS NULL"),
    ("orden con texto largo", "SELECT count(*) FROM oc WHERE length(codigo) > 40 OR length(tipo) > 10"),
    ("orden en varios meses", _several("mes")),
    ("orden con varios organismos", _several("codigo_organismo")),
    ("orden con varias unidades", _several("codigo_unidad")),
    ("orden con varios proveedores", _several("codigo_proveedor")),
]

RAW_RULES = [
    ("item duplicado", _repeated("lines_all", "id_item")),
    ("item sin proveedor", "SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_suppkey NOT IN "
                           "(SELECT s_suppkey FROM supplier WHERE s_nationkey < 20)"),
    ("item con texto largo", "SELECT count(*) FROM lines_all WHERE length(codigo) > 7"),
    ("monto alto", "SELECT count(*) FROM lineitem WHERE l_extendedprice > 90000"),
]

ORACLE: dict[str, str] = {
    "spend_concentration": _with(SUMMARY, "SELECT * FROM summary WHERE mes = (SELECT max(mes) FROM headers)"),
    "spend_concentration_all_months": _with(SUMMARY, "SELECT * FROM summary"),
    "spend_concentration_star": _with(SUMMARY, "SELECT * FROM summary"),
    "entity_documents": _with(SUMMARY, EXPLODED),
    "publish_documents": _with(SUMMARY, EXPLODED),
    "warehouse_months": _with(SUMMARY, EXPLODED),
    "warehouse_increment": _with(SUMMARY, EXPLODED),
    "hhi_by_entity": _with(SUMMARY, "SELECT mes, codigo_organismo, proveedores, hhi FROM summary WHERE posicion = 1"),
    "flagged_spend_share": _with(SUMMARY, """
        SELECT mes, codigo_organismo, CAST(directo AS DOUBLE) AS monto_trato_directo_clp, CAST(agil AS DOUBLE) AS monto_compra_agil_clp,
               round(100 * CAST(directo AS DOUBLE) / CAST(total AS DOUBLE), 2) AS pct_monto_trato_directo,
               round(100 * CAST(agil AS DOUBLE) / CAST(total AS DOUBLE), 2) AS pct_monto_compra_agil
        FROM shared WHERE posicion = 1"""),
    "concentration_alerts": _with(ALERTED, EXPLODED.replace("FROM summary", "FROM summary JOIN ranked USING (mes, codigo_organismo)") + " WHERE posicion = 1"),
    "entity_summary_latest": _with(SUMMARY, EXPLODED + " WHERE mes = (SELECT max(mes) FROM summary)"),
    "dedupe_latest_item": _with(LINES, """
        SELECT id_item, codigo, codigo_proveedor, strftime(fecha_ultima_modificacion, '%Y-%m-%d') AS fecha_ultima_modificacion,
               CAST(cantidad AS DOUBLE) AS cantidad, CAST(total_linea_neto AS DOUBLE) AS total_linea_neto FROM lines"""),
    "typed_items_roundtrip": _with(RAW, """
        SELECT id_item, codigo, 'Orden ' || codigo || '; "' || rubro_n2 || '"' || chr(10) || rubro_n1 AS nombre, tipo,
               es_trato_directo, es_compra_agil, codigo_estado, strftime(fecha_envio, '%Y-%m-%d') AS fecha_envio,
               CAST(NULL AS VARCHAR) AS fecha_aceptacion,
               strftime(fecha_ultima_modificacion, '%Y-%m-%d') AS fecha_ultima_modificacion,
               CAST(NULL AS DOUBLE) AS total_neto_oc, CAST(19 AS DOUBLE) AS porcentaje_iva, codigo_organismo,
               region_unidad, codigo_proveedor, 'Ñuñoa ' || nombre_proveedor AS nombre_proveedor, rut_proveedor,
               CAST(NULL AS VARCHAR) AS codigo_licitacion, CAST(cantidad AS DOUBLE) AS cantidad,
               CAST(precio_neto AS DOUBLE) AS precio_neto, CAST(total_linea_neto AS DOUBLE) AS total_linea_neto, mes
        FROM raw_rows
        QUALIFY row_number() OVER (PARTITION BY id_item, mes ORDER BY fecha_ultima_modificacion DESC, total_linea_neto DESC,
                                   codigo_proveedor DESC) = 1"""),
    "typed_orders_nested": _with(RAW, """
        SELECT codigo, 'Orden ñ ' || rubro_n2 AS nombre, codigo_estado, CAST(NULL AS VARCHAR) AS codigo_licitacion, tipo,
               'CLP' AS moneda, strftime(fecha_creacion, '%Y-%m-%d') || ' 00:00:00.000000' AS fecha_creacion,
               CAST(NULL AS VARCHAR) AS fecha_envio,
               strftime(fecha_ultima_modificacion, '%Y-%m-%d') || ' 10:30:00.500000' AS fecha_ultima_modificacion,
               CAST(total_linea_neto AS DOUBLE) AS total_neto, CAST(19 AS DOUBLE) AS porcentaje_iva,
               CAST(total_linea_neto AS DOUBLE) AS total, codigo_organismo, nombre_organismo, codigo_unidad, region_unidad,
               codigo_proveedor, nombre_proveedor, rut_proveedor, CAST(NULL AS VARCHAR) AS region_proveedor,
               CAST(cantidad AS INTEGER) AS cantidad_items
        FROM raw_rows
        QUALIFY row_number() OVER (PARTITION BY codigo ORDER BY fecha_ultima_modificacion DESC, total_linea_neto DESC,
                                   codigo_proveedor DESC, rubro_n2 DESC) = 1"""),
    "masked_items_job": _with(RAW, f"""
        SELECT mes, id_item, CASE WHEN es_persona_natural THEN 'PERSONA NATURAL' ELSE 'Ñuñoa ' || nombre_proveedor END AS nombre_proveedor,
               CASE WHEN es_persona_natural THEN {TOKEN} ELSE rut_proveedor END AS rut_proveedor, es_persona_natural
        FROM raw_rows
        QUALIFY row_number() OVER (PARTITION BY id_item, mes ORDER BY fecha_ultima_modificacion DESC, total_linea_neto DESC,
                                   codigo_proveedor DESC) = 1"""),
    "person_dictionary_job": _with(RAW, f"""
        SELECT DISTINCT mes, {TOKEN} AS token_proveedor, rut_proveedor, 'Ñuñoa ' || nombre_proveedor AS nombre_proveedor
        FROM (SELECT * FROM raw_rows
              QUALIFY row_number() OVER (PARTITION BY id_item, mes ORDER BY fecha_ultima_modificacion DESC, total_linea_neto DESC,
                                         codigo_proveedor DESC) = 1)
        WHERE es_persona_natural"""),
    "comma_decimal_parse": """
        SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN '   ' WHEN 1 THEN '1.' || t WHEN 2 THEN '  ' || t || ' ' ELSE t END AS texto,
               CASE WHEN c_custkey % 7 < 2 THEN NULL ELSE c_acctbal END AS monto
        FROM (SELECT c_custkey, c_acctbal, replace(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS t FROM customer)""",
    "natural_person_flag": """
        SELECT s_suppkey,
               CASE WHEN s_suppkey % 5 = 0 THEN regexp_replace(CAST(n AS VARCHAR), '(\\d+)(\\d{3})(\\d{3})$', '\\1.\\2.\\3') || '-' || dv
                    WHEN s_suppkey % 5 = 1 THEN CAST(n AS VARCHAR) WHEN s_suppkey % 10 = 2 THEN 'sin rut'
                    WHEN s_suppkey % 10 = 7 THEN NULL ELSE CAST(n AS VARCHAR) || '-' || dv END AS rut,
               CASE WHEN s_suppkey % 10 IN (2, 7) THEN NULL ELSE n < 50000000 END AS es_persona_natural
        FROM (SELECT s_suppkey, 1000000 + (s_suppkey * 7919003) % 98000000 AS n,
                     CASE WHEN s_suppkey % 11 = 10 THEN 'K' ELSE CAST(s_suppkey % 11 AS VARCHAR) END AS dv FROM supplier)""",
    "pseudonymised_items": _with(RAW, f"""
        SELECT id_item, strftime(fecha_ultima_modificacion, '%Y-%m-%d') AS fecha_ultima_modificacion,
               CAST(total_linea_neto AS DOUBLE) AS total_linea_neto,
               CASE WHEN es_persona_natural THEN 'PERSONA NATURAL' ELSE nombre_proveedor END AS nombre_proveedor,
               CASE WHEN es_persona_natural THEN {TOKEN} ELSE rut_proveedor END AS rut_proveedor, es_persona_natural
        FROM raw_rows"""),
    "pseudonym_dictionary": _with(RAW, f"""
        SELECT DISTINCT {TOKEN} AS token_proveedor, rut_proveedor, nombre_proveedor FROM raw_rows WHERE es_persona_natural"""),
    "calendar_dim": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS fecha_id, strftime(d, '%Y-%m-%d') AS fecha, CAST(year(d) AS INTEGER) AS anio,
               CAST(quarter(d) AS INTEGER) AS trimestre, CAST(month(d) AS INTEGER) AS mes, strftime(d, '%Y-%m') AS anio_mes,
               CAST(day(d) AS INTEGER) AS dia, CAST(isodow(d) AS INTEGER) AS dia_semana, isodow(d) >= 6 AS es_fin_semana
        FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)), CAST(last_day(max(o_orderdate)) AS TIMESTAMP),
                                            INTERVAL 1 DAY)) AS d FROM orders)""",
    "scd1_entity": _with(UNITS, """
        SELECT codigo_organismo, coalesce(b.nombre, a.nombre) AS nombre_organismo, coalesce(b.sector, a.sector) AS sector,
               CASE WHEN a.k IS NULL OR b.nombre <> a.nombre OR b.sector <> a.sector THEN '2024-02-01 00:00:00.000000'
                    ELSE '2024-01-01 00:00:00.000000' END AS actualizado_en
        FROM (SELECT codigo_organismo, 1 AS k, max(nombre_organismo) AS nombre, max(sector) AS sector FROM loads WHERE NOT second GROUP BY 1) a
        FULL JOIN (SELECT codigo_organismo, max(nombre_organismo) AS nombre, max(sector) AS sector FROM loads WHERE second GROUP BY 1) b
        USING (codigo_organismo)"""),
    "scd1_unit": _with(UNITS + """,
        a AS (SELECT codigo_unidad, max(nombre_unidad) AS n, max(rut_unidad) AS t, max(region_unidad) AS r, max(codigo_organismo) AS o
              FROM loads WHERE NOT second GROUP BY 1),
        b AS (SELECT codigo_unidad, max(nombre_unidad) AS n, max(rut_unidad) AS t, max(region_unidad) AS r, max(codigo_organismo) AS o
              FROM loads WHERE second GROUP BY 1),
        j AS (SELECT codigo_unidad, a, b, coalesce(a.n IS NULL OR (b.n IS NOT NULL AND (a.n <> b.n OR a.r <> b.r)), FALSE) AS w
              FROM a FULL JOIN b USING (codigo_unidad))""", """
        SELECT codigo_unidad, CASE WHEN w THEN b.n ELSE a.n END AS nombre_unidad, CASE WHEN w THEN b.t ELSE a.t END AS rut_unidad,
               CASE WHEN w THEN b.r ELSE a.r END AS region_unidad, CASE WHEN w THEN b.o ELSE a.o END AS codigo_organismo,
               CASE WHEN w THEN '2024-02-01 00:00:00.000000' ELSE '2024-01-01 00:00:00.000000' END AS actualizado_en
        FROM j"""),
    "scd2_supplier": _with(_history("year"), HISTORY),
    "scd2_history": _with(_history("month"), HISTORY),
    "fact_items": _with(STAGE, f"SELECT {ITEM_COLUMNS} FROM stage"),
    "fact_orders": _with(ORDERS, """
        SELECT codigo, mes, CAST(strftime(fecha_creacion, '%Y%m%d') AS INTEGER) AS fecha_creacion_id,
               CAST(strftime(fecha_envio, '%Y%m%d') AS INTEGER) AS fecha_envio_id, tipo, es_trato_directo, es_compra_agil,
               codigo_estado, CAST(NULL AS VARCHAR) AS codigo_licitacion, 'CLP' AS moneda_oc, CAST(monto AS DOUBLE) AS monto_total_oc,
               CAST(monto AS DOUBLE) AS monto_total_oc_clp, CAST(monto AS DOUBLE) AS total_neto_oc,
               CAST(cantidad_items AS INTEGER) AS cantidad_items, codigo_organismo, codigo_unidad, codigo_proveedor
        FROM oc"""),
    "month_replace": _with(STAGE, """
        SELECT id_item, codigo, mes, CAST(total_linea_neto AS DOUBLE) AS total_linea_neto FROM stage
        WHERE mes < (SELECT max(mes) FROM stage)"""),
    "register_catalog_table": _with(STAGE, "SELECT mes, count(*) AS items FROM stage GROUP BY mes"),
    "items_per_month": _with(STAGE, "SELECT mes, count(*) AS items FROM stage GROUP BY mes"),
    "latest_check_status": _with(LOG, f"""
        SELECT chequeo, mes, estado, detalle, {STAMP.format('ejecutado_en')} AS ejecutado_en FROM log
        QUALIFY row_number() OVER (PARTITION BY chequeo, mes ORDER BY ejecutado_en DESC, chequeo_id DESC) = 1"""),
    "volume_over_time": _with(LOG, f"""
        SELECT {STAMP.format('ejecutado_en')} AS time, CAST(valor AS DOUBLE) AS items, mes AS metric FROM log WHERE chequeo = 'view'"""),
    "alert_feed": _with(LOG, f"""
        SELECT {STAMP.format('ejecutado_en')} AS creada_en, chequeo, chequeo || ' ' || mes || ': ' || detalle AS mensaje,
               '(sin explicación)' AS explicacion
        FROM log WHERE estado = 'falla' ORDER BY log.ejecutado_en DESC, chequeo_id DESC LIMIT 20"""),
    "alerts_total": _with(LOG, "SELECT count(*) AS alertas FROM log WHERE estado = 'falla'"),
    "failed_checks_24h": _with(LOG, """
        SELECT count(*) AS fallas FROM log
        WHERE estado = 'falla' AND ejecutado_en > (SELECT max(ejecutado_en) FROM log) - INTERVAL 24 HOUR"""),
    "check_volume": _check("volumen_items"),
    "check_items_without_orders": _check("items_sin_ordenes"),
    "check_freshness": _check("frescura_raw"),
    "run_checks": _with(CHECKS, "SELECT *, '2024-02-01 00:00:00.000000' AS ejecutado_en FROM checks"),
    "check_alerts": _with(CHECKS, """
        SELECT '2024-02-01 00:00:00.000000' AS creada_en, chequeo || ' ' || mes || ': ' || detalle AS mensaje,
               CAST(NULL AS VARCHAR) AS explicacion FROM checks WHERE estado = 'falla'"""),
    "reconcile_layers": _with(ORDERS, """
        SELECT mes, CAST(sum(cantidad_items) AS BIGINT) AS items_origen, count(*) AS ordenes_origen, CAST(sum(monto) AS DOUBLE) AS monto_clp_origen,
               CAST(sum(cantidad_items) AS BIGINT) AS items_destino, count(*) AS ordenes_destino,
               CAST(sum(monto) AS DOUBLE) AS monto_clp_destino, TRUE AS coincide
        FROM oc GROUP BY mes"""),
    "reconcile_raw_layer": _with(LINES + """,
        per AS (
          SELECT strftime(o_orderdate, '%Y-%m') AS mes, codigo, count(*) AS n, max(total_linea_neto) AS m
          FROM lines_all JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
        clean AS (
          SELECT strftime(o_orderdate, '%Y-%m') AS mes, codigo, count(*) AS n, max(total_linea_neto) AS m
          FROM lines JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
        a AS (SELECT mes, CAST(sum(n) AS BIGINT) AS i, count(*) AS o, sum(m) AS v FROM per GROUP BY mes),
        b AS (SELECT mes, CAST(sum(n) AS BIGINT) AS i, count(*) AS o, sum(m) AS v FROM clean GROUP BY mes)""", """
        SELECT mes, a.i AS items_origen, a.o AS ordenes_origen, CAST(a.v AS DOUBLE) AS monto_clp_origen, b.i AS items_destino,
               b.o AS ordenes_destino, CAST(b.v AS DOUBLE) AS monto_clp_destino, a.i = b.i AND a.o = b.o AND a.v = b.v AS coincide
        FROM a JOIN b USING (mes)"""),
    "integrity_suite": _with(ORDERS, _zero_rules(SUITE)),
    "integrity_raw_layer": _with(LINES, _zero_rules(RAW_RULES)),
    "in_processing_window": """
        SELECT strftime(o_orderdate, '%Y-%m') AS mes, o_orderkey AS l_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS fecha_envio
        FROM orders WHERE o_orderdate >= TIMESTAMP '1998-02-01' AND o_orderdate < TIMESTAMP '1998-04-01'""",
    "partition_coverage": _with(LISTING, """
        SELECT m.mes, l.n IS NOT NULL AS presente, coalesce(modificado - INTERVAL 3 HOUR >= TIMESTAMP '2024-01-31', FALSE) AS al_dia,
               FALSE AS listo
        FROM months m LEFT JOIN listing l ON l.mes = m.mes"""),
    "changed_files": _with(LISTING, f"""
        SELECT mes, 'compras/mes=' || mes || '/archivo.csv' AS ruta, {STAMP.format('modificado')} AS modificado, CAST(n AS VARCHAR) AS huella
        FROM listing WHERE CAST(right(mes, 2) AS INTEGER) % 3 <> 2"""),
    "parse_positions": _with(FIELDS, f"SELECT * REPLACE ({STAMP.format('gps')} AS gps) FROM fresh_positions"),
    "parse_report": _with(FIELDS, """
        SELECT CASE WHEN kind = 3 THEN 'corto' WHEN kind = 17 THEN 'fecha inválida' WHEN gps < poll - INTERVAL 5 MINUTE THEN 'antiguo'
                    WHEN kind = 7 THEN 'número inválido' ELSE 'activo' END AS resultado, count(*) AS registros
        FROM vehicles GROUP BY 1"""),
    "active_vehicles": _with(FIELDS, """
        SELECT strftime(poll, '%Y%m%d%H%M%S') AS consulta, count(*) AS buses_respuesta,
               count(CASE WHEN kind NOT IN (3, 7, 17) AND gps >= poll - INTERVAL 5 MINUTE THEN 1 END) AS buses_activos
        FROM vehicles GROUP BY 1"""),
    "keyed_publish": _with(FIELDS, """
        SELECT patente AS key, '{"fecha_gps":"' || fecha_gps || '","patente":"' || patente || '","latitud":' || CAST(latitud AS VARCHAR)
               || ',"longitud":' || CAST(longitud AS VARCHAR) || ',"velocidad":' || CAST(velocidad AS VARCHAR) || ',"direccion":"'
               || direccion || '","operador":"' || operador || '","servicio":"' || servicio || '","sentido":"' || sentido
               || '","ruta_consola":"' || ruta_consola || '","ruta_sinoptico":"","fecha_insercion":"' || fecha_insercion
               || '","consulta":"' || consulta || '"}' AS value
        FROM fresh_positions"""),
    "active_by_service": _with(FIELDS, """
        SELECT servicio, (SELECT count(*) FROM state WHERE servicio = 'error' AND sentido = 'I') AS buses_activos, patente, latitud,
               longitud, velocidad, sentido, ruta_sinoptico, fecha_gps
        FROM state WHERE servicio = 'error' AND sentido = 'I' ORDER BY fecha_gps DESC, patente LIMIT 25"""),
    "active_by_every_service": _with(FIELDS, """
        SELECT servicio, count(*) OVER (PARTITION BY servicio) AS buses_activos,
               patente, latitud, longitud, velocidad, sentido, ruta_sinoptico, fecha_gps
        FROM state"""),
    "speed_class": """
        SELECT event_id, CASE WHEN event_id % 9 = 0 OR value = 0 THEN 'detenido' WHEN value < 20 THEN 'menos de 20 km/h' ELSE '20 km/h o más' END AS clase
        FROM events""",
    "stream_latest_state": f"""
        SELECT event_id, {STAMP.format('ts')} AS ts, user_id, event_type, value, props FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1""",
    "stream_latest_updates": f"""
        SELECT event_id, {STAMP.format('ts')} AS ts, user_id, event_type, value, props FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1""",
    "stream_archive": """
        SELECT strftime(ts, '%Y-%m-%d') AS fecha, strftime(ts, '%H') AS hora, count(*) AS registros, min(event_id) AS desde,
               max(event_id) AS hasta
        FROM events GROUP BY 1, 2""",
    "parameterised_sql": _with(ORDERS, """
        SELECT mes, codigo_organismo, count(*) AS ordenes, CAST(sum(monto) AS DOUBLE) AS monto_clp FROM oc
        WHERE monto > 0 AND mes >= '1992-01' GROUP BY mes, codigo_organismo"""),
    "service_dim": _with(DECO, "SELECT * FROM services"),
    "route_dim": _with(DECO, "SELECT * FROM routes"),
    "dictionary_summary": _with(DECO, """
        SELECT 'servicios' AS concepto, count(*) AS total FROM services
        UNION ALL SELECT 'recorridos', count(*) FROM routes
        UNION ALL SELECT 'sin sentido', count(*) FROM routes WHERE sentido IS NULL"""),
}

ORACLE["stream_restart_state"] = ORACLE["stream_latest_state"]
ORACLE["typed_items_mixed_headers"] = ORACLE["typed_items_roundtrip"]
ORACLE["stream_both_outputs"] = """
    WITH last AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    vig AS (SELECT strftime(ts, '%Y-%m-%d') AS fecha, strftime(ts, '%H') AS hora, count(*) AS vigentes FROM last GROUP BY 1, 2)
    SELECT strftime(ts, '%Y-%m-%d') AS fecha, strftime(ts, '%H') AS hora, count(*) AS registros, any_value(coalesce(vigentes, 0)) AS vigentes
    FROM events LEFT JOIN vig ON fecha = strftime(ts, '%Y-%m-%d') AND hora = strftime(ts, '%H') GROUP BY 1, 2"""
ORACLE["position_pipeline"] = _with(FIELDS, """
    SELECT patente, fecha_gps, latitud, longitud, velocidad, servicio, count(*) OVER (PARTITION BY patente) AS registros
    FROM fresh_positions QUALIFY row_number() OVER (PARTITION BY patente ORDER BY gps DESC, latitud DESC, longitud DESC, velocidad DESC, servicio DESC) = 1""")

ORACLE["orders_job_table"] = "SELECT codigo, codigo_organismo, codigo_proveedor, total, '2024-01-31' AS fecha FROM (" + ORACLE["typed_orders_nested"] + ")"
ORACLE["stream_retries"] = """
    SELECT user_id, count(*) AS registros, arg_max(event_id, struct_pack(ts, event_id)) AS vigente FROM events GROUP BY user_id"""
ORACLE["history_compacted"] = """
    SELECT strftime(ts, '%Y-%m-%d') AS fecha, '00' AS hora, count(*) AS registros, min(event_id) AS desde, max(event_id) AS hasta, 1 AS archivos
    FROM events GROUP BY 1"""

ORACLE["stream_state_ttl"] = """
    WITH gaps AS (SELECT *, coalesce(ts >= lag(ts) OVER w + INTERVAL 4 DAY, true) AS starts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    runs AS (SELECT *, sum(CAST(starts AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM gaps),
    spans AS (SELECT user_id, run, count(*) AS registros, arg_max(event_id, struct_pack(ts, event_id)) AS ultimo,
                     max(ts) + INTERVAL 4 DAY <= (SELECT max(ts) FROM events) AS vencido FROM runs GROUP BY 1, 2)
    SELECT user_id, count(*) FILTER (vencido) AS vencimientos, arg_max(ultimo, run) AS ultimo, NOT arg_max(vencido, run) AS vigente,
           arg_max(registros, run) AS registros
    FROM spans GROUP BY user_id"""

ORACLE["changed_real_files"] = """
    SELECT strftime(o_orderdate, '%Y-%m') AS mes, count(*) AS lineas FROM orders WHERE month(o_orderdate) % 3 <> 0 GROUP BY 1"""
ORACLE["dictionary_file"] = _with(DECO, "SELECT * FROM deco")
ORACLE["minimised_items"] = _with(RAW, """
    SELECT id_item, codigo, CAST(cantidad AS DOUBLE) AS cantidad, CAST(total_linea_neto AS DOUBLE) AS total_linea_neto, sector FROM raw_rows""")

# Both runs see the star of all months; the second finds the first one's volumes, which are its own.
def _star_checks(at: str) -> str:
    block = ORDERS + CHECKS.removeprefix(STAGE)
    for old, new in (("FROM headers WHERE tipo = 'P' GROUP BY mes", "FROM oc GROUP BY mes"), ("CAST(CAST(l.n * 3.3 AS DECIMAL(20,2)) AS DOUBLE) AS prev", "CAST(NULL AS DOUBLE) AS prev"),
                     ("modificado, TIMESTAMP '2024-02-01 00:00:00')", f"modificado, TIMESTAMP '{at}')")):
        block = block.replace(old, new)
    return _with(block, f"SELECT *, '{at}.000000' AS ejecutado_en FROM checks")


ORACLE["monitoring_log"] = "\nUNION ALL\n".join(f"SELECT * FROM ({_star_checks(at)})" for at in ("2024-02-01 00:00:00", "2024-02-01 01:00:00"))
