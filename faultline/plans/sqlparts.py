"""Shared CTE text for the DuckDB oracles (the proxy adapters, written in SQL)."""
from __future__ import annotations

from faultline import config as C


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_norm(x: str, fold_enye: bool = True) -> str:
    """P16 in SQL: lower, fold accents, trim, then the spelling exceptions in order."""
    src, dst = C.ACCENT_FROM, C.ACCENT_TO
    if fold_enye:
        src, dst = src + "ñ", dst + "n"
    e = f"trim(translate(lower({x}), {sql_str(src)}, {sql_str(dst)}))"
    for needles, repl in C.NODE_SPELLING_EXCEPTIONS:
        cond = " AND ".join(f"strpos({e}, {sql_str(n)}) > 0" for n in needles)
        e = f"(CASE WHEN {cond} THEN {sql_str(repl)} ELSE {e} END)"
    return e


def sql_fold(x: str, fold_enye: bool = True) -> str:
    src, dst = C.ACCENT_FROM, C.ACCENT_TO
    if fold_enye:
        src, dst = src + "ñ", dst + "n"
    return f"trim(translate(lower({x}), {sql_str(src)}, {sql_str(dst)}))"


def allow_values() -> str:
    rows = [f"({sql_str(z.strip())}, {sql_fold(sql_str(n))})"
            for z, nodes in C.VALID_ZONES_NODES.items() for n in nodes]
    return "allow AS (SELECT * FROM (VALUES " + ", ".join(rows) + ") t(zone_key, node))"


def sql_translate_month(x: str) -> str:
    low = f"lower({x})"
    whens = " ".join(f"WHEN strpos({low}, {sql_str(es)}) > 0 THEN replace({low}, {sql_str(es)}, {sql_str(en)})"
                     for es, en in C.MONTHS_ES_TO_EN.items())
    return f"(CASE {whens} ELSE {low} END)"


SQL_TIME_FORMATS = ["%d/%b/%y %I:%M %p", "%d/%b/%y %H:%M", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M",
                    "%Y-%m-%d"]


def sql_parse_time(x: str) -> str:
    t = sql_translate_month(x)
    return "coalesce(" + ", ".join(f"try_strptime({t}, {sql_str(f)})" for f in SQL_TIME_FORMATS) + ")"


MONTHS_ES_LIST = "[" + ", ".join(sql_str(m) for m in C.MONTHS_ES_TO_EN) + "]"


def sql_jira_text(ts: str) -> str:
    return (f"CASE WHEN {ts} IS NOT NULL THEN strftime({ts}, '%d/') || {MONTHS_ES_LIST}[month({ts})] "
            f"|| strftime({ts}, '/%y %-I:%M %p') END")


# typed tickets from events (before cleaning)
TICKETS = """
ev AS (
  SELECT event_id, user_id, ts, event_type, value, props,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sol
  FROM events),
tk AS (
  SELECT event_id, user_id,
    'NOC/' || 'Z' || CAST(user_id % 5 AS VARCHAR) || '/' || event_type AS Resumen,
    CASE WHEN value < 15 THEN 'Baja' WHEN value < 35 THEN 'Media' WHEN value < 70 THEN 'Alta'
         ELSE 'Crítica' END AS Prioridad,
    ts AS Fecha_Creacion, sol AS Fecha_Solucion,
    'N' || CAST(user_id % 20 AS VARCHAR) AS Nodo,
    json_extract_string(props, '$.k') AS Usuarios_Afectados,
    'Z' || CAST(user_id % 5 AS VARCHAR) AS Zona
  FROM ev)"""


def clean_from(src: str, parse: bool) -> str:
    cre = sql_parse_time("Fecha_Creacion") if parse else "Fecha_Creacion"
    sol = sql_parse_time("Fecha_Solucion") if parse else "Fecha_Solucion"
    return f"""
c0 AS (
  SELECT Resumen, Prioridad, CAST({cre} AS TIMESTAMP) AS Fecha_Creacion,
         CAST({sol} AS TIMESTAMP) AS Fecha_Solucion, Nodo, Usuarios_Afectados, Zona
  FROM {src} WHERE Fecha_Solucion IS NOT NULL AND Fecha_Creacion IS NOT NULL),
c1 AS (
  SELECT Resumen, Prioridad, Fecha_Creacion, Fecha_Solucion,
    upper(coalesce(Nodo, 'DESCONOCIDO')) AS Nodo,
    coalesce(try_cast(Usuarios_Afectados AS DOUBLE), 1.0) AS Usuarios_Afectados,
    trim(Zona) AS Zona,
    epoch_us(Fecha_Solucion - Fecha_Creacion) / 60e6 AS Minutos_Resolucion,
    coalesce(substring(upper(trim(string_split(Resumen, '/')[-1])), 1, 30), 'DESCONOCIDO') AS Tipo_Falla,
    CAST(hour(Fecha_Creacion) AS INTEGER) AS Hora_Del_Dia,
    CAST(isodow(Fecha_Creacion) - 1 AS INTEGER) AS Dia_De_La_Semana
  FROM c0 WHERE Fecha_Creacion IS NOT NULL AND Fecha_Solucion IS NOT NULL),
clean AS (
  SELECT Resumen, Prioridad, Fecha_Creacion, Fecha_Solucion, Nodo, Usuarios_Afectados, Zona,
    Minutos_Resolucion, Tipo_Falla, Hora_Del_Dia,
    sin(2 * pi() * Hora_Del_Dia / 24.0) AS Hora_sin, cos(2 * pi() * Hora_Del_Dia / 24.0) AS Hora_cos,
    Dia_De_La_Semana,
    sin(2 * pi() * Dia_De_La_Semana / 7.0) AS Dia_sin, cos(2 * pi() * Dia_De_La_Semana / 7.0) AS Dia_cos
  FROM c1 WHERE Minutos_Resolucion BETWEEN 15 AND 7200)"""


CLEAN_TICKETS = TICKETS + "," + clean_from("tk", parse=False)

RAW_TICKETS = TICKETS + f""",
raw AS (
  SELECT Resumen, Prioridad, {sql_jira_text('Fecha_Creacion')} AS Fecha_Creacion,
         {sql_jira_text('Fecha_Solucion')} AS Fecha_Solucion, Nodo, Usuarios_Afectados, Zona
  FROM tk)"""

CLEAN_FROM_RAW = RAW_TICKETS + "," + clean_from("raw", parse=True)

SLA = TICKETS + """,
sla_raw AS (
  SELECT Prioridad, Nodo AS CENTRAL, 'S' || CAST(user_id % 7 AS VARCHAR) AS SUEPERVISOR,
    CASE WHEN epoch_us(Fecha_Solucion - Fecha_Creacion) / 60e6 > 480 THEN 'NO CUMPLE'
         WHEN Fecha_Solucion IS NOT NULL THEN 'CUMPLE' END AS "CUMPLE/NO CUMPLE"
  FROM tk),
sla AS (
  SELECT *, CAST(upper(trim("CUMPLE/NO CUMPLE")) = 'NO CUMPLE' AS INTEGER) AS Target
  FROM sla_raw WHERE "CUMPLE/NO CUMPLE" IS NOT NULL)"""

# demand tickets and weather from lineitem
LINES = """
places AS (
  SELECT s.s_suppkey, trim(r.r_name) AS Zona, trim(n.n_name) AS Nodo
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
lines AS (
  SELECT CAST(l.l_shipdate AS DATE) AS Fecha, p.Zona, p.Nodo, l.l_quantity, l.l_discount, l.l_tax
  FROM lineitem l JOIN places p ON l.l_suppkey = p.s_suppkey),
counts AS (
  SELECT Fecha, Zona, Nodo, count(*) AS Tickets_Total FROM lines GROUP BY Fecha, Zona, Nodo)"""

PANEL_BODY = f""",
{allow_values()},
valid AS (
  SELECT c.* FROM counts c
  WHERE NOT EXISTS (SELECT 1 FROM allow a WHERE a.zone_key = trim(c.Zona))
     OR EXISTS (SELECT 1 FROM allow a WHERE a.zone_key = trim(c.Zona) AND a.node = {sql_norm('c.Nodo')})
     OR {sql_norm('c.Nodo')} = 'desconocido'),
bounds AS (SELECT min(Fecha) AS lo, max(Fecha) AS hi FROM counts),
dates AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS Fecha FROM bounds),
pairs AS (SELECT DISTINCT Zona, Nodo FROM valid),
dense AS (
  SELECT d.Fecha, p.Zona, p.Nodo, CAST(coalesce(v.Tickets_Total, 0) AS BIGINT) AS Tickets_Total
  FROM pairs p CROSS JOIN dates d
  LEFT JOIN valid v ON v.Fecha = d.Fecha AND v.Zona = p.Zona AND v.Nodo = p.Nodo),
feat AS (
  SELECT Fecha, Zona, Nodo, Tickets_Total,
    CAST(isodow(Fecha) - 1 AS INTEGER) AS Dia_Semana, CAST(month(Fecha) AS INTEGER) AS Mes,
    CAST(lag(Tickets_Total, 1) OVER w AS DOUBLE) AS Lag_1,
    CAST(lag(Tickets_Total, 7) OVER w AS DOUBLE) AS Lag_7,
    CASE WHEN count(Tickets_Total) OVER w7 = 7 THEN avg(Tickets_Total) OVER w7 END AS Media_Movil_7d,
    CASE WHEN count(Tickets_Total) OVER w14 = 14 THEN avg(Tickets_Total) OVER w14 END AS Media_Movil_14d
  FROM dense
  WINDOW w AS (PARTITION BY Zona, Nodo ORDER BY Fecha),
         w7 AS (PARTITION BY Zona, Nodo ORDER BY Fecha ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
         w14 AS (PARTITION BY Zona, Nodo ORDER BY Fecha ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)),
panel AS (
  SELECT * FROM feat
  WHERE Lag_1 IS NOT NULL AND Lag_7 IS NOT NULL AND Media_Movil_7d IS NOT NULL
    AND Media_Movil_14d IS NOT NULL)"""

PANEL = LINES + PANEL_BODY

