"""Registered report queries."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from faultline import config as C
from faultline.operators import stats, reports, splits
from faultline.plans import derived as D
from faultline.plans import sqlparts as S
from faultline.plans.q_forecast import holdout
from faultline.plans.registry import query

W = "WITH "
MONTHS = list(C.MONTH_NAMES_ES.values())
MONTH_CASE = "CASE " + " ".join(f"WHEN month(Fecha) = {k} THEN '{v}'" for k, v in C.MONTH_NAMES_ES.items()) + " END"

CROSSTAB = S.LINES + f""",
tk AS (SELECT trim(Nodo) AS Nodo, {MONTH_CASE} AS Mes FROM lines WHERE Fecha IS NOT NULL AND Nodo IS NOT NULL),
ct AS (SELECT Nodo, {", ".join(f"count(*) FILTER (WHERE Mes = '{m}') AS {m}" for m in MONTHS)}
       FROM tk WHERE Mes IS NOT NULL GROUP BY Nodo),
proj AS (SELECT *, CAST(round_even(CAST(Abril AS DOUBLE) / 12.0 * 30.0, 0) AS BIGINT) AS Proyeccion FROM ct),
proj2 AS (SELECT *, Febrero + Marzo + Proyeccion AS Total_Proyectado FROM proj),
heat AS (SELECT * FROM proj2 WHERE Total_Proyectado > 20 ORDER BY Total_Proyectado DESC, Nodo LIMIT 15)"""


def crosstab(t):
    return t.memo("crosstab", lambda: reports.node_month_crosstab(D.line_daily(t), "Fecha", count_col="n"))


@query("node_month_crosstab", W + CROSSTAB + " SELECT * FROM ct")
def node_month_crosstab(t):
    """Node x month (Enero..Mayo) ticket counts."""
    return crosstab(t)


@query("heat_map", W + CROSSTAB + " SELECT * FROM heat")
def heat_map(t):
    """M16 + K2: run-rate projection of the current month, total, top 15 above 20."""
    return reports.heat_map(reports.run_rate_projection(crosstab(t)))


@query("risk_comparison", W + CROSSTAB + """
SELECT substring(Nodo, 1, 15) AS Nodo_Corto, Abril AS Real, Proyeccion AS Proyectado
FROM heat ORDER BY Total_Proyectado DESC, Nodo LIMIT 10""")
def risk_comparison(t):
    """K3: top-10 real vs projected, labels cut to 15."""
    return reports.risk_comparison(reports.heat_map(reports.run_rate_projection(crosstab(t))))


@query("ticket_audit", W + S.CLEAN_TICKETS + """
SELECT count(*) AS Tickets, avg(Minutos_Resolucion) AS Media_Minutos, min(Minutos_Resolucion) AS Min_Minutos,
  max(Minutos_Resolucion) AS Max_Minutos, avg(Minutos_Resolucion) / 60.0 AS Media_Horas FROM clean""")
def ticket_audit(t):
    """D13 (tickets)."""
    return reports.ticket_audit(D.tickets_clean(t))


@query("demand_audit", W + S.LINES + """,
daily AS (SELECT Fecha, count(*) AS Total_Tickets FROM lines GROUP BY Fecha)
SELECT count(*) AS Dias, max(Total_Tickets) AS Pico, min(Total_Tickets) AS Valle, avg(Total_Tickets) AS Media FROM daily""")
def demand_audit(t):
    """D13 (demand): days, peak, valley, mean of daily totals."""
    daily = D.line_daily(t).groupBy("Fecha").agg(F.sum("n").alias("Total_Tickets"))
    return reports.demand_audit(daily)


@query("sla_label_balance", W + S.SLA + """
SELECT count(*) FILTER (WHERE Target = 0) AS Cumple, count(*) FILTER (WHERE Target = 1) AS No_Cumple,
  CASE WHEN count(*) FILTER (WHERE Target = 1) > 0
       THEN count(*) FILTER (WHERE Target = 0) / count(*) FILTER (WHERE Target = 1) ELSE 1.0 END AS Peso_Clase
FROM sla""")
def sla_label_balance(t):
    """Label balance and class weight."""
    return reports.label_balance(D.sla(t))


RAW_COLS = list(C.JIRA_COLUMNS_MAP)


@query("null_inventory", W + S.RAW_TICKETS + ",\nr AS (SELECT " + ", ".join(
    f'{c} AS "{k}"' for k, c in zip(RAW_COLS, ["Resumen", "Prioridad", "Fecha_Creacion", "Fecha_Solucion", "Nodo",
                                                "Usuarios_Afectados", "Zona"])) + " FROM raw)\n" + " UNION ALL ".join(
    f"SELECT {i + 1} AS Posicion, '{k}' AS Columna, avg(CASE WHEN \"{k}\" IS NULL THEN 1.0 ELSE 0.0 END) * 100.0 AS Porcentaje_Nulos FROM r"
    for i, k in enumerate(RAW_COLS)))
def null_inventory(t):
    """NULL % per column of the raw export."""
    return reports.null_inventory(D.tickets_raw(t))


@query("distinct_audit", W + S.RAW_TICKETS + ",\nr AS (SELECT Prioridad, Nodo, Zona FROM raw)\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS Columna, count(DISTINCT {s}) AS Distintos, min({s}) AS Minimo, max({s}) AS Maximo FROM r"
    for c, s in [("Prioridad", "Prioridad"), ("Campo personalizado (Nodo Afectado)", "Nodo"),
                 ("Nombre del proyecto", "Zona")]))
def distinct_audit(t):
    """Distinct-value audit of candidate columns."""
    return reports.distinct_audit(D.tickets_raw(t), ["Prioridad", "Campo personalizado (Nodo Afectado)",
                                                      "Nombre del proyecto"])


HOLD = W + S.PANEL + """,
hold AS (SELECT max(Fecha) - 29 AS cutoff FROM panel),
zd AS (SELECT Zona, Fecha, sum(Tickets_Total) AS Tickets_Total FROM panel GROUP BY Zona, Fecha)"""


def cutoff(t):
    return D.bounds(t)[1] - dt.timedelta(days=29)


@query("weekday_profile", HOLD + """
SELECT Zona, CAST(isodow(Fecha) - 1 AS INTEGER) AS Dia_Semana, avg(Tickets_Total) AS Media,
  max(Tickets_Total) AS Maximo, min(Tickets_Total) AS Minimo
FROM zd WHERE Fecha >= (SELECT cutoff FROM hold) GROUP BY ALL""")
def weekday_profile(t):
    """Weekday mean/max/min of each zone's daily demand in the test period."""
    return reports.weekday_profile(D.panel(t), cutoff(t))


@query("train_test_means", HOLD + """
SELECT Zona, avg(CASE WHEN Fecha < (SELECT cutoff FROM hold) THEN Tickets_Total END) AS Media_Train,
  avg(CASE WHEN Fecha >= (SELECT cutoff FROM hold) THEN Tickets_Total END) AS Media_Test FROM zd GROUP BY Zona""")
def train_test_means(t):
    """Mean daily zone demand, train vs test."""
    return reports.train_test_means(D.panel(t), cutoff(t))


@query("series_variation", W + S.PANEL + """
SELECT Zona, Nodo, avg(Tickets_Total) AS Media, stddev_samp(Tickets_Total) AS Desv,
  CASE WHEN avg(Tickets_Total) > 0 THEN stddev_samp(Tickets_Total) / avg(Tickets_Total) ELSE 0.0 END AS CV
FROM panel GROUP BY Zona, Nodo""")
def series_variation(t):
    """Coefficient of variation per series."""
    return reports.variation(D.panel(t))


@query("series_autocorrelation", W + S.PANEL + """
SELECT Zona, Nodo, corr(y, l1) AS Autocorr_Lag1, corr(y, l7) AS Autocorr_Lag7 FROM (
  SELECT Zona, Nodo, CAST(Tickets_Total AS DOUBLE) AS y,
    CAST(lag(Tickets_Total, 1) OVER (PARTITION BY Zona, Nodo ORDER BY Fecha) AS DOUBLE) AS l1,
    CAST(lag(Tickets_Total, 7) OVER (PARTITION BY Zona, Nodo ORDER BY Fecha) AS DOUBLE) AS l7 FROM panel) GROUP BY Zona, Nodo""")
def series_autocorrelation(t):
    """Lag-1 / lag-7 autocorrelation per series."""
    return reports.autocorrelation(D.panel(t))


@query("zone_shares", W + S.PANEL + """
SELECT Zona, sum(Tickets_Total) AS Total, sum(Tickets_Total) / sum(sum(Tickets_Total)) OVER () * 100.0 AS Participacion
FROM panel GROUP BY Zona""")
def zone_shares(t):
    """Zone totals and share."""
    return reports.zone_shares(D.panel(t))


@query("day_totals", HOLD + """
SELECT Zona, sum(Tickets_Total) AS Tickets, 'real' AS Fuente, sum(sum(Tickets_Total)) OVER () AS Total_Nacional
FROM panel WHERE Fecha = (SELECT cutoff FROM hold) GROUP BY Zona""")
def day_totals(t):
    """One day's per-zone totals (actuals: the day is in the panel) and national total."""
    return reports.day_totals(D.panel(t), holdout(t)[1], cutoff(t))


@query("peak_days", HOLD + """,
pk AS (SELECT Zona, Fecha, Tickets_Total AS Total_Zona FROM zd WHERE Fecha >= (SELECT cutoff FROM hold) AND Tickets_Total > 10)
SELECT pk.Zona, pk.Fecha, pk.Total_Zona, p.Nodo, p.Tickets_Total FROM pk JOIN panel p ON p.Zona = pk.Zona AND p.Fecha = pk.Fecha""")
def peak_days(t):
    """Test-period zone-days above 10 tickets (threshold set for the proxy's
    volume), drilled down to their nodes."""
    return reports.peak_days(D.panel(t), cutoff(t), threshold=10)


@query("display_labels", W + S.PANEL + """,
zd AS (SELECT Zona, Fecha, sum(Tickets_Total) AS Tickets_Total FROM panel GROUP BY Zona, Fecha)
SELECT Zona, Fecha, Tickets_Total,
  ['""" + "', '".join(C.WEEKDAY_SHORT_ES) + """'][isodow(Fecha)] AS Dia_Nombre,
  """ + MONTH_CASE + """ AS Mes_Nombre, strftime(Fecha, '%d-%b') AS Etiqueta, substring(Zona, 1, 15) AS Nombre_Corto
FROM zd""")
def display_labels(t):
    """P24 on zone-days."""
    zd = reports.zone_daily_totals(D.panel(t))
    return reports.display_labels(zd, name_col="Zona")


@query("sla_risk_tiers", W + S.SLA + """,
base AS (SELECT avg(Target) AS b FROM sla),
g AS (SELECT Prioridad, CENTRAL, (sum(Target) + 10.0 * any_value(base.b)) / (count(*) + 10.0) * 100.0 AS Riesgo_Pct
      FROM sla CROSS JOIN base GROUP BY Prioridad, CENTRAL)
SELECT *, CASE WHEN Riesgo_Pct > 70 THEN 'ROJA' WHEN Riesgo_Pct > 50 THEN 'AMARILLA' ELSE 'NOMINAL' END AS Nivel FROM g""")
def sla_risk_tiers(t):
    """P21 on the smoothed empirical breach rate per (priority, central)."""
    return reports.sla_risk_scores(D.sla(t))


RAW_BY_ID = S.TICKETS + f""",
raw AS (SELECT event_id, Resumen, Prioridad, {S.sql_jira_text('Fecha_Creacion')} AS Fecha_Creacion,
  {S.sql_jira_text('Fecha_Solucion')} AS Fecha_Solucion, Nodo, Usuarios_Afectados, Zona FROM tk)"""


def cells(src: str, extra: str = "") -> str:
    """SQL: one row (Campo, Valor) per cell of ``src``."""
    return " UNION ALL ".join(f"SELECT {extra}'{raw}' AS Campo, CAST({name} AS VARCHAR) AS Valor FROM {src}"
                              for raw, name in C.JIRA_COLUMNS_MAP.items())


@query("ticket_sample", W + RAW_BY_ID + """,
pick AS (SELECT *, CAST(row_number() OVER (ORDER BY h) AS INTEGER) AS Muestra
         FROM (SELECT *, md5(event_id || '|42') AS h FROM raw ORDER BY h LIMIT 2) a),
c AS (""" + cells("pick", "Muestra, ") + """)
SELECT Muestra, Campo, CASE WHEN length(Valor) > 150 THEN substr(Valor, 1, 150) || '...' ELSE Valor END AS Valor
FROM c WHERE Valor IS NOT NULL AND trim(Valor) <> '' AND lower(Valor) <> 'nan'""")
def ticket_sample(t):
    """K6: two hash-picked raw tickets, non-empty cells only."""
    return reports.sample_rows(D.tickets_raw_with_id(t), ["event_id"])


@query("dataset_probe", W + RAW_BY_ID + f""",
f AS (SELECT * FROM raw ORDER BY event_id LIMIT 1)
SELECT 'filas' AS Campo, CAST(count(*) AS VARCHAR) AS Valor FROM raw UNION ALL SELECT 'columnas', '{len(C.JIRA_COLUMNS_MAP)}'
UNION ALL """ + cells("f"))
def dataset_probe(t):
    """K7: row/column counts and the first ticket, by its id."""
    return reports.dataset_probe(D.tickets_raw_with_id(t), "event_id")


ZD = W + S.PANEL + """,
zd AS (SELECT Zona, Fecha, sum(Tickets_Total) AS Tickets_Total FROM panel GROUP BY Zona, Fecha)"""


@query("zone_windows", ZD + """,
sc AS (SELECT Zona, Fecha, Tickets_Total,
  CASE WHEN max(Tickets_Total) OVER z > min(Tickets_Total) OVER z
       THEN (Tickets_Total - min(Tickets_Total) OVER z) / (max(Tickets_Total) OVER z - min(Tickets_Total) OVER z)
       ELSE 0.0 END AS Escalado
  FROM zd WINDOW z AS (PARTITION BY Zona)),
lg AS (SELECT Zona, Fecha, Escalado, """ + ", ".join(
    f"lag(Escalado, {k}) OVER (PARTITION BY Zona ORDER BY Fecha) AS x{k}" for k in range(1, 8)) + """ FROM sc)
SELECT * FROM lg WHERE x7 IS NOT NULL""")
def zone_windows(t):
    """W7 + W6: per-zone min-max scaling (max = min guarded) and the previous 7
    scaled values as inputs; rows without a full week are dropped."""
    from faultline.operators.series import scaled_windows
    zd = reports.zone_daily_totals(D.panel(t))
    sw = scaled_windows(zd)
    return sw.select("Zona", "Fecha", "Escalado", *[F.element_at("Ventana", 8 - k).alias(f"x{k}")
                                                    for k in range(1, 8)])


@query("zone_chrono_split", ZD + """,
s AS (SELECT *, row_number() OVER (PARTITION BY Zona ORDER BY Fecha) AS rn, count(*) OVER (PARTITION BY Zona) AS cnt FROM zd)
SELECT Zona, Fecha, Tickets_Total,
  CASE WHEN rn - 1 - 7 < floor((cnt - 7) * 0.85) THEN 'train' ELSE 'test' END AS Particion
FROM s WHERE cnt >= 15 AND rn > 7""")
def zone_chrono_split(t):
    """Chronological 85/15 split per zone."""
    return splits.chrono_split(reports.zone_daily_totals(D.panel(t)))


@query("walk_forward_splits", W + S.PANEL + """,
pdates AS (SELECT Fecha, row_number() OVER (ORDER BY Fecha) - 1 AS idx FROM (SELECT DISTINCT Fecha FROM panel)),
prm AS (SELECT n, CASE WHEN n < 60 + 3 * 14 THEN 1 ELSE 3 END AS ns FROM (SELECT count(*) AS n FROM pdates)),
prm2 AS (SELECT n, ns, greatest(1, (n - 60 - 14) // ns) AS step FROM prm),
sp AS (SELECT CAST(i + 1 AS INTEGER) AS Split, 60 + i * step AS tr, 61 + i * step AS ts,
              least(61 + i * step + 13, n - 1) AS te FROM (SELECT *, unnest(range(0, ns)) AS i FROM prm2))
SELECT sp.Split, (SELECT min(Fecha) FROM pdates) AS Inicio, a.Fecha AS Corte_Train, b.Fecha AS Inicio_Test, c.Fecha AS Fin_Test
FROM sp JOIN pdates a ON a.idx = sp.tr JOIN pdates b ON b.idx = sp.ts JOIN pdates c ON c.idx = sp.te""")
def walk_forward_splits(t):
    """Walk-forward split bounds over the panel's dates."""
    return splits.walk_forward_splits(D.panel(t), 3, 14)


@query("sample_time_folds", W + S.PANEL + """,
d AS (SELECT count(DISTINCT Fecha) AS n, min(Fecha) AS lo FROM panel),
f AS (SELECT p.*, CASE WHEN (p.Fecha - d.lo) < d.n - 5 * (d.n // 6) THEN 0
       ELSE CAST(floor(((p.Fecha - d.lo) - (d.n - 5 * (d.n // 6))) / (d.n // 6)) + 1 AS INTEGER) END AS fold
      FROM panel p CROSS JOIN d)
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS Filas, min(Fecha) AS Desde, max(Fecha) AS Hasta FROM f GROUP BY fold""")
def sample_time_folds(t):
    """Expanding-window folds by target date (Q8) over the panel: fold sizes and spans."""
    f = splits.time_folds(D.panel(t), 5)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("Filas"), F.min("Fecha").alias("Desde"),
                                 F.max("Fecha").alias("Hasta"))


@query("hashed_fold_sizes", W + S.TICKETS + """,
lab AS (SELECT event_id, CAST(epoch_us(Fecha_Solucion - Fecha_Creacion) / 60e6 > 480 AS INTEGER) AS Target
        FROM tk WHERE Fecha_Solucion IS NOT NULL)
SELECT Target, CAST(('0x' || substr(md5(event_id || '|' || Target || '|42'), 1, 15))::BIGINT % 3 AS INTEGER) AS fold, count(*) AS Filas
FROM lab GROUP BY ALL""")
def hashed_fold_sizes(t):
    """M5: seeded hash folds by the event id, stratified by the SLA label."""
    return splits.hashed_folds(D.sla_with_id(t), ["event_id"], 3, label="Target") \
        .groupBy("Target", "fold").agg(F.count(F.lit(1)).alias("Filas"))


FOLDS_SQL = W + S.TICKETS + """,
lab AS (SELECT event_id, Prioridad, Nodo AS CENTRAL, CAST(epoch_us(Fecha_Solucion - Fecha_Creacion) / 60e6 > 480 AS INTEGER) AS Target
        FROM tk WHERE Fecha_Solucion IS NOT NULL),
folds AS (SELECT *, CAST((row_number() OVER (PARTITION BY Target ORDER BY md5(event_id || '|42'), event_id) - 1) % 3 AS INTEGER) AS fold FROM lab)"""


def labelled_folds(t):
    return t.memo("labelled_folds", lambda: splits.stratified_folds(D.sla_with_id(t), ["event_id"], 3, "Target"))


@query("stratified_folds", FOLDS_SQL + " SELECT event_id, Target, fold FROM folds")
def stratified_folds(t):
    """M5: exactly stratified folds, the fold of every ticket."""
    return labelled_folds(t).select("event_id", "Target", "fold")


def _encoding_sql(c: str) -> str:
    return f"""
p_{c} AS (SELECT {c}, fold, CAST(sum(Target) AS DOUBLE) AS s, count(Target) AS n FROM folds GROUP BY ALL),
r_{c} AS (SELECT p.{c}, p.fold, r.prior, sum(s) OVER w - s AS rs, sum(n) OVER w - n AS rn FROM p_{c} p JOIN prior r ON r.fold = p.fold WINDOW w AS (PARTITION BY p.{c})),
e_{c} AS (SELECT {c}, fold, CASE WHEN rn > 0 THEN prior * (1.0 - 1.0 / (1.0 + exp(-(rn - 20.0) / 10.0))) + rs / rn * (1.0 / (1.0 + exp(-(rn - 20.0) / 10.0))) ELSE prior END AS te FROM r_{c})"""


@query("out_of_fold_encoding", FOLDS_SQL + """,
prior AS (SELECT f.fold, CAST(sum(x.Target) AS DOUBLE) / count(x.Target) AS prior FROM (SELECT DISTINCT fold FROM folds) f JOIN folds x ON x.fold <> f.fold GROUP BY f.fold),"""
       + _encoding_sql("Prioridad") + "," + _encoding_sql("CENTRAL") + """
SELECT f.event_id, f.fold, a.te AS Prioridad_te, b.te AS CENTRAL_te FROM folds f
LEFT JOIN e_Prioridad a ON a.Prioridad IS NOT DISTINCT FROM f.Prioridad AND a.fold = f.fold
LEFT JOIN e_CENTRAL b ON b.CENTRAL IS NOT DISTINCT FROM f.CENTRAL AND b.fold = f.fold""")
def out_of_fold_encoding(t):
    """M3: sigmoid-blended target encodings, each row's without its own fold."""
    return stats.out_of_fold_encoding(labelled_folds(t), ["Prioridad", "CENTRAL"], "Target").select("event_id", "fold", "Prioridad_te", "CENTRAL_te")
