"""Registered forecast and back-test queries (stand-in predictors, exact vs SQL)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from faultline.functions import demand_alert
from faultline.operators import forecast, metrics, samples, splits, stats
from faultline.plans import derived as D
from faultline.plans import sql_forecast as X
from faultline.plans import sqlparts as S
from faultline.plans.q_demand import WEATHER_RAW
from faultline.plans.registry import query

KEYS = ["Zona", "Nodo"]
DAYS = 30
BASE = "WITH RECURSIVE " + S.PANEL + X.HOLDOUT
BASE_WX = BASE + "," + WEATHER_RAW.replace(S.LINES + ",", "")
STATS = "," + X.stats_ctes("", "train", KEYS)


def holdout(t):
    """Last 30 panel days held out; statistics from the training part."""
    def build():
        p = D.panel(t)
        hi = D.bounds(t)[1]  # the dense panel ends on the counts' last date
        cutoff = hi - dt.timedelta(days=DAYS - 1)
        train, test = splits.date_cut(p, cutoff)
        return train, test, stats.seasonal_means(train), stats.dow_factors(train)
    return t.memo("holdout", build)


def fc_v4(t):
    tr, _, se, fa = holdout(t)
    return t.memo("fc_v4", lambda: forecast.forecast_v4(tr, se, fa, DAYS))


def fc_v5d(t):
    tr, _, se, fa = holdout(t)
    return t.memo("fc_v5d", lambda: forecast.forecast_v5_direct(tr, se, fa, DAYS))


def fc_v5i(t):
    tr, _, se, fa = holdout(t)
    return t.memo("fc_v5i", lambda: forecast.forecast_v5_iterative(tr, se, fa, DAYS,
                                                                     weather=D.weather_table(t)))


V4_SQL = STATS + "," + X.origin_ctes("v4", "train", KEYS, 7) + "," + X.grid_ctes("v4", KEYS, DAYS) \
    + "," + X.direct_fc("v4", KEYS, 0.4)
V5D_SQL = "," + X.origin_ctes("v5d", "train", KEYS, 14) + "," + X.grid_ctes("v5d", KEYS, DAYS) \
    + "," + X.direct_fc("v5d", KEYS, 0.35)
V5I_SQL = "," + X.origin_ctes("v5i", "train", KEYS, 14) + "," + X.grid_ctes("v5i", KEYS, DAYS, weather=True) \
    + "," + X.iter_fc("v5i", KEYS)


@query("forecast_v4", BASE + V4_SQL + " SELECT * FROM v4fc")
def forecast_v4(t):
    """M10 + J9 + J7 + W10 + P28: V4 direct forecast, DOW damping 0.4, 0.6/0.4 blend."""
    return fc_v4(t)


@query("forecast_v5_direct", BASE + STATS + V5D_SQL + " SELECT * FROM v5dfc")
def forecast_v5_direct(t):
    """V5 direct (median only), damping 0.35, history >= 14."""
    return fc_v5d(t)


@query("forecast_v5_iterative", BASE_WX + STATS + V5I_SQL + " SELECT * FROM v5ifc")
def forecast_v5_iterative(t):
    """M12 + M13: iterative V5 with adaptive quantile blend (heavy rain from J8,
    payday window, Monday)."""
    return fc_v5i(t)


#: the zone whose nodes are segments of their own in the fallback queries; none of them has
#: so many samples, so each falls back
NODE_ZONE, TOO_MANY = "ASIA", 10**9
V4F_SQL = V4_SQL.replace(X.direct_fc("v4", KEYS, 0.4), X.direct_fc(
    "v4", KEYS, 0.4, base=f"(CASE WHEN Zona = '{NODE_ZONE}' THEN coalesce(sea, 0.0) ELSE ma7 END)"))
V5F_SQL = V5I_SQL.replace(X.iter_fc("v5i", KEYS), X.iter_fc("v5i", KEYS, unserved=f"Zona = '{NODE_ZONE}'"))


@query("forecast_v4_fallback", BASE + V4F_SQL + " SELECT * FROM v4fc")
def forecast_v4_fallback(t):
    """Segments without a model (every node of one zone) take their seasonal mean."""
    tr, _, se, fa = holdout(t)
    return forecast.forecast_v4(tr, se, fa, DAYS, served=samples.served_series(tr, NODE_ZONE, TOO_MANY))


@query("forecast_v5_fallback", BASE_WX + STATS + V5F_SQL + " SELECT * FROM v5ifc")
def forecast_v5_fallback(t):
    """M12 + M13: the same segments in the iterative forecast."""
    tr, _, se, fa = holdout(t)
    return forecast.forecast_v5_iterative(tr, se, fa, DAYS, weather=D.weather_table(t),
                                          served=samples.served_series(tr, NODE_ZONE, TOO_MANY))


@query("forecast_v1_recursive", BASE + "," + X.v1_fc("v1", "train", KEYS, DAYS) + " SELECT * FROM v1fc")
def forecast_v1_recursive(t):
    """v1 recursive forecast from the global last date."""
    tr, _, _, _ = holdout(t)
    return forecast.forecast_v1_recursive(tr, DAYS)


ALL_FC = BASE_WX + STATS + V4_SQL.replace(STATS, "") + V5D_SQL + V5I_SQL + """,
allfc AS (
  SELECT 'V4' AS Modelo, Fecha, Zona, Nodo, Prediccion_Tickets FROM v4fc
  UNION ALL SELECT 'V5_Iter', Fecha, Zona, Nodo, Prediccion_Tickets FROM v5ifc
  UNION ALL SELECT 'V5_Direct', Fecha, Zona, Nodo, Prediccion_Tickets FROM v5dfc),
realz AS (SELECT Zona, Fecha, sum(Tickets_Total) AS Real FROM test GROUP BY ALL),
predz AS (SELECT Modelo, Zona, Fecha, sum(Prediccion_Tickets) AS Pred FROM allfc GROUP BY ALL),
jz AS (SELECT p.Modelo, r.Zona, r.Fecha, CAST(r.Real AS DOUBLE) AS Real, CAST(p.Pred AS DOUBLE) AS Pred
       FROM realz r JOIN predz p ON r.Zona = p.Zona AND r.Fecha = p.Fecha)"""


def all_forecasts(t):
    return (fc_v4(t).withColumn("Modelo", F.lit("V4"))
            .unionByName(fc_v5i(t).select(*forecast.FORECAST_COLUMNS).withColumn("Modelo", F.lit("V5_Iter")))
            .unionByName(fc_v5d(t).withColumn("Modelo", F.lit("V5_Direct"))))


def joined_by_model(t):
    """U4 + J3: zone/day actuals joined to every model's zone/day forecast."""
    _, test, _, _ = holdout(t)
    real = metrics.zone_daily(test, "Tickets_Total", "Real")
    pred = all_forecasts(t).groupBy("Modelo", "Zona", "Fecha").agg(
        F.sum("Prediccion_Tickets").alias("Pred"))
    return real.join(pred, ["Zona", "Fecha"])


@query("holdout_metrics", ALL_FC + """
SELECT Modelo, Zona, avg(abs(Pred - Real)) AS MAE,
  avg(abs(Pred - Real) / CASE WHEN Real <> 0 THEN Real END) * 100.0 AS MAPE,
  sqrt(avg((Pred - Real) * (Pred - Real))) AS RMSE, count(*) AS Dias,
  count(*) FILTER (WHERE Real = 0) AS Dias_Sin_Demanda
FROM jz GROUP BY Modelo, Zona""")
def holdout_metrics(t):
    """D9 + J3 + U4 for V4, V5_Iter and V5_Direct on the held-out month."""
    return metrics.error_metrics(joined_by_model(t), by=("Modelo", "Zona"))


@query("holdout_wape", ALL_FC + """,
wp AS (SELECT Modelo, Zona, sum(abs(Pred - Real)) AS Suma_Errores, sum(Real) AS Suma_Reales,
         avg(abs(Pred - Real)) AS MAE FROM jz GROUP BY Modelo, Zona)
SELECT *, CASE WHEN Suma_Reales > 0 THEN Suma_Errores / Suma_Reales END AS WAPE,
  CASE WHEN Suma_Reales > 0 THEN greatest(0.0, (1.0 - Suma_Errores / Suma_Reales) * 100.0) ELSE 0.0 END AS Precision_Operativa,
  CASE WHEN (CASE WHEN Suma_Reales > 0 THEN greatest(0.0, (1.0 - Suma_Errores / Suma_Reales) * 100.0) ELSE 0.0 END) > 85 THEN 'ALTA'
       WHEN (CASE WHEN Suma_Reales > 0 THEN greatest(0.0, (1.0 - Suma_Errores / Suma_Reales) * 100.0) ELSE 0.0 END) >= 70 THEN 'MEDIA'
       ELSE 'BAJA' END AS Grado
FROM wp""")
def holdout_wape(t):
    """D10 + P23: WAPE, operating precision and grade per model and zone."""
    return metrics.wape_precision(joined_by_model(t), by=("Modelo", "Zona"))


@query("holdout_three_way", ALL_FC + """,
p4 AS (SELECT Zona, Fecha, sum(Prediccion_Tickets) AS V4 FROM v4fc GROUP BY ALL),
p5 AS (SELECT Zona, Fecha, sum(Prediccion_Tickets) AS V5 FROM v5ifc GROUP BY ALL)
SELECT r.Zona, r.Fecha, r.Real, p4.V4, p5.V5 FROM realz r JOIN p4 ON r.Zona = p4.Zona AND r.Fecha = p4.Fecha
JOIN p5 ON r.Zona = p5.Zona AND r.Fecha = p5.Fecha""")
def holdout_three_way(t):
    """Inner 3-way join of actual, V4 and V5 per zone and day."""
    _, test, _, _ = holdout(t)
    return metrics.inner_three(test, fc_v4(t), fc_v5i(t))


@query("holdout_outer", ALL_FC + """,
p4 AS (SELECT Zona, Fecha, sum(Prediccion_Tickets) AS V4 FROM v4fc GROUP BY ALL),
p5 AS (SELECT Zona, Fecha, sum(Prediccion_Tickets) AS V5 FROM v5ifc GROUP BY ALL),
realz2 AS (SELECT Zona, Fecha, sum(Tickets_Total) AS Real FROM panel WHERE Fecha >= (SELECT cutoff - 10 FROM hold) GROUP BY ALL)
SELECT coalesce(r.Zona, p4.Zona, p5.Zona) AS Zona, coalesce(r.Fecha, p4.Fecha, p5.Fecha) AS Fecha,
  coalesce(r.Real, 0) AS Real, coalesce(p4.V4, 0) AS V4, coalesce(p5.V5, 0) AS V5
FROM realz2 r FULL JOIN p4 ON r.Zona = p4.Zona AND r.Fecha = p4.Fecha
FULL JOIN p5 ON coalesce(r.Zona, p4.Zona) = p5.Zona AND coalesce(r.Fecha, p4.Fecha) = p5.Fecha""")
def holdout_outer(t):
    """Full-outer join of the actuals, which begin 10 days before the forecasts, with
    both 30-day forecasts, NULL -> 0."""
    p = D.panel(t)
    lo = D.bounds(t)[1] - dt.timedelta(days=DAYS - 1)
    late = p.filter(F.col("Fecha") >= F.lit(lo - dt.timedelta(days=10)))
    return metrics.outer_three(late, fc_v4(t), fc_v5i(t))


@query("node_real_vs_pred", ALL_FC + """,
nj AS (SELECT t.Fecha, t.Zona, t.Nodo, t.Tickets_Total AS Real, f.Prediccion_Tickets AS Proyeccion
       FROM test t JOIN v4fc f ON t.Fecha = f.Fecha AND t.Zona = f.Zona AND t.Nodo = f.Nodo)
SELECT * FROM nj""")
def node_real_vs_pred(t):
    """Actual vs V4 forecast at node grain on the full key (Q7)."""
    _, test, _, _ = holdout(t)
    return metrics.node_real_vs_pred(test, fc_v4(t))


@query("accumulated_error", ALL_FC + """,
nj AS (SELECT t.Fecha, t.Tickets_Total AS Real, f.Prediccion_Tickets AS Proyeccion
       FROM test t JOIN v4fc f ON t.Fecha = f.Fecha AND t.Zona = f.Zona AND t.Nodo = f.Nodo)
SELECT sum(Real) AS Real_Acumulado, sum(Proyeccion) AS Proyeccion_Acumulada,
  avg(abs(CAST(Proyeccion AS DOUBLE) - Real)) AS MAE,
  avg(abs(CAST(Proyeccion AS DOUBLE) - Real)) / avg(CAST(Real AS DOUBLE)) * 100.0 AS MAE_Pct_Media,
  count(DISTINCT Fecha) AS Dias FROM nj""")
def accumulated_error(t):
    """Accumulated actual vs forecast, MAE and MAE as % of the actual mean."""
    _, test, _, _ = holdout(t)
    return metrics.accumulated(metrics.node_real_vs_pred(test, fc_v4(t)))


@query("forecast_alerts", BASE + V4_SQL + """,
zm AS (SELECT Zona, avg(s) AS media FROM (SELECT Zona, Fecha, sum(Tickets_Total) AS s FROM train GROUP BY ALL) GROUP BY Zona),
zf AS (SELECT Zona, Fecha, sum(Prediccion_Tickets) AS Volumen FROM v4fc GROUP BY ALL)
SELECT f.Zona, f.Fecha, f.Volumen, m.media AS Media_Zona,
  CASE WHEN f.Volumen > m.media * 1.3 THEN 'PICO' WHEN f.Volumen < m.media * 0.7 THEN 'VALLE' ELSE 'NOMINAL' END AS Alerta
FROM zf f JOIN zm m ON f.Zona = m.Zona""")
def forecast_alerts(t):
    """Peak / valley / nominal tier of each zone-day forecast vs the zone's mean daily demand."""
    tr, _, _, _ = holdout(t)
    zm = metrics.zone_daily(tr, "Tickets_Total", "s").groupBy("Zona").agg(F.avg("s").alias("Media_Zona"))
    zf = metrics.zone_daily(fc_v4(t), "Prediccion_Tickets", "Volumen")
    j = zf.join(zm, "Zona")
    return j.select("Zona", "Fecha", "Volumen", "Media_Zona",
                    demand_alert(F.col("Volumen").cast("double"), F.col("Media_Zona")).alias("Alerta"))


@query("history_and_forecast", BASE + V4_SQL + """,
h60 AS (SELECT Fecha, Zona, Nodo, Tickets_Total AS Tickets, 'historico' AS serie
        FROM (SELECT *, row_number() OVER (PARTITION BY Zona, Nodo ORDER BY Fecha DESC) AS rn FROM train) WHERE rn <= 60)
SELECT * FROM h60 UNION ALL SELECT Fecha, Zona, Nodo, Prediccion_Tickets, 'prediccion' FROM v4fc""")
def history_and_forecast(t):
    """W9 + U3: last 60 days of each series stacked with its forecast."""
    from pyspark.sql import Window
    tr, _, _, _ = holdout(t)
    w = Window.partitionBy(*KEYS).orderBy(F.desc("Fecha"))
    h = (tr.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 60")
         .select("Fecha", *KEYS, F.col("Tickets_Total").alias("Tickets"), F.lit("historico").alias("serie")))
    f = fc_v4(t).select("Fecha", *KEYS, F.col("Prediccion_Tickets").alias("Tickets"),
                        F.lit("prediccion").alias("serie"))
    return h.unionByName(f)
