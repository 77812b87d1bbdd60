"""Registered walk-forward queries (B5) with split-keyed SQL oracles."""
from __future__ import annotations

from faultline.operators import backtest, metrics
from faultline.plans import derived as D
from faultline.plans import sql_forecast as X
from faultline.plans import sqlparts as S
from faultline.plans.q_demand import WEATHER_RAW
from faultline.plans.registry import query

K = ["Split", "Zona", "Nodo"]
H = 14

WF = "WITH RECURSIVE " + S.PANEL + "," + WEATHER_RAW.replace(S.LINES + ",", "") + """,
pdates AS (SELECT Fecha, row_number() OVER (ORDER BY Fecha) - 1 AS idx FROM (SELECT DISTINCT Fecha FROM panel)),
prm AS (SELECT n, CASE WHEN n < 60 + 3 * 14 THEN 1 ELSE 3 END AS ns FROM (SELECT count(*) AS n FROM pdates)),
prm2 AS (SELECT n, ns, greatest(1, (n - 60 - 14) // ns) AS step FROM prm),
sp AS (SELECT CAST(i + 1 AS INTEGER) AS Split, 60 + i * step AS tr, 61 + i * step AS ts,
              least(61 + i * step + 13, n - 1) AS te FROM (SELECT *, unnest(range(0, ns)) AS i FROM prm2)),
wsp AS (SELECT sp.Split, a.Fecha AS Corte, b.Fecha AS T0, c.Fecha AS T1
        FROM sp JOIN pdates a ON a.idx = sp.tr JOIN pdates b ON b.idx = sp.ts JOIN pdates c ON c.idx = sp.te),
wtrain AS (SELECT s.Split, p.* FROM panel p JOIN wsp s ON p.Fecha <= s.Corte),
wtest AS (SELECT s.Split, p.* FROM panel p JOIN wsp s ON p.Fecha BETWEEN s.T0 AND s.T1),""" \
    + X.stats_ctes("w", "wtrain", K) + "," \
    + X.origin_ctes("w4", "wtrain", K, 7) + "," + X.grid_ctes("w4", K, H, sp="w") + "," + X.direct_fc("w4", K, 0.4) + "," \
    + X.origin_ctes("w5", "wtrain", K, 14) + "," + X.grid_ctes("w5", K, H, weather=True, sp="w") + "," \
    + X.iter_fc("w5", K) + """,
wreal AS (SELECT Split, Zona, Fecha, sum(Tickets_Total) AS Real FROM wtest GROUP BY ALL),
wpred AS (SELECT Split, 'V4' AS Modelo, Zona, Fecha, sum(Prediccion_Tickets) AS Pred FROM w4fc GROUP BY ALL
          UNION ALL SELECT Split, 'V5', Zona, Fecha, sum(Prediccion_Tickets) FROM w5fc GROUP BY ALL),
wm AS (SELECT p.Split, p.Modelo, r.Zona,
         round_even(avg(abs(CAST(Pred AS DOUBLE) - Real)), 2) AS MAE,
         round_even(avg(abs(CAST(Pred AS DOUBLE) - Real) / CASE WHEN Real <> 0 THEN CAST(Real AS DOUBLE) END) * 100.0, 1) AS MAPE,
         round_even(sqrt(avg((CAST(Pred AS DOUBLE) - Real) * (CAST(Pred AS DOUBLE) - Real))), 2) AS RMSE
       FROM wreal r JOIN wpred p ON r.Split = p.Split AND r.Zona = p.Zona AND r.Fecha = p.Fecha
       GROUP BY p.Split, p.Modelo, r.Zona),
wsum AS (SELECT Modelo, Zona, round_even(avg(MAE), 2) AS MAE, round_even(avg(RMSE), 2) AS RMSE FROM wm GROUP BY ALL)"""


def wf_metrics(t):
    return t.memo("wf", lambda: backtest.walk_forward(D.panel(t), D.weather_table(t), 3, H))


@query("walk_forward_metrics", WF + " SELECT Zona, MAE, MAPE, RMSE, Split, Modelo FROM wm")
def walk_forward_metrics(t):
    """W13 + M10 + M12/M13 + J3 + D9 + U4 per split, model and zone."""
    return wf_metrics(t)


@query("walk_forward_summary", WF + " SELECT * FROM wsum")
def walk_forward_summary(t):
    """Mean MAE / RMSE per model and zone over the splits."""
    return metrics.walk_forward_summary(wf_metrics(t))


@query("walk_forward_compare", WF + """
SELECT a.Zona, a.MAE AS MAE_V4, a.RMSE AS RMSE_V4, b.MAE AS MAE_V5, b.RMSE AS RMSE_V5,
  b.MAE - a.MAE AS MAE_diff, b.RMSE - a.RMSE AS RMSE_diff
FROM wsum a JOIN wsum b ON a.Zona = b.Zona AND a.Modelo = 'V4' AND b.Modelo = 'V5'""")
def walk_forward_compare(t):
    """V5 - V4 differences per zone (negative = V5 better)."""
    return metrics.compare_models(metrics.walk_forward_summary(wf_metrics(t)), "V4", "V5")


BC = [("1996-03-01", 14), ("1997-01-15", 30), ("1998-06-01", 7)]
BC_SQL = "WITH " + S.PANEL + """,
cut AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, DATE '{c}', {d})" for i, (c, d) in enumerate(BC)) + """) v(Split, Corte, D)),
btrain AS (SELECT c.Split, p.* FROM panel p JOIN cut c ON p.Fecha < c.Corte),""" \
    + X.stats_ctes("b", "btrain", K) + "," + X.origin_ctes("b4", "btrain", K, 7) + "," + X.grid_ctes("b4", K, 30, sp="b") + "," \
    + X.direct_fc("b4", K, 0.4) + """,
bfc AS (SELECT f.* FROM b4fc f JOIN cut c ON f.Split = c.Split JOIN b4origin o ON o.Split = f.Split AND o.Zona = f.Zona AND o.Nodo = f.Nodo
        WHERE f.Fecha <= o.Fecha + c.D),
bp AS (SELECT Split, Zona, Fecha, sum(Prediccion_Tickets) AS Pred FROM bfc GROUP BY ALL),
br AS (SELECT Zona, Fecha, sum(Tickets_Total) AS Real FROM panel GROUP BY ALL)
SELECT p.Zona, c.Corte, avg(abs(CAST(Pred AS DOUBLE) - Real)) AS MAE,
  avg(abs(CAST(Pred AS DOUBLE) - Real) / CASE WHEN Real <> 0 THEN CAST(Real AS DOUBLE) END) * 100.0 AS MAPE,
  sqrt(avg((CAST(Pred AS DOUBLE) - Real) * (CAST(Pred AS DOUBLE) - Real))) AS RMSE, count(*) AS Dias,
  count(*) FILTER (Real = 0) AS Dias_Sin_Demanda
FROM bp p JOIN br r ON p.Zona = r.Zona AND p.Fecha = r.Fecha JOIN cut c ON c.Split = p.Split GROUP BY p.Zona, c.Corte"""


@query("backcast_errors", BC_SQL)
def backcast_errors(t):
    """B9 (W14 + M10 + J3 + D9): V4 back-casts at three fixed cutoffs in one plan, errors per zone."""
    return backtest.backcasts(D.panel(t), BC)
