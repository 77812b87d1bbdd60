"""SQL builders for the forecast oracles (stand-in predictors, DuckDB dialect)."""
from __future__ import annotations

from faultline import config as C
from faultline.plans.q_demand import cal_sql


def on(a: str, b: str, keys) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def stats_ctes(p: str, src: str, keys) -> str:
    ks = ", ".join(keys)
    return f"""
{p}seas AS (SELECT {ks}, CAST(isodow(Fecha) - 1 AS INTEGER) AS dow, avg(Tickets_Total) AS seasonal
  FROM {src} GROUP BY ALL),
{p}fac AS (SELECT {ks}, dow, CASE WHEN s_all / c_all > 0 THEN (s / c) / (s_all / c_all) ELSE 1.0 END AS dow_factor
  FROM (SELECT *, sum(s) OVER (PARTITION BY {ks}) AS s_all, sum(c) OVER (PARTITION BY {ks}) AS c_all
        FROM (SELECT {ks}, CAST(isodow(Fecha) - 1 AS INTEGER) AS dow, sum(Tickets_Total) AS s,
                     count(Tickets_Total) AS c FROM {src} GROUP BY ALL) a) b)"""


def origin_ctes(p: str, src: str, keys, min_hist: int) -> str:
    ks = ", ".join(keys)
    w = f"PARTITION BY {ks} ORDER BY Fecha"
    return f"""
{p}of AS (SELECT {ks}, Fecha,
    row_number() OVER (PARTITION BY {ks} ORDER BY Fecha DESC) AS rn,
    count(*) OVER (PARTITION BY {ks}) AS n,
    avg(Tickets_Total) OVER ({w} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7,
    avg(Tickets_Total) OVER ({w} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS ma14,
    list(CAST(Tickets_Total AS DOUBLE)) OVER ({w} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS win
  FROM {src}),
{p}origin AS (SELECT * FROM {p}of WHERE rn = 1 AND n >= {min_hist})"""


def grid_ctes(p: str, keys, days: int, weather: bool = False, sp: str = "") -> str:
    ks = ", ".join(f"g.{k}" for k in keys)
    wx = ""
    if weather:
        wx = f"""
  LEFT JOIN wx e ON e.Zona = g.Zona AND e.Fecha = g.F"""
    heavy = "coalesce(e.es_lluvia_fuerte, 0)" if weather else "0"
    return f"""
{p}grid AS (SELECT o.*, CAST(h AS INTEGER) AS Horizonte, CAST(o.Fecha + CAST(h AS INTEGER) AS DATE) AS F
  FROM {p}origin o, range(1, {days + 1}) r(h)),
{p}g2 AS (SELECT {ks}, g.Horizonte, g.F, g.ma7, g.ma14, g.win,
    coalesce(f.dow_factor, 1.0) AS k, s.seasonal AS sea,
    ({heavy} = 1 OR (day(g.F) BETWEEN 14 AND 16) OR day(g.F) >= 28 OR day(g.F) <= 1 OR isodow(g.F) = 1) AS r
  FROM {p}grid g
  LEFT JOIN {sp}seas s ON {on('s', 'g', keys)} AND s.dow = CAST(isodow(g.F) - 1 AS INTEGER)
  LEFT JOIN {sp}fac f ON {on('f', 'g', keys)} AND f.dow = CAST(isodow(g.F) - 1 AS INTEGER){wx})"""


def direct_fc(p: str, keys, damping: float, label: str | None = None, base: str = "ma7") -> str:
    ks = ", ".join(keys)
    lab = f"'{label}' AS Modelo, " if label else ""
    return f"""
{p}fc AS (SELECT {lab}F AS Fecha, {ks},
    CAST(greatest(0.0, round_even(0.6 * adj + 0.4 * coalesce(sea, adj), 0)) AS BIGINT) AS Prediccion_Tickets
  FROM (SELECT *, {base} * (1.0 + {damping} * (k - 1.0)) AS adj FROM {p}g2) x)"""


def iter_fc(p: str, keys, label: str | None = None, unserved: str = "false", quantiles=("least(m7, m14)", "m7", "greatest(m7, m14)"),
            grid: str | None = None, extra: str = "") -> str:
    q30, q50, q70 = quantiles
    ks = ", ".join(keys)
    kx = ", ".join(f"x.{k}" for k in keys)
    kr = ", ".join(f"r.{k}" for k in keys)
    lab = f"'{label}' AS Modelo, " if label else ""
    own = lambda x, seas: f"CASE WHEN {unserved} THEN {seas} ELSE {x} END"
    sea = "CAST(greatest(0.0, round_even(coalesce(sea, 0.0), 0)) AS BIGINT)"
    rw, nw = C.V5_WEIGHTS_RISKY, C.V5_WEIGHTS_NORMAL
    return f"""
{p}rec AS (
  SELECT {ks}, 0 AS h, win, CAST(NULL AS DATE) AS Fecha, CAST(NULL AS BIGINT) AS p,
         CAST(NULL AS BIGINT) AS q30, CAST(NULL AS BIGINT) AS q50, CAST(NULL AS BIGINT) AS q70
  FROM {p}origin
  UNION ALL
  SELECT {ks}, h, list_slice(list_append(win, {own("fr", "coalesce(sea, 0.0)")}), -14, -1), Fecha,
    {own("CAST(fr AS BIGINT)", sea)}, {own("q30", sea)}, {own("q50", sea)}, {own("q70", sea)}
  FROM (SELECT y.*, greatest(0.0, round_even(0.6 * adj + 0.4 * coalesce(sea, adj), 0)) AS fr
    FROM (SELECT {kx}, x.h, x.win, x.Fecha, x.sea,
        ((CASE WHEN x.r THEN {rw[0]} ELSE {nw[0]} END) * {q30}
         + (CASE WHEN x.r THEN {rw[1]} ELSE {nw[1]} END) * {q50}
         + (CASE WHEN x.r THEN {rw[2]} ELSE {nw[2]} END) * {q70}) * (1.0 + {C.V5_DOW_DAMPING} * (x.k - 1.0)) AS adj,
        CAST(greatest(0.0, round_even({q30}, 0)) AS BIGINT) AS q30,
        CAST(greatest(0.0, round_even({q50}, 0)) AS BIGINT) AS q50,
        CAST(greatest(0.0, round_even({q70}, 0)) AS BIGINT) AS q70
      FROM (SELECT {kr}, s.Horizonte AS h, r.win, s.F AS Fecha, s.k, s.sea, s.r,{extra}
                   list_avg(list_slice(r.win, -7, -1)) AS m7, list_avg(list_slice(r.win, -14, -1)) AS m14
            FROM {p}rec r JOIN {grid or p + "g2"} s ON {on('s', 'r', keys)} AND s.Horizonte = r.h + 1) x) y) z),
{p}fc AS (SELECT {lab}Fecha, {ks}, p AS Prediccion_Tickets, q30 AS Pred_Q30, q50 AS Pred_Q50, q70 AS Pred_Q70
  FROM {p}rec WHERE h > 0)"""


def v1_fc(p: str, src: str, keys, days: int) -> str:
    ks = ", ".join(keys)
    return f"""
{p}last AS (SELECT max(Fecha) AS L FROM {src}),
{p}o AS (SELECT {ks}, list_slice(list(CAST(Tickets_Total AS DOUBLE) ORDER BY Fecha), -14, -1) AS win
  FROM {src} GROUP BY ALL),
{p}rec AS (
  SELECT {ks}, 0 AS h, win, CAST(NULL AS BIGINT) AS p FROM {p}o
  UNION ALL
  SELECT {ks}, h + 1, list_slice(list_append(win, fr), -14, -1), CAST(fr AS BIGINT)
  FROM (SELECT r.*, greatest(0.0, round_even(list_avg(list_slice(r.win, -least(len(r.win), 7), -1)), 0)) AS fr
        FROM {p}rec r WHERE r.h < {days}) x),
{p}fc AS (SELECT CAST(l.L + CAST(h AS INTEGER) AS DATE) AS Fecha, {ks}, p AS Prediccion_Tickets
  FROM {p}rec, {p}last l WHERE h > 0)"""


HOLDOUT = """,
hold AS (SELECT max(Fecha) - 29 AS cutoff FROM panel),
train AS (SELECT * FROM panel WHERE Fecha < (SELECT cutoff FROM hold)),
test AS (SELECT * FROM panel WHERE Fecha >= (SELECT cutoff FROM hold))"""
