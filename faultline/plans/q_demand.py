"""Registered demand-panel, statistics, weather and sample queries."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from faultline.operators import demand, samples, stats, weather
from faultline.plans import derived as D
from faultline.plans import sqlparts as S
from faultline.plans.registry import query
from faultline.session import ensure_checkpoint_dir, landed
from faultline.sources import proxies

W = "WITH "
PANEL = W + S.PANEL


@query("demand_counts", W + S.LINES + " SELECT * FROM counts")
def demand_counts(t):
    """D1 over one row per demand ticket."""
    tk = proxies.demand_tickets(t.lineitem, t.supplier, t.nation, t.region)
    return demand.daily_counts(tk, "Fecha_Creacion")


@query("demand_counts_preagg", W + S.LINES + " SELECT * FROM counts")
def demand_counts_preagg(t):
    """D1 with the per-(supplier, day) pre-aggregation below the supplier join."""
    return D.demand_counts(t)


@query("allowed_pairs", PANEL + " SELECT Zona, Nodo FROM pairs")
def allowed_pairs(t):
    """P17 (+P16) on the distinct (zone, node) pairs."""
    return demand.filter_allowed(D.demand_counts(t)).select("Zona", "Nodo").distinct()


@query("dense_panel", PANEL + " SELECT * FROM feat")
def dense_panel(t):
    """J1 + J2 + W1 + W2 before the warm-up drop: pairs x every date, zeros filled."""
    return demand.demand_panel(D.demand_counts(t), drop_warmup=False)


@query("demand_panel", PANEL + " SELECT * FROM panel")
def demand_panel(t):
    """The full panel (W3: warm-up rows dropped)."""
    return D.panel(t)


@query("daily_totals", W + S.LINES + """
SELECT Fecha AS Dia_Calendario, count(*) AS Total_Tickets FROM lines GROUP BY Fecha""")
def daily_totals(t):
    """Tickets per day, all zones."""
    return (D.line_daily(t).groupBy(F.col("Fecha").alias("Dia_Calendario"))
            .agg(F.sum("n").alias("Total_Tickets")))


@query("zone_daily_rollup", PANEL + """
SELECT Zona, Fecha, sum(Tickets_Total) AS Tickets_Total FROM panel GROUP BY Zona, Fecha""")
def zone_daily_rollup(t):
    """zone/day sum over the panel."""
    from faultline.operators.metrics import zone_daily
    return zone_daily(D.panel(t), "Tickets_Total")


@query("panel_dates", PANEL + " SELECT DISTINCT Fecha FROM panel")
def panel_dates(t):
    """Distinct dates of the panel."""
    return D.panel(t).select("Fecha").distinct()


@query("panel_pairs", PANEL + " SELECT DISTINCT Zona, Nodo FROM panel")
def panel_pairs(t):
    """Distinct (zone, node) pairs of the panel."""
    return D.panel(t).select("Zona", "Nodo").dropDuplicates()


SEAS_SQL = """
SELECT Zona, Nodo, CAST(isodow(Fecha) - 1 AS INTEGER) AS dow, avg(Tickets_Total) AS seasonal
FROM {src} GROUP BY Zona, Nodo, dow"""

FAC_SQL = """
SELECT Zona, Nodo, dow,
  CASE WHEN s_all / c_all > 0 THEN (s / c) / (s_all / c_all) ELSE 1.0 END AS dow_factor
FROM (SELECT *, sum(s) OVER (PARTITION BY Zona, Nodo) AS s_all, sum(c) OVER (PARTITION BY Zona, Nodo) AS c_all
      FROM (SELECT Zona, Nodo, CAST(isodow(Fecha) - 1 AS INTEGER) AS dow, sum(Tickets_Total) AS s,
                   count(Tickets_Total) AS c FROM {src} GROUP BY Zona, Nodo, dow) a) b"""


@query("seasonal_means", PANEL + SEAS_SQL.format(src="panel"))
def seasonal_means(t):
    return stats.seasonal_means(D.panel(t))


@query("dow_factors", PANEL + FAC_SQL.format(src="panel"))
def dow_factors(t):
    return stats.dow_factors(D.panel(t))


@query("target_encoding", PANEL + """,
g AS (SELECT avg(Tickets_Total) AS gm FROM panel)
SELECT Zona, Nodo, (count(Tickets_Total) * avg(Tickets_Total) + 10.0 * any_value(g.gm))
                   / (count(Tickets_Total) + 10.0) AS nodo_target_mean,
       coalesce(stddev_samp(Tickets_Total), 0.0) AS nodo_target_std
FROM panel CROSS JOIN g GROUP BY Zona, Nodo""")
def target_encoding(t):
    return stats.target_encoding(D.panel(t))


CAL_SQL = """
  CAST(CASE WHEN Fecha IN ({hol}) THEN 1 ELSE 0 END AS INTEGER) AS es_festivo,
  CAST(CASE WHEN (day(Fecha) BETWEEN 14 AND 16) OR day(Fecha) >= 28 OR day(Fecha) <= 1 THEN 1 ELSE 0 END AS INTEGER) AS es_quincena,
  CAST((day(Fecha) - 1) // 7 + 1 AS INTEGER) AS semana_del_mes,
  CAST(day(Fecha) AS INTEGER) AS dia_del_mes,
  CAST(CASE WHEN isodow(Fecha) = 1 THEN 1 ELSE 0 END AS INTEGER) AS es_lunes,
  CAST(CASE WHEN isodow(Fecha) = 5 THEN 1 ELSE 0 END AS INTEGER) AS es_viernes,
  CAST(CASE WHEN isodow(Fecha) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS es_finsemana"""


def cal_sql() -> str:
    from faultline import config as C
    hol = ", ".join(f"DATE '{d}'" for d in C.HOLIDAYS_2026)
    return CAL_SQL.format(hol=hol)


@query("calendar_features", PANEL + """
SELECT Fecha, Zona, Nodo, Dia_Semana, Mes, """ + cal_sql() + " FROM panel")
def calendar_features(t):
    """P18 + P19 on every panel row."""
    return stats.add_calendar(D.panel(t).select("Fecha", "Zona", "Nodo", "Dia_Semana", "Mes"))


#: holidays of the proxy's years, a parameter of P18
HOLIDAYS = [f"{y}-{d}" for y in range(1992, 1999) for d in ("01-01", "05-01", "07-20", "12-25")]


@query("calendar_holidays", PANEL + """
SELECT Fecha, Zona, Nodo, es_festivo, Tickets_Total FROM (
  SELECT *, CAST(Fecha IN (""" + ", ".join(f"DATE '{d}'" for d in HOLIDAYS) + """) AS INTEGER) AS es_festivo FROM panel) p WHERE es_festivo = 1""")
def calendar_holidays(t):
    """P18 with a holiday list of the panel's own years: the demand of the holidays."""
    days = stats.add_calendar(D.panel(t), holidays=HOLIDAYS).where("es_festivo = 1")
    return days.select("Fecha", "Zona", "Nodo", "es_festivo", "Tickets_Total")


#: an allow-list that names zones of the proxy, in other case and with accents; zones that it leaves out pass whole
ALLOW = {"EUROPE ": ["Fránce", "RÜSSIA", "germany"], "ASIA": ["Índia"], "AMERICA": ["Cañada", "Brazíl "]}


@query("allowed_demand", W + S.LINES + """,
al AS (SELECT * FROM (VALUES """ + ", ".join(f"({S.sql_str(z.strip())}, {S.sql_fold(S.sql_str(n))})" for z, ns in ALLOW.items() for n in ns) + f""") v(zona, node))
SELECT c.* FROM counts c WHERE trim(c.Zona) NOT IN (SELECT zona FROM al)
  OR EXISTS (SELECT 1 FROM al WHERE zona = trim(c.Zona) AND node = {S.sql_norm('c.Nodo')}) OR {S.sql_norm('c.Nodo')} = 'desconocido'""")
def allowed_demand(t):
    """P16 + P17: demand of listed zones' listed nodes and of all other zones."""
    return demand.filter_allowed(D.demand_counts(t), ALLOW)


WEATHER_RAW = S.LINES + """,
wraw AS (
  SELECT Fecha, Zona, sum(l_quantity) / count(*) * 0.4 AS precipitacion_mm,
    14.0 + sum(l_discount) / count(*) * 100.0 AS temp_max,
    sum(l_tax) / count(*) * 250.0 AS viento_max_kmh,
    CAST(count(*) % 100 AS INTEGER) AS weathercode
  FROM lines GROUP BY Fecha, Zona),
wx AS (
  SELECT Fecha, Zona, precipitacion_mm, temp_max, viento_max_kmh, weathercode,
    CAST(precipitacion_mm > 10 AS INTEGER) AS es_lluvia_fuerte,
    CAST(weathercode IN (95, 96, 99) AS INTEGER) AS es_tormenta,
    CAST(precipitacion_mm > 2 AS INTEGER) AS es_lluvia,
    sum(precipitacion_mm) OVER (PARTITION BY Zona ORDER BY Fecha ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS lluvia_acum_3d
  FROM wraw)"""


@query("weather_features", W + WEATHER_RAW + " SELECT * FROM wx")
def weather_features(t):
    """P20 + W4 over the lineitem-derived weather."""
    return D.weather_table(t)


CLIM_SQL = """
clim AS (
  SELECT Zona, CAST(month(Fecha) AS INTEGER) AS mes, avg(precipitacion_mm) AS c_precip,
    avg(temp_max) AS c_temp, avg(viento_max_kmh) AS c_wind, avg(lluvia_acum_3d) AS c_acum
  FROM wx GROUP BY Zona, mes)"""


@query("weather_climatology", W + WEATHER_RAW + "," + CLIM_SQL + " SELECT * FROM clim")
def weather_climatology(t):
    """Zone x month means."""
    c = weather.climatology(D.weather_table(t))
    return c.select("Zona", F.col("_mes").alias("mes"), "c_precip", "c_temp", "c_wind", "c_acum")


@query("weather_lookup", W + S.PANEL + "," + WEATHER_RAW.replace(S.LINES + ",", "") + "," + CLIM_SQL + """
SELECT p.Fecha, p.Zona, p.Nodo,
  CASE WHEN e.Fecha IS NOT NULL THEN e.precipitacion_mm WHEN c.mes IS NOT NULL THEN c.c_precip ELSE 3.5 END AS precipitacion_mm,
  CASE WHEN e.Fecha IS NOT NULL THEN e.temp_max WHEN c.mes IS NOT NULL THEN c.c_temp ELSE 18.5 END AS temp_max,
  CASE WHEN e.Fecha IS NOT NULL THEN e.viento_max_kmh WHEN c.mes IS NOT NULL THEN c.c_wind ELSE 12.0 END AS viento_max_kmh,
  CAST(CASE WHEN e.Fecha IS NOT NULL THEN e.es_lluvia_fuerte ELSE 0 END AS INTEGER) AS es_lluvia_fuerte,
  CAST(CASE WHEN e.Fecha IS NOT NULL THEN e.es_lluvia ELSE 0 END AS INTEGER) AS es_lluvia,
  CASE WHEN e.Fecha IS NOT NULL THEN e.lluvia_acum_3d WHEN c.mes IS NOT NULL THEN c.c_acum ELSE 10.0 END AS lluvia_acum_3d
FROM dense p
LEFT JOIN wx e ON e.Zona = p.Zona AND e.Fecha = p.Fecha
LEFT JOIN clim c ON c.Zona = p.Zona AND c.mes = month(p.Fecha)""")
def weather_lookup_q(t):
    """J8 for every (pair, date) of the dense panel: exact day, else month mean, else
    fixed fallbacks (days without lines exercise the month fallback)."""
    dense = demand.demand_panel(D.demand_counts(t), drop_warmup=False).select("Fecha", "Zona", "Nodo")
    return weather.lookup_weather(dense, D.weather_table(t))


@query("weather_payload_roundtrip", W + WEATHER_RAW + """
SELECT Fecha, Zona, precipitacion_mm, temp_max, viento_max_kmh, weathercode FROM wraw""")
def weather_payload_roundtrip(t):
    """Land weather as JSON payloads of parallel arrays, parse them back."""
    raw = proxies.weather_from_lines(D.line_daily(t))
    return weather.parse_payload(weather.payloads_from_weather(raw))


@query("weather_coverage", W + WEATHER_RAW + """
SELECT Zona, min(Fecha) AS desde, max(Fecha) AS hasta,
  min(Fecha) <= DATE '1996-01-01' AND max(Fecha) >= DATE '1998-12-31' AS cubre
FROM wx GROUP BY Zona""")
def weather_coverage(t):
    """Per-zone coverage of a requested range (decision Q9)."""
    return weather.coverage(D.weather_table(t), "1996-01-01", "1998-12-31")


SAMPLES_SQL = """,
s AS (SELECT *, row_number() OVER (PARTITION BY Zona, Nodo ORDER BY Fecha) - 1 AS idx FROM panel),
o AS (
  SELECT Zona, Nodo, idx, CAST(Tickets_Total AS DOUBLE) AS Lag_1_origin,
    CAST(coalesce(lag(Tickets_Total, 6) OVER w, first_value(Tickets_Total) OVER w) AS DOUBLE) AS Lag_7_origin,
    avg(Tickets_Total) OVER (PARTITION BY Zona, Nodo ORDER BY Fecha ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS Media_Movil_7d_origin,
    avg(Tickets_Total) OVER (PARTITION BY Zona, Nodo ORDER BY Fecha ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS Media_Movil_14d_origin
  FROM s WINDOW w AS (PARTITION BY Zona, Nodo ORDER BY Fecha)),
samples AS (
  SELECT t.Fecha, t.Zona, t.Nodo, t.Tickets_Total, CAST(isodow(t.Fecha) - 1 AS INTEGER) AS Dia_Semana,
    CAST(month(t.Fecha) AS INTEGER) AS Mes, CAST(t.idx - o.idx AS INTEGER) AS Horizonte,
    o.Lag_1_origin, o.Lag_7_origin, o.Media_Movil_7d_origin, o.Media_Movil_14d_origin
  FROM s t CROSS JOIN range(1, 31) h(k) JOIN o ON t.Zona = o.Zona AND t.Nodo = o.Nodo AND o.idx = t.idx - h.k
  WHERE t.idx >= 14 AND o.idx >= 7)"""


@query("direct_samples", PANEL + SAMPLES_SQL + " SELECT * FROM samples")
def direct_samples(t):
    """W5 + J10 over the whole panel (about 30x its rows)."""
    return samples.direct_samples(D.panel(t))


@query("direct_samples_digest", PANEL + SAMPLES_SQL + """
SELECT Zona, Nodo, Horizonte, count(*) AS n, min(Fecha) AS desde, max(Fecha) AS hasta,
  CAST(sum(Tickets_Total) AS BIGINT) AS tickets, CAST(sum(Dia_Semana) AS BIGINT) AS dias, CAST(sum(Mes) AS BIGINT) AS meses,
  sum(Lag_1_origin) AS lag_1, sum(Lag_7_origin) AS lag_7,
  CAST(sum(CAST(round(Media_Movil_7d_origin * 7) AS BIGINT) * Tickets_Total) AS BIGINT) AS media_7,
  CAST(sum(('0x' || substr(md5(concat_ws('|', Fecha, Tickets_Total, CAST(Lag_1_origin AS BIGINT), CAST(Lag_7_origin AS BIGINT),
    CAST(round(Media_Movil_7d_origin * 7) AS BIGINT), CAST(round(Media_Movil_14d_origin * 360360) AS BIGINT))), 1, 8))::BIGINT) AS BIGINT) AS digest
FROM samples GROUP BY ALL""")
def direct_samples_digest(t):
    """W5 + J10, all samples summed up per series and horizon: counts, date range, sums and an order-free sum of the
    samples' hashes. 7 means of whole numbers times 7 are whole; 360360 is a multiple of every frame length up to 14."""
    def whole(c, k):
        return F.round(F.col(c) * k).cast("long")
    s = samples.direct_samples(D.panel(t))
    line = F.concat_ws("|", "Fecha", "Tickets_Total", F.col("Lag_1_origin").cast("long"), F.col("Lag_7_origin").cast("long"),
                       whole("Media_Movil_7d_origin", 7), whole("Media_Movil_14d_origin", 360360))
    return s.groupBy("Zona", "Nodo", "Horizonte").agg(
        F.count(F.lit(1)).alias("n"), F.min("Fecha").alias("desde"), F.max("Fecha").alias("hasta"), F.sum("Tickets_Total").alias("tickets"),
        F.sum("Dia_Semana").alias("dias"), F.sum("Mes").alias("meses"), F.sum("Lag_1_origin").alias("lag_1"), F.sum("Lag_7_origin").alias("lag_7"),
        F.sum(whole("Media_Movil_7d_origin", 7) * F.col("Tickets_Total")).alias("media_7"),
        F.sum(F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")).alias("digest"))


#: the store of the two queries below: the weather table without its days of rain
STORE = """,
dry AS (SELECT * FROM wx WHERE es_lluvia = 0),
span AS (SELECT DATE '1996-01-01' AS a, DATE '1996-12-31' AS b)"""


@query("weather_missing_intervals", W + WEATHER_RAW + STORE + """,
days AS (SELECT z.Zona, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS Fecha
         FROM (SELECT DISTINCT Zona FROM wx) z, span),
lack AS (SELECT d.* FROM days d WHERE NOT EXISTS (SELECT 1 FROM dry w WHERE w.Zona = d.Zona AND w.Fecha = d.Fecha)),
isle AS (SELECT *, Fecha - CAST(row_number() OVER (PARTITION BY Zona ORDER BY Fecha) AS INTEGER) AS g FROM lack)
SELECT Zona, min(Fecha) AS desde, max(Fecha) AS hasta, CAST(count(*) AS INTEGER) AS dias FROM isle GROUP BY Zona, g""")
def weather_missing_intervals(t):
    """The runs of days of 1996 that a store without its rainy days lacks, per zone."""
    full = D.weather_table(t)
    return weather.missing_intervals(full.where("es_lluvia = 0"), "1996-01-01", "1996-12-31", full.select("Zona").distinct())


@query("weather_store_update", W + WEATHER_RAW + """
SELECT Fecha, Zona, precipitacion_mm, temp_max, viento_max_kmh, weathercode FROM wraw""")
def weather_store_update(t):
    """Land the dry days, find the holes of the whole range, merge only the days in them, read the store."""
    raw = landed(proxies.weather_from_lines(D.line_daily(t)), "weather")
    path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/weather-store-{uuid.uuid4().hex[:12]}"
    dry = raw.where("precipitacion_mm <= 2")
    weather.update_store(dry, path)
    lo, hi = raw.agg(F.min("Fecha"), F.max("Fecha")).first()
    holes = weather.missing_intervals(weather.read_store(raw, path), lo, hi, raw.select("Zona").distinct())
    days = holes.select("Zona", F.explode(F.sequence("desde", "hasta")).alias("Fecha"))
    weather.update_store(raw.join(days, ["Zona", "Fecha"], "left_semi"), path)
    return weather.read_store(raw, path).select("Fecha", "Zona", *weather.MEASURES, "weathercode")


@query("weather_archive_forecast", W + WEATHER_RAW + """,
clim2 AS (SELECT Zona, CAST(month(Fecha) AS INTEGER) AS mes, avg(precipitacion_mm) AS p, avg(temp_max) AS x,
            avg(viento_max_kmh) AS v FROM wraw GROUP BY ALL),
hi AS (SELECT max(Fecha) AS d FROM wraw),
fdays AS (SELECT CAST(d - 5 + CAST(i AS INTEGER) AS DATE) AS Fecha FROM hi, range(0, 21) r(i)),
fc AS (SELECT f.Fecha, c.Zona, c.p AS precipitacion_mm, c.x AS temp_max, c.v AS viento_max_kmh, 0 AS weathercode
       FROM fdays f JOIN clim2 c ON c.mes = month(f.Fecha)),
u AS (SELECT *, 0 AS src FROM wraw UNION ALL SELECT *, 1 FROM fc),
k AS (SELECT *, row_number() OVER (PARTITION BY Zona, Fecha ORDER BY src) AS rn FROM u)
SELECT Fecha, Zona, precipitacion_mm, temp_max, viento_max_kmh, CAST(weathercode AS INTEGER) AS weathercode
FROM k WHERE rn = 1""")
def weather_archive_forecast(t):
    """U1 + W11: archive rows plus a 21-day climatology 'forecast' that overlaps the
    archive's last 5 days; per (zone, day) the archive row wins."""
    import datetime as _dt
    raw = proxies.weather_from_lines(D.line_daily(t))
    hi = raw.agg(F.max("Fecha")).first()[0]
    clim = raw.groupBy("Zona", F.month("Fecha").alias("_m")).agg(
        F.avg("precipitacion_mm").alias("precipitacion_mm"), F.avg("temp_max").alias("temp_max"),
        F.avg("viento_max_kmh").alias("viento_max_kmh"))
    days = raw.sparkSession.range(0, 21).select(
        F.date_add(F.lit(hi - _dt.timedelta(days=5)), F.col("id").cast("int")).alias("Fecha"))
    fc = (days.join(clim, F.month("Fecha") == F.col("_m"))
          .select("Fecha", "Zona", "precipitacion_mm", "temp_max", "viento_max_kmh",
                  F.lit(0).cast("int").alias("weathercode")))
    return weather.union_keep_first(raw, fc)


@query("export_demand_counts", W + S.RAW_TICKETS + f""",
ed AS (SELECT CAST(CAST({S.sql_parse_time('Fecha_Creacion')} AS TIMESTAMP) AS DATE) AS Fecha,
         trim(coalesce(Zona, 'DESCONOCIDO')) AS Zona, coalesce(Nodo, 'DESCONOCIDO') AS Nodo FROM raw)
SELECT Fecha, Zona, Nodo, count(*) AS Tickets_Total FROM ed WHERE Fecha IS NOT NULL GROUP BY ALL""")
def export_demand_counts(t):
    """P14 + P4 + P8 + D1: demand counts straight from the raw export, its date, zone
    and node columns found by name (then by substring)."""
    from faultline.operators import clean
    return demand.daily_counts(clean.demand_tickets_from_export(D.tickets_raw(t)))
