"""Report operators: node x month crosstab (D8), run-rate projection (M16), heat map
(K2/K3), audits (D13, D14, D23, D24), discrepancy analysis (D15-D18), zone shares
(D20), day totals (D22), peak-day drill-down (J11), samples and probes (K6, K7),
display labels (P24), SLA risk scoring (P21)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline import config as C
from faultline.functions import short_label, sla_risk_tier


def month_name(c) -> F.Column:
    """Spanish month names for the months that have one (1..5), else NULL."""
    m = F.month(c)
    e = None
    for k, v in C.MONTH_NAMES_ES.items():
        e = F.when(m == k, F.lit(v)) if e is None else e.when(m == k, F.lit(v))
    return e


def node_month_crosstab(tickets: DataFrame, date_col: str = "Fecha_Creacion",
                        node_col: str = "Nodo", count_col: str | None = None) -> DataFrame:
    """Tickets per (trimmed node, named month); months pivoted in calendar order,
    missing cells 0. Pivot values are given, so no extra job discovers them. Rows are one
    ticket each, or ``count_col`` tickets."""
    n = F.lit(1) if count_col is None else F.col(count_col)
    t = (tickets.dropna(subset=[date_col, node_col])
         .select(F.trim(F.col(node_col).cast("string")).alias("Nodo"), month_name(date_col).alias("Mes"), n.cast("long").alias("_n"))
         .filter(F.col("Mes").isNotNull()))
    names = list(C.MONTH_NAMES_ES.values())
    return t.groupBy("Nodo").pivot("Mes", names).agg(F.sum("_n")).fillna(0, subset=names)


def run_rate_projection(crosstab: DataFrame, current: str = "Abril", full=("Febrero", "Marzo"),
                        elapsed_days: int = C.RUNRATE_ELAPSED_DAYS,
                        month_days: int = C.RUNRATE_MONTH_DAYS) -> DataFrame:
    """Current month / elapsed days x month days (half-even, as int); total =
    full months + projection. Days are parameters (Q16)."""
    proj = F.bround(F.col(current) / F.lit(float(elapsed_days)) * F.lit(float(month_days)), 0).cast("long")
    tot = None
    for m in full:
        tot = F.col(m) if tot is None else tot + F.col(m)
    out = crosstab.withColumn("Proyeccion", proj)
    return out.withColumn("Total_Proyectado", (tot if tot is not None else F.lit(0)) + F.col("Proyeccion"))


def heat_map(projected: DataFrame, min_total: int = C.HEATMAP_MIN_TOTAL,
             top: int = C.HEATMAP_TOP) -> DataFrame:
    """K2: nodes above min_total, worst first (ties by node), top ``top``."""
    return (projected.filter(F.col("Total_Proyectado") > min_total)
            .orderBy(F.desc("Total_Proyectado"), F.asc("Nodo")).limit(top))


def risk_comparison(heat: DataFrame, current: str = "Abril", top: int = 10) -> DataFrame:
    """K3 + P24: top-10 real vs projected with the node label cut to 15 characters."""
    return (heat.orderBy(F.desc("Total_Proyectado"), F.asc("Nodo")).limit(top)
            .select(short_label("Nodo").alias("Nodo_Corto"), F.col(current).alias("Real"),
                    F.col("Proyeccion").alias("Proyectado")))


def ticket_audit(tickets: DataFrame) -> DataFrame:
    """D13 (tickets): count and mean / min / max resolution minutes."""
    m = F.col("Minutos_Resolucion")
    return tickets.agg(F.count(F.lit(1)).alias("Tickets"), F.avg(m).alias("Media_Minutos"),
                       F.min(m).alias("Min_Minutos"), F.max(m).alias("Max_Minutos"),
                       (F.avg(m) / 60.0).alias("Media_Horas"))


def demand_audit(daily: DataFrame, value: str = "Total_Tickets") -> DataFrame:
    """D13 (demand): days, peak, valley and mean of the daily totals."""
    return daily.agg(F.count(F.lit(1)).alias("Dias"), F.max(value).alias("Pico"),
                     F.min(value).alias("Valle"), F.avg(value).alias("Media"))


def label_balance(sla: DataFrame, label: str = "Target") -> DataFrame:
    """Class counts and weight n(0)/n(1) (1 when there is no class 1)."""
    a = sla.agg(F.count_if(F.col(label) == 0).alias("Cumple"),
                F.count_if(F.col(label) == 1).alias("No_Cumple"))
    return a.withColumn("Peso_Clase", F.when(F.col("No_Cumple") > 0,
                                             F.col("Cumple") / F.col("No_Cumple")).otherwise(F.lit(1.0)))


def null_inventory(df: DataFrame) -> DataFrame:
    """NULL percentage per column: one pass, then unpivot (stack)."""
    cols = df.columns
    agg = df.agg(*[(F.avg(F.col(f"`{c}`").isNull().cast("double")) * 100.0).alias(f"c{i}")
                   for i, c in enumerate(cols)])
    pairs = ", ".join(f"{i + 1}, '{c.replace(chr(39), chr(39) * 2)}', c{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (Posicion, Columna, Porcentaje_Nulos)")


def distinct_audit(df: DataFrame, cols) -> DataFrame:
    """Distinct-value count, min and max of candidate columns (no unbounded sets): one
    aggregate over all columns, then unpivot. An empty table gives 0 and NULLs per column."""
    measures = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("string")
        measures += [F.count_distinct(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', n{i}, lo{i}, hi{i}" for i, c in enumerate(cols))
    return df.agg(*measures).selectExpr(f"stack({len(cols)}, {pairs}) AS (Columna, Distintos, Minimo, Maximo)")


def zone_daily_totals(panel: DataFrame) -> DataFrame:
    return panel.groupBy("Zona", "Fecha").agg(F.sum("Tickets_Total").alias("Tickets_Total"))


def weekday_profile(panel: DataFrame, start) -> DataFrame:
    """Per zone and weekday, mean / max / min of the zone's daily demand from
    ``start`` on (the test period)."""
    z = zone_daily_totals(panel.filter(F.col("Fecha") >= F.lit(start).cast("date")))
    return (z.groupBy("Zona", F.weekday("Fecha").alias("Dia_Semana"))
            .agg(F.avg("Tickets_Total").alias("Media"), F.max("Tickets_Total").alias("Maximo"),
                 F.min("Tickets_Total").alias("Minimo")))


def train_test_means(panel: DataFrame, cutoff) -> DataFrame:
    """Mean zone daily demand before vs from the cutoff."""
    z = zone_daily_totals(panel)
    c = F.lit(cutoff).cast("date")
    return z.groupBy("Zona").agg(
        F.avg(F.when(F.col("Fecha") < c, F.col("Tickets_Total"))).alias("Media_Train"),
        F.avg(F.when(F.col("Fecha") >= c, F.col("Tickets_Total"))).alias("Media_Test"))


def variation(panel: DataFrame, y: str = "Tickets_Total") -> DataFrame:
    """Coefficient of variation per series (0 when the mean <= 0)."""
    a = panel.groupBy("Zona", "Nodo").agg(F.avg(y).alias("Media"), F.stddev_samp(y).alias("Desv"))
    return a.withColumn("CV", F.when(F.col("Media") > 0, F.col("Desv") / F.col("Media"))
                        .otherwise(F.lit(0.0)))


def autocorrelation(panel: DataFrame, lags=(1, 7), y: str = "Tickets_Total") -> DataFrame:
    """Pearson correlation of each series with itself shifted by each lag
    (NULL pairs skipped)."""
    w = Window.partitionBy("Zona", "Nodo").orderBy("Fecha")
    p = panel.select("Zona", "Nodo", "Fecha", F.col(y).cast("double").alias("_y"),
                     *[F.lag(y, k).over(w).cast("double").alias(f"_l{k}") for k in lags])
    return p.groupBy("Zona", "Nodo").agg(*[F.corr("_y", f"_l{k}").alias(f"Autocorr_Lag{k}") for k in lags])


def zone_shares(panel: DataFrame) -> DataFrame:
    """Total tickets per zone and its share of all tickets (the window runs over
    one row per zone)."""
    z = panel.groupBy("Zona").agg(F.sum("Tickets_Total").alias("Total"))
    return z.withColumn("Participacion", F.col("Total") / F.sum("Total").over(Window.partitionBy()) * 100.0)


def day_totals(panel: DataFrame, forecast: DataFrame, day) -> DataFrame:
    """Per-zone totals of one day (actuals when the day is already in the panel,
    otherwise the forecast) with the national total."""
    d = F.lit(day).cast("date")
    have = panel.filter(F.col("Fecha") == d).limit(1).count() > 0
    src = (panel.filter(F.col("Fecha") == d).select("Zona", F.col("Tickets_Total").alias("v"))
           if have else forecast.filter(F.col("Fecha") == d).select("Zona", F.col("Prediccion_Tickets").alias("v")))
    z = src.groupBy("Zona").agg(F.sum("v").alias("Tickets"))
    return z.withColumns({"Fuente": F.lit("real" if have else "prediccion"),
                          "Total_Nacional": F.sum("Tickets").over(Window.partitionBy())})


def peak_days(panel: DataFrame, start, threshold: int = C.PEAK_DAY_THRESHOLD) -> DataFrame:
    """Zone-days from ``start`` whose total exceeds the threshold, joined back to
    their node rows."""
    z = zone_daily_totals(panel.filter(F.col("Fecha") >= F.lit(start).cast("date")))
    peaks = z.filter(F.col("Tickets_Total") > threshold).select("Zona", "Fecha",
                                                                F.col("Tickets_Total").alias("Total_Zona"))
    return peaks.join(panel.select("Zona", "Fecha", "Nodo", "Tickets_Total"), ["Zona", "Fecha"])


def sample_rows(df: DataFrame, key_cols, n: int = 2, seed: int = 42, width: int = 150) -> DataFrame:
    """K6: n rows picked by a seeded hash, shown as (row, column, value) for the
    non-empty cells only, values cut to ``width`` characters; ``key_cols`` name a row."""
    h = F.md5(F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in key_cols], F.lit(str(seed))))
    pick = df.withColumn("_h", h).orderBy("_h").limit(n).withColumn(
        "Muestra", F.row_number().over(Window.orderBy("_h"))).drop("_h")
    cols = [c for c in pick.columns if c not in ("Muestra", *key_cols)]
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', CAST(`{c}` AS STRING)" for c in cols)
    long = pick.selectExpr("Muestra", f"stack({len(cols)}, {pairs}) AS (Campo, Valor)")
    v = F.col("Valor")
    long = long.filter(v.isNotNull() & (F.trim(v) != "") & (F.lower(v) != "nan"))
    return long.withColumn("Valor", F.when(F.length(v) > width, F.concat(F.substring(v, 1, width), F.lit("...")))
                           .otherwise(v))


def dataset_probe(df: DataFrame, order_col: str) -> DataFrame:
    """K7: row and column counts and the first record (by ``order_col``, itself not shown), as rows."""
    n = df.count()
    first = df.orderBy(order_col).limit(1)
    cols = [c for c in df.columns if c != order_col]
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', CAST(`{c}` AS STRING)" for c in cols)
    rec = first.selectExpr(f"stack({len(cols)}, {pairs}) AS (Campo, Valor)")
    head = df.sparkSession.createDataFrame([("filas", str(n)), ("columnas", str(len(cols)))],
                                           "Campo string, Valor string")
    return head.unionByName(rec)


def display_labels(df: DataFrame, date_col: str = "Fecha", name_col: str = "Nodo") -> DataFrame:
    """Weekday short name, month name (1..5), 'dd-Mon' label, name cut to 15."""
    names = F.array(*[F.lit(x) for x in C.WEEKDAY_SHORT_ES])
    return df.withColumns({
        "Dia_Nombre": F.element_at(names, F.weekday(date_col) + 1),
        "Mes_Nombre": month_name(date_col),
        "Etiqueta": F.date_format(date_col, "dd-MMM"),
        "Nombre_Corto": short_label(name_col),
    })


def sla_risk_scores(sla: DataFrame, prior_weight: float = 10.0) -> DataFrame:
    """P21 over an empirical score: each ticket's breach probability is the smoothed
    breach rate of its (priority, central) group; tiers at 70 % / 50 %."""
    g = sla.groupBy("Prioridad", "CENTRAL").agg(F.sum("Target").alias("_b"), F.count(F.lit(1)).alias("_n"))
    base = sla.agg(F.avg("Target")).first()[0] or 0.0
    prob = (F.col("_b") + F.lit(prior_weight * base)) / (F.col("_n") + F.lit(prior_weight)) * 100.0
    g = g.select("Prioridad", "CENTRAL", prob.alias("Riesgo_Pct"))
    return g.withColumn("Nivel", sla_risk_tier("Riesgo_Pct"))
