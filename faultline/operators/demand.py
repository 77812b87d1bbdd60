"""Daily demand panel: D1, P17, J1, J2, W1-W3 (the core of the system)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline import config as C
from faultline.functions import fold_accents, normalise_node

KEY = ["Zona", "Nodo"]
PANEL_COLUMNS = ["Fecha", "Zona", "Nodo", "Tickets_Total", "Dia_Semana", "Mes", "Lag_1", "Lag_7",
                 "Media_Movil_7d", "Media_Movil_14d"]


def daily_counts(tickets: DataFrame, date_col: str = "Fecha") -> DataFrame:
    """Tickets per (Fecha, Zona, Nodo). Partial (map-side) aggregation first,
    so a hot node never ships its raw rows through the shuffle."""
    d = tickets if date_col == "Fecha" else tickets.withColumn("Fecha", F.to_date(date_col))
    return (d.groupBy("Fecha", "Zona", "Nodo")
            .agg(F.count(F.lit(1)).alias("Tickets_Total")))


def allow_list_frame(spark: SparkSession, allow: dict | None = None,
                     fold_enye: bool = True) -> DataFrame:
    """(zone_key, allowed normalised nodes) from the fixed allow-list; a handful of rows."""
    allow = C.VALID_ZONES_NODES if allow is None else allow
    rows = [(z.strip(), n) for z, nodes in allow.items() for n in nodes]
    df = spark.createDataFrame(rows, "zone_key string, node string")
    return (df.groupBy("zone_key")
            .agg(F.collect_set(fold_accents("node", fold_enye)).alias("allowed_nodes")))


def filter_allowed(df: DataFrame, allow: dict | None = None, fold_enye: bool = True) -> DataFrame:
    """Rows of unknown zones pass; rows of listed zones pass only with a listed
    node (after P16 normalisation) or an unknown node."""
    al = F.broadcast(allow_list_frame(df.sparkSession, allow, fold_enye))
    n = normalise_node(F.col("Nodo"), fold_enye)
    joined = df.join(al, F.trim(F.col("Zona")) == F.col("zone_key"), "left")
    keep = (F.col("zone_key").isNull() | F.array_contains("allowed_nodes", n)
            | (n == F.lit(C.UNKNOWN.lower())))
    return joined.filter(keep).drop("zone_key", "allowed_nodes")


def date_bounds(df: DataFrame, col: str = "Fecha") -> tuple[dt.date, dt.date]:
    """Global min/max date as driver scalars (one tiny aggregate job)."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return r["lo"], r["hi"]


def dense_spine(pairs: DataFrame, lo, hi) -> DataFrame:
    """Every valid pair x every date in [lo, hi], via explode(sequence) per pair."""
    return pairs.withColumn("Fecha", F.explode(F.sequence(F.lit(lo), F.lit(hi),
                                                          F.expr("INTERVAL 1 DAY"))))


def add_lag_features(panel: DataFrame, y: str = "Tickets_Total") -> DataFrame:
    """W1 + W2: lags 1/7 and trailing 7/14-day means that exclude the current day
    and stay NULL until the frame is full."""
    w = Window.partitionBy(*KEY).orderBy("Fecha")
    out = panel.withColumns({
        "Dia_Semana": F.weekday("Fecha"),
        "Mes": F.month("Fecha"),
        "Lag_1": F.lag(y, 1).over(w).cast("double"),
        "Lag_7": F.lag(y, 7).over(w).cast("double"),
    })
    for k in (7, 14):
        wk = w.rowsBetween(-k, -1)
        out = out.withColumn(f"Media_Movil_{k}d",
                             F.when(F.count(y).over(wk) == k, F.avg(y).over(wk)))
    return out


def demand_panel(counts: DataFrame, allow: dict | None = None, fold_enye: bool = True,
                 drop_warmup: bool = True, bounds=None) -> DataFrame:
    """D1 output -> dense, feature-complete panel.

    Shuffles: the counts are already aggregated; the spine and the counts are
    unioned and summed under a (Zona, Nodo) hash partitioning that the window
    functions then reuse, so the panel costs one exchange and no join.
    """
    lo, hi = bounds if bounds is not None else date_bounds(counts)
    valid = filter_allowed(counts, allow, fold_enye).select("Fecha", "Zona", "Nodo", "Tickets_Total")
    pairs = valid.select(*KEY).distinct()
    spine = dense_spine(pairs, lo, hi).withColumn("Tickets_Total", F.lit(0).cast("long"))
    both = spine.select(*valid.columns).unionByName(valid)
    panel = (both.repartition(*KEY)
             .groupBy("Fecha", "Zona", "Nodo")
             .agg(F.sum("Tickets_Total").cast("long").alias("Tickets_Total")))
    panel = add_lag_features(panel).select(*PANEL_COLUMNS)
    if drop_warmup:
        panel = panel.dropna()  # W3: the first 14 rows of every series
    return panel
