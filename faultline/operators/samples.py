"""Direct multi-horizon training samples (W5 + J10)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline import config as C

KEY = ["Zona", "Nodo"]
SAMPLE_COLUMNS = ["Fecha", "Zona", "Nodo", "Tickets_Total", "Dia_Semana", "Mes", "Horizonte",
                  "Lag_1_origin", "Lag_7_origin", "Media_Movil_7d_origin", "Media_Movil_14d_origin"]


def origin_features(df: DataFrame, y: str = "Tickets_Total") -> DataFrame:
    """Per row o of a series: y[o], y[o-6] (y[0] before that), the mean of the
    last 7 and of up to the last 14 values, origin included; plus the row index."""
    w = Window.partitionBy(*KEY).orderBy("Fecha")
    first = F.first(y).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({
        "_idx": F.row_number().over(w) - 1,
        "Lag_1_origin": F.col(y).cast("double"),
        "Lag_7_origin": F.coalesce(F.lag(y, 6).over(w), first).cast("double"),
        "Media_Movil_7d_origin": F.avg(y).over(w.rowsBetween(-6, 0)),
        "Media_Movil_14d_origin": F.avg(y).over(w.rowsBetween(-13, 0)),
    })


def direct_samples(df: DataFrame, y: str = "Tickets_Total", max_h: int = C.MAX_HORIZON,
                   min_target: int = C.SAMPLE_MIN_TARGET_IDX,
                   min_origin: int = C.SAMPLE_MIN_ORIGIN_IDX) -> DataFrame:
    """Every (target t, horizon h in 1..max_h) with origin o = t - h, t >= 14, o >= 7.

    No self-join: each origin row gathers the next ``max_h`` rows of its own series
    through a bounded window frame (same partitioning as the feature windows), and
    the horizon explode happens last, so the windows run on 1x rows. Before it the origins are
    dealt evenly, so one long series isn't one task of ``max_h`` times its rows."""
    w = Window.partitionBy(*KEY).orderBy("Fecha")
    o = origin_features(df.select(*KEY, "Fecha", y), y)
    o = o.withColumn("_fut", F.collect_list(F.struct(
        F.col("_idx").alias("i"), F.col("Fecha").alias("f"), F.col(y).alias("y")))
        .over(w.rowsBetween(1, max_h)))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    o = o.filter(F.col("_idx") >= min_origin).repartition(tasks, *KEY, "_idx")
    e = o.select(*KEY, "_idx", "Lag_1_origin", "Lag_7_origin", "Media_Movil_7d_origin",
                 "Media_Movil_14d_origin", F.explode("_fut").alias("_t"))
    e = e.filter(F.col("_t.i") >= min_target)
    return e.select(
        F.col("_t.f").alias("Fecha"), *KEY, F.col("_t.y").alias("Tickets_Total"),
        F.weekday("_t.f").alias("Dia_Semana"), F.month("_t.f").alias("Mes"),
        (F.col("_t.i") - F.col("_idx")).cast("int").alias("Horizonte"),
        "Lag_1_origin", "Lag_7_origin", "Media_Movil_7d_origin", "Media_Movil_14d_origin")


def served_series(panel: DataFrame, node_zone: str = C.CENTRO, least: int = C.MIN_SEGMENT_SAMPLES,
                  max_h: int = C.MAX_HORIZON, min_target: int = C.SAMPLE_MIN_TARGET_IDX,
                  min_origin: int = C.SAMPLE_MIN_ORIGIN_IDX) -> DataFrame:
    """The (Zona, Nodo) whose segment has a model. A segment is a zone, or in ``node_zone`` a
    single node, which needs ``least`` direct samples. The number of samples follows from the
    length of a series, so no sample is made to count them."""
    length = panel.groupBy(*KEY).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    targets = F.when(F.col("_n") > min_target, F.sequence(F.lit(min_target), F.col("_n") - 1))
    made = F.aggregate(targets, F.lit(0).cast("long"), lambda total, t: total + F.least(F.lit(max_h), t - min_origin))
    own = length.withColumn("_samples", F.coalesce(made, F.lit(0).cast("long")))
    zone = Window.partitionBy("Zona")
    enough = F.when(F.col("Zona") == node_zone, F.col("_samples") >= least).otherwise(F.sum("_samples").over(zone) > 0)
    return own.withColumn("_ok", enough).filter("_ok").select(*KEY)
