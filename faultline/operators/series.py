"""Zone-level series helpers: min-max scaling (W7) and 7-day input vectors."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def scaled_windows(zd: DataFrame, by: str = "Zona", y: str = "Tickets_Total", window: int = 7) -> DataFrame:
    """(y - min) / (max - min) per group, 0 when max = min; W6: the previous
    ``window`` scaled values (oldest first) as an array, rows with a full week only."""
    z = Window.partitionBy(by)
    lo, hi = F.min(y).over(z), F.max(y).over(z)
    s = zd.withColumns({"_lo": lo, "_hi": hi})
    s = s.withColumn("Escalado", F.when(F.col("_hi") > F.col("_lo"),
                                        (F.col(y) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")))
                     .otherwise(F.lit(0.0)))
    w = Window.partitionBy(by).orderBy("Fecha")
    s = s.withColumn("Ventana", F.collect_list("Escalado").over(w.rowsBetween(-window, -1)))
    return s.filter(F.size("Ventana") == window).drop("_lo", "_hi")


def inverse_scale(df: DataFrame, col: str, lo: str = "_lo", hi: str = "_hi") -> F.Column:
    """Back to ticket units: x * (max - min) + min."""
    return F.col(col) * (F.col(hi) - F.col(lo)) + F.col(lo)
