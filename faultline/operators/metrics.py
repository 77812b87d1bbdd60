"""Back-test metrics: zone/day rollups (D4), real vs predicted joins (J3-J6, J12),
MAE/MAPE/RMSE (D9), WAPE and operating precision (D10), walk-forward summary (D11),
accumulated totals (D21)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions import precision_grade


def zone_daily(df: DataFrame, value: str, out: str | None = None) -> DataFrame:
    """Sum of ``value`` per (Zona, Fecha)."""
    return df.groupBy("Zona", "Fecha").agg(F.sum(value).alias(out or value))


def real_vs_pred(real: DataFrame, pred: DataFrame, real_col: str = "Tickets_Total",
                 pred_col: str = "Prediccion_Tickets") -> DataFrame:
    """zone/day rollups of actuals and forecasts, inner-joined on (Zona, Fecha)."""
    return zone_daily(real, real_col, "Real").join(zone_daily(pred, pred_col, "Pred"),
                                                   ["Zona", "Fecha"], "inner")


def error_metrics(joined: DataFrame, by=("Zona",), real: str = "Real", pred: str = "Pred") -> DataFrame:
    """MAE, MAPE over non-zero actuals (Q14: the excluded count is reported), RMSE."""
    err = F.col(pred).cast("double") - F.col(real).cast("double")
    ape = F.abs(err) / F.when(F.col(real) != 0, F.col(real).cast("double"))
    return (joined.groupBy(*by)
            .agg(F.avg(F.abs(err)).alias("MAE"), (F.avg(ape) * F.lit(100.0)).alias("MAPE"),
                 F.sqrt(F.avg(err * err)).alias("RMSE"), F.count(F.lit(1)).alias("Dias"),
                 F.count_if(F.col(real) == 0).alias("Dias_Sin_Demanda")))


def wape_precision(joined: DataFrame, by=("Zona",), real: str = "Real", pred: str = "Pred") -> DataFrame:
    """D10 + P23: WAPE = sum|e| / sum(real); precision = max(0, (1 - WAPE) * 100),
    0 when the actual sum is <= 0; graded > 85 / 70..85 / < 70."""
    a = joined.groupBy(*by).agg(
        F.sum(F.abs(F.col(pred).cast("double") - F.col(real).cast("double"))).alias("Suma_Errores"),
        F.sum(F.col(real).cast("double")).alias("Suma_Reales"),
        F.avg(F.abs(F.col(pred).cast("double") - F.col(real).cast("double"))).alias("MAE"))
    wape = F.col("Suma_Errores") / F.col("Suma_Reales")
    prec = F.when(F.col("Suma_Reales") > 0, F.greatest(F.lit(0.0), (F.lit(1.0) - wape) * 100.0)) \
        .otherwise(F.lit(0.0))
    return (a.withColumn("WAPE", F.when(F.col("Suma_Reales") > 0, wape))
            .withColumn("Precision_Operativa", prec)
            .withColumn("Grado", precision_grade("Precision_Operativa")))


def walk_forward_summary(metrics: DataFrame) -> DataFrame:
    """Mean MAE / RMSE per (Modelo, Zona) over splits, 2 decimals (half-even)."""
    return (metrics.groupBy("Modelo", "Zona")
            .agg(F.bround(F.avg("MAE"), 2).alias("MAE"), F.bround(F.avg("RMSE"), 2).alias("RMSE")))


def compare_models(summary: DataFrame, a: str, b: str) -> DataFrame:
    """Per zone, the two models' means side by side and their differences (b - a)."""
    sa = summary.filter(F.col("Modelo") == a).select(
        "Zona", F.col("MAE").alias(f"MAE_{a}"), F.col("RMSE").alias(f"RMSE_{a}"))
    sb = summary.filter(F.col("Modelo") == b).select(
        "Zona", F.col("MAE").alias(f"MAE_{b}"), F.col("RMSE").alias(f"RMSE_{b}"))
    j = sa.join(sb, "Zona")
    return j.withColumns({"MAE_diff": F.col(f"MAE_{b}") - F.col(f"MAE_{a}"),
                          "RMSE_diff": F.col(f"RMSE_{b}") - F.col(f"RMSE_{a}")})


def outer_three(real: DataFrame, p1: DataFrame, p2: DataFrame, names=("V4", "V5")) -> DataFrame:
    """Full outer join of a zone's actual and two forecasts per day, NULL -> 0."""
    r = zone_daily(real, "Tickets_Total", "Real")
    a = zone_daily(p1, "Prediccion_Tickets", names[0])
    b = zone_daily(p2, "Prediccion_Tickets", names[1])
    j = r.join(a, ["Zona", "Fecha"], "full").join(b, ["Zona", "Fecha"], "full")
    return j.fillna(0, subset=["Real", names[0], names[1]])


def inner_three(real: DataFrame, p1: DataFrame, p2: DataFrame, names=("V4", "V5")) -> DataFrame:
    """Inner 3-way join of the same rollups."""
    r = zone_daily(real, "Tickets_Total", "Real")
    a = zone_daily(p1, "Prediccion_Tickets", names[0])
    b = zone_daily(p2, "Prediccion_Tickets", names[1])
    return r.join(a, ["Zona", "Fecha"]).join(b, ["Zona", "Fecha"])


def node_real_vs_pred(real: DataFrame, pred: DataFrame) -> DataFrame:
    """Actual vs forecast at node grain, on the full key (decision Q7)."""
    return (real.select("Fecha", "Zona", "Nodo", F.col("Tickets_Total").alias("Real"))
            .join(pred.select("Fecha", "Zona", "Nodo", F.col("Prediccion_Tickets").alias("Proyeccion")),
                  ["Fecha", "Zona", "Nodo"]))


def accumulated(joined: DataFrame, real: str = "Real", pred: str = "Proyeccion") -> DataFrame:
    """Accumulated actual and forecast, MAE, MAE as % of the actual mean, days."""
    err = F.abs(F.col(pred).cast("double") - F.col(real).cast("double"))
    a = joined.agg(F.sum(real).alias("Real_Acumulado"), F.sum(pred).alias("Proyeccion_Acumulada"),
                   F.avg(err).alias("MAE"), F.avg(F.col(real).cast("double")).alias("_mr"),
                   F.count_distinct("Fecha").alias("Dias"))
    return a.select("Real_Acumulado", "Proyeccion_Acumulada", "MAE",
                    (F.col("MAE") / F.col("_mr") * 100.0).alias("MAE_Pct_Media"), "Dias")
