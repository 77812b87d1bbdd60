"""Back-tests keyed by cutoff: walk-forward validation of V4 vs V5 (B5: W13, M10, M12/M13, D4, J3, D9, U4, D11, J6) and
back-casts at fixed cutoffs (B9: W14)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline import config as C
from faultline.operators import forecast, metrics, splits, stats

KEYS = ("Split", *forecast.KEY)


def zone_days(df: DataFrame, value: str, out: str, by=("Split", "Zona", "Fecha")) -> DataFrame:
    """D4 per split."""
    return df.groupBy(*by).agg(F.sum(value).alias(out))


def real_by_split(panel: DataFrame, windows) -> DataFrame:
    """Zone totals of the test days of each (Split, first day, last day) of the list ``windows``. Days are rolled
    up before they are copied to the splits that hold them."""
    spans = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(a).cast("date").alias("a"), F.lit(b).cast("date").alias("b")) for s, a, b in windows])
    lo, hi = min(a for _, a, _ in windows), max(b for _, _, b in windows)
    days = metrics.zone_daily(panel.where(F.col("Fecha").between(F.lit(lo), F.lit(hi))), "Tickets_Total", "Real")
    held = F.filter(spans, lambda x: F.col("Fecha").between(x["a"], x["b"]))
    return days.select(F.explode(F.transform(held, lambda x: x["s"])).alias("Split"), "Zona", "Fecha", "Real")


def walk_forward(panel: DataFrame, weather: DataFrame | None = None, n_splits: int = 3,
                 days_ahead: int = 14) -> DataFrame:
    """Per split: train up to the cutoff, forecast ``days_ahead`` days with V4 and V5 (iterative), score per zone (MAE
    and RMSE to 2 decimals, MAPE to 1, half-even). The split is a key of one plan: statistics as of each cutoff
    and origin rows come from the panel as it is, however many splits there are (their bounds are a
    handful of driver scalars)."""
    bounds = splits.walk_forward_splits(panel, n_splits, days_ahead).collect()
    cutoffs = [(r["Split"], r["Corte_Train"]) for r in bounds]
    origins = forecast.origins_at(panel, cutoffs)
    se, fa = stats.stats_at(panel, cutoffs)
    v4 = forecast.forecast_direct(panel, se, fa, days_ahead, min_history=C.V4_MIN_HISTORY, origins=origins, keys=KEYS)
    v5 = forecast.forecast_v5_iterative(panel, se, fa, days_ahead, weather=weather, origins=origins, keys=KEYS)
    cols = ["Split", *forecast.FORECAST_COLUMNS]
    both = v4.select(*cols, F.lit("V4").alias("Modelo")).unionByName(v5.select(*cols, F.lit("V5").alias("Modelo")))
    pred = zone_days(both, "Prediccion_Tickets", "Pred", ("Split", "Modelo", "Zona", "Fecha"))
    real = real_by_split(panel, [(r["Split"], r["Inicio_Test"], r["Fin_Test"]) for r in bounds])
    m = metrics.error_metrics(pred.join(real, ["Split", "Zona", "Fecha"]), by=("Split", "Modelo", "Zona"))
    return m.select("Zona", F.bround("MAE", 2).alias("MAE"), F.bround("MAPE", 1).alias("MAPE"), F.bround("RMSE", 2).alias("RMSE"),
                    "Split", "Modelo")


def backcasts(panel: DataFrame, cutoffs_days) -> DataFrame:
    """B9 (W14): V4 back-casts by the stand-in from fixed cutoffs, scored against the zone's actuals. ``cutoffs_days``:
    (Corte, Dias); the training days lie before Corte. Keyed by cutoff, so all come from one plan."""
    rows = [(dt.date.fromisoformat(c) if isinstance(c, str) else c, int(d)) for c, d in cutoffs_days]
    cutoffs = [(i, c - dt.timedelta(days=1)) for i, (c, _) in enumerate(rows)]
    se, fa = stats.stats_at(panel, cutoffs)
    days, starts = F.array(*[F.lit(d) for _, d in rows]), F.array(*[F.lit(c) for c, _ in rows])
    fc = forecast.forecast_direct(panel, se, fa, F.get(days, F.col("Split")), min_history=C.V4_MIN_HISTORY,
                                  origins=forecast.origins_at(panel, cutoffs), keys=KEYS)
    joined = zone_days(fc, "Prediccion_Tickets", "Pred").join(metrics.zone_daily(panel, "Tickets_Total", "Real"), ["Zona", "Fecha"])
    m = metrics.error_metrics(joined, by=("Split", "Zona"))
    return m.select("Zona", "MAE", "MAPE", "RMSE", "Dias", "Dias_Sin_Demanda", F.get(starts, F.col("Split")).alias("Corte"))
