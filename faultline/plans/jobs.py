"""Composed jobs (B1-B11): each is a function of the input tables that returns the
DataFrames it would store; writing is left to ``sources.files.save``."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators import (backtest, clean, demand, forecast, metrics, models, profile,
                                 reports, splits, stats, v5)
from faultline.session import landed


def master_pipeline(raw_export: DataFrame, sla_sheet: DataFrame | None = None, top_n: int = 10) -> dict:
    """B1: clean tickets -> (SLA classifier) -> resolution regressor -> node profile ->
    clustering -> top critical nodes."""
    tickets = clean.clean_tickets(raw_export)
    out = {"tickets": tickets}
    if sla_sheet is not None:
        out["sla_model"], out["sla_report"] = models.train_sla_classifier(clean.clean_sla(sla_sheet))
    out["regressor"], out["regressor_metrics"] = models.train_resolution_regressor(tickets)
    prof = profile.node_profiles(tickets)
    out["profiles"], crit = profile.cluster_nodes(prof)
    out["top_critical"] = profile.top_critical_nodes(crit, top_n)
    return out


def demand_forecasting(raw_export: DataFrame, days: int = 30, with_models: bool = True, **training) -> dict:
    """B2: export -> demand panel -> v1 model and its recursive forecast -> history + forecast table.
    ``training`` goes to ``v5.train_v1``; without models the stand-in forecasts."""
    counts = demand.daily_counts(clean.demand_tickets_from_export(raw_export))
    panel = landed(demand.demand_panel(counts), "panel")
    fc = forecast.forecast_v1_recursive(panel, days, model=v5.train_v1(panel, **training) if with_models else None)
    hist = panel.select("Fecha", "Zona", "Nodo", F.col("Tickets_Total").alias("Tickets"),
                        F.lit("historico").alias("serie"))
    both = hist.unionByName(fc.select("Fecha", "Zona", "Nodo", F.col("Prediccion_Tickets").alias("Tickets"),
                                      F.lit("prediccion").alias("serie")))
    return {"panel": panel, "forecast": fc, "history_forecast": both}


def holdout_comparison(panel: DataFrame, cutoff, weather: DataFrame | None = None,
                       days: int | None = None, with_models: bool = False, **training) -> DataFrame:
    """Train before the cutoff, forecast the rest with V4, V5 iterative and
    V5 direct, score per zone (MAE, MAPE, RMSE). ``with_models``: by models trained with the
    arguments ``training`` (``v5.train``), else by the stand-in."""
    train, test = splits.date_cut(panel, cutoff)
    if days is None:
        hi = panel.agg(F.max("Fecha")).first()[0]
        days = (hi - (cutoff if isinstance(cutoff, dt.date) else dt.date.fromisoformat(cutoff))).days + 1
    se, fa = stats.seasonal_means(train), stats.dow_factors(train)
    if with_models:
        train = landed(train, "panel")
        bundle = v5.train(train, weather, **training)
        preds = {"V4": v5.forecast_v4_model(train, bundle, days, weather), "V5_Direct": v5.forecast_v5_direct_model(train, bundle, days, weather),
                 "V5_Iter": v5.forecast_v5_model(train, bundle, days, weather)}
    else:
        preds = {"V4": forecast.forecast_v4(train, se, fa, days), "V5_Direct": forecast.forecast_v5_direct(train, se, fa, days),
                 "V5_Iter": forecast.forecast_v5_iterative(train, se, fa, days, weather)}
    out = None
    for name, p in preds.items():
        m = metrics.error_metrics(metrics.real_vs_pred(test, p)).withColumn("Modelo", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out


def walk_forward_report(panel: DataFrame, weather: DataFrame | None = None, n_splits: int = 3,
                        days_ahead: int = 14) -> dict:
    """Split metrics, per-model summary and the V5 - V4 differences."""
    m = backtest.walk_forward(panel, weather, n_splits, days_ahead)
    s = metrics.walk_forward_summary(m)
    return {"splits": m, "summary": s, "compare": metrics.compare_models(s, "V4", "V5")}


def retrain(tickets: DataFrame, sla: DataFrame, path: str) -> None:
    """Recompute cyclic columns if absent, refit both models, store them."""
    t = clean.ensure_cyclic(tickets)
    clf, _ = models.train_sla_classifier(sla)
    reg, _ = models.train_resolution_regressor(t)
    models.save_model(clf, f"{path}/sla_classifier")
    models.save_model(reg, f"{path}/resolution_regressor")


def month_evaluation(panel: DataFrame, cutoff, days: int | None = None, with_models: bool = True, **training) -> DataFrame:
    """Train v1 before the cutoff, forecast from there, join actuals on the full key (Q7), accumulate."""
    train, test = splits.date_cut(panel, cutoff)
    if days is None:
        days = test.select("Fecha").distinct().count()  # distinct days, not rows (Q7)
    train = landed(train, "panel")
    fc = forecast.forecast_v1_recursive(train, days, model=v5.train_v1(train, **training) if with_models else None)
    return metrics.accumulated(metrics.node_real_vs_pred(test, fc))


def today_forecast(panel: DataFrame, day, weather: DataFrame | None = None, bundle: v5.Bundle | None = None) -> DataFrame:
    """Per-zone totals for ``day``: actuals when present, else the V4 forecast, by a stored
    ``bundle`` (``v5.load_bundle``) or the stand-in."""
    hi = panel.agg(F.max("Fecha")).first()[0]
    d = day if isinstance(day, dt.date) else dt.date.fromisoformat(day)
    horizon = max(1, (d - hi).days)
    fc = v5.forecast_v4_model(panel, bundle, horizon, weather) if bundle else \
        forecast.forecast_v4(panel, stats.seasonal_means(panel), stats.dow_factors(panel), horizon, weather=weather)
    return reports.day_totals(panel, fc, d)


def backcasts(panel: DataFrame, cutoffs_days, zone: str | None = None, bundle: v5.Bundle | None = None, weather: DataFrame | None = None) -> DataFrame:
    """V4 back-casts at fixed cutoffs (W14), by a stored ``bundle`` or the stand-in, joined to
    zone actuals (J3), MAE each. The stand-in's cutoffs share one plan."""
    if bundle is None:
        out = backtest.backcasts(panel, cutoffs_days)
        return out if zone is None else out.filter(F.col("Zona") == zone)
    out = None
    for c, days in cutoffs_days:
        train = panel.filter(F.col("Fecha") < F.lit(c).cast("date"))
        fc = v5.forecast_v4_model(train, bundle, days, weather)
        j = metrics.real_vs_pred(panel, fc)
        if zone is not None:
            j = j.filter(F.col("Zona") == zone)
        m = metrics.error_metrics(j).withColumn("Corte", F.lit(c).cast("date"))
        out = m if out is None else out.unionByName(m)
    return out


def discrepancy_analysis(panel: DataFrame, cutoff, peak_threshold: int) -> dict:
    """Autocorrelation, peak-day drill-down, weekday profile, train/test means, CV."""
    return {"autocorr": reports.autocorrelation(panel),
            "peaks": reports.peak_days(panel, cutoff, peak_threshold),
            "weekday": reports.weekday_profile(panel, cutoff),
            "means": reports.train_test_means(panel, cutoff),
            "variation": reports.variation(panel)}


def hot_zone_report(raw_export: DataFrame) -> DataFrame:
    """Tolerant export -> node x month crosstab -> run-rate projection -> top 15."""
    t = raw_export.select(F.col("Creada").alias("Fecha_Creacion"),
                          F.col("`Campo personalizado (Nodo Afectado)`").alias("Nodo"))
    t = clean.with_parsed_times(t, ["Fecha_Creacion"])
    return reports.heat_map(reports.run_rate_projection(reports.node_month_crosstab(t)))
