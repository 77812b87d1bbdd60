"""Forecast arithmetic: V4 direct (M10), V5 adaptive blend (M13), V5 iterative (M12),
V5 direct (M14), v1 recursive (M15), future grid (J9), latest origin (W10) and the
statistic lookups with defaults (J7).

The base predictor is pluggable: a function that adds ``_p`` (V4/v1) or
``_p30, _p50, _p70`` (V5) to the future grid. The default stand-in is a trailing
mean of the origin features, which keeps every step exact against SQL; the
trained models of ``operators.v5`` plug in the same way.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline import config as C
from faultline.functions import calendar_columns, nonneg_round
from faultline.operators.boosting import bound
from faultline.operators.samples import origin_features

KEY = ["Zona", "Nodo"]
FORECAST_COLUMNS = ["Fecha", "Zona", "Nodo", "Prediccion_Tickets"]
V5_COLUMNS = ["Fecha", "Zona", "Nodo", "Prediccion_Tickets", "Pred_Q30", "Pred_Q50", "Pred_Q70"]


def latest_origin(panel: DataFrame, min_history: int, y: str = "Tickets_Total",
                  keep_last: int = 14) -> DataFrame:
    """The last row of each series with >= min_history rows, its origin
    features, and its last ``keep_last`` values (the iterative state). Only the last rows
    of a series are ranked and windowed; its length is a plain count."""
    rows = panel.select(*KEY, "Fecha", y)
    length = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_history)
    newest = Window.partitionBy(*KEY).orderBy(F.desc("Fecha"))
    last = rows.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= max(keep_last, 14))
    w = Window.partitionBy(*KEY).orderBy("Fecha")
    o = origin_features(last, y).withColumn(
        "_win", F.collect_list(F.col(y).cast("double")).over(w.rowsBetween(-(keep_last - 1), 0)))
    return (o.filter("_rn = 1").join(length.select(*KEY), KEY, "left_semi")
            .select(*KEY, F.col("Fecha").alias("origen"), "Lag_1_origin", "Lag_7_origin",
                    "Media_Movil_7d_origin", "Media_Movil_14d_origin", "_win"))


def origins_at(panel: DataFrame, cutoffs, y: str = "Tickets_Total", keep_last: int = 14) -> DataFrame:
    """W10 at many cutoffs in one scan: for each (Split, Corte) of the list ``cutoffs`` and each series its last row
    on or before Corte, as ``latest_origin`` gives it, with Split and _n, the number of its rows up to there.
    A row is the origin of the cutoffs that lie before the series' next row, so no row is copied per cutoff."""
    w = Window.partitionBy(*KEY).orderBy("Fecha")
    rows = origin_features(panel.select(*KEY, "Fecha", y), y).withColumns({
        "_win": F.collect_list(F.col(y).cast("double")).over(w.rowsBetween(-(keep_last - 1), 0)), "_next": F.lead("Fecha").over(w)})
    splits = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(c).cast("date").alias("c")) for s, c in cutoffs])
    due = F.filter(splits, lambda x: (F.col("Fecha") <= x["c"]) & (F.col("_next").isNull() | (x["c"] < F.col("_next"))))
    return rows.where(F.size(due) > 0).select(
        F.explode(due).alias("_at"), *KEY, F.col("Fecha").alias("origen"), "Lag_1_origin", "Lag_7_origin", "Media_Movil_7d_origin",
        "Media_Movil_14d_origin", "_win", (F.col("_idx") + 1).alias("_n")).select(F.col("_at.s").alias("Split"), "*").drop("_at")


def future_grid(origin: DataFrame, days, start_col: str = "origen") -> DataFrame:
    """Series x horizon 1..days future rows with calendar features; ``days`` may be a column."""
    g = origin.withColumn("Horizonte", F.explode(F.sequence(F.lit(1), F.lit(days))))
    g = g.withColumn("Fecha", F.date_add(start_col, F.col("Horizonte")))
    g = g.withColumns({"Dia_Semana": F.weekday("Fecha"), "Mes": F.month("Fecha")})
    return g.withColumns(calendar_columns("Fecha"))


def attach_stats(grid: DataFrame, seasonal: DataFrame, factors: DataFrame, keys=tuple(KEY)) -> DataFrame:
    """Seasonal mean and weekday factor by (Zona, Nodo, weekday); both are at most
    7 rows per series and are joined by key (AQE broadcasts them when small)."""
    g = grid.withColumn("dow", F.weekday("Fecha"))
    return (g.join(seasonal, [*keys, "dow"], "left")
            .join(factors, [*keys, "dow"], "left")
            .withColumn("dow_factor", F.coalesce("dow_factor", F.lit(1.0))))


def trailing_mean_predictor(grid: DataFrame) -> DataFrame:
    """Stand-in point predictor: the origin's trailing 7-day mean."""
    return grid.withColumn("_p", F.col("Media_Movil_7d_origin"))


def trailing_band_predictor(grid: DataFrame) -> DataFrame:
    """Stand-in quantile predictor: median ~ 7-day mean, band = [min, max] of 7/14-day means."""
    a, b = F.col("Media_Movil_7d_origin"), F.col("Media_Movil_14d_origin")
    return grid.withColumns({"_p30": F.least(a, b), "_p50": a, "_p70": F.greatest(a, b)})


def blend(p, factor, seasonal, damping: float, w: float = C.ENSEMBLE_XGB_W):
    """Weekday correction with damping, then the seasonal ensemble (seasonal
    defaults to the corrected value)."""
    adj = p * (F.lit(1.0) + F.lit(damping) * (factor - F.lit(1.0)))
    seas = F.coalesce(seasonal, adj)
    return F.lit(w) * adj + F.lit(1.0 - w) * seas


def mark_served(grid: DataFrame, served: DataFrame | None) -> DataFrame:
    """Column ``_served``: whether a model serves the series (``served``: the (Zona, Nodo)
    with one, None for all)."""
    if served is None:
        return grid.withColumn("_served", F.lit(True))
    own = served.select(*KEY, F.lit(True).alias("_served"))
    return grid.join(own, KEY, "left").fillna(False, subset=["_served"])


def forecast_direct(panel: DataFrame, seasonal: DataFrame, factors: DataFrame, days,
                    predictor=trailing_mean_predictor, min_history: int = C.V4_MIN_HISTORY,
                    damping: float = C.V4_DOW_DAMPING, weather: DataFrame | None = None,
                    pred_col: str = "_p", served: DataFrame | None = None,
                    origins: DataFrame | None = None, keys=tuple(KEY)) -> DataFrame:
    """M10 (V4) / M14 (V5 direct, with min_history=14, damping=0.35, pred_col='_p50').
    Series outside ``served`` take their seasonal mean (0 without one) as the prediction. With ``origins``
    (``origins_at``) and statistics keyed by ``keys``, several cutoffs are forecast at once."""
    origin = latest_origin(panel, min_history) if origins is None else origins.where(F.col("_n") >= min_history)
    grid = future_grid(origin, days)
    if weather is not None:
        from faultline.operators.weather import lookup_weather
        grid = lookup_weather(grid, weather)
    g = mark_served(predictor(attach_stats(grid, seasonal, factors, keys)), served)
    p = F.coalesce(F.when(F.col("_served"), F.col(pred_col)), "seasonal", F.lit(0.0))
    final = blend(p, F.col("dow_factor"), F.col("seasonal"), damping)
    return g.select("Fecha", *keys, nonneg_round(final).alias("Prediccion_Tickets"))


def forecast_v4(panel, seasonal, factors, days, predictor=trailing_mean_predictor, weather=None, served=None):
    return forecast_direct(panel, seasonal, factors, days, predictor, C.V4_MIN_HISTORY,
                           C.V4_DOW_DAMPING, weather, "_p", served)


def forecast_v5_direct(panel, seasonal, factors, days, predictor=trailing_band_predictor,
                       weather=None, served=None):
    return forecast_direct(panel, seasonal, factors, days, predictor, C.V5_MIN_HISTORY,
                           C.V5_DOW_DAMPING, weather, "_p50", served)


def v5_blend_weights(risky):
    """Risky days (heavy rain, payday window, Monday) lean to the upper quantile."""
    r, n = C.V5_WEIGHTS_RISKY, C.V5_WEIGHTS_NORMAL
    return [F.when(risky, F.lit(r[i])).otherwise(F.lit(n[i])) for i in range(3)]


def _avg(arr):
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.size(arr)


def _steps(grid: DataFrame, fields, keys=tuple(KEY)) -> DataFrame:
    """Per series: its future steps as an array ordered by horizon (<= days items)."""
    return grid.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("_steps"))


def forecast_v5_iterative(panel: DataFrame, seasonal: DataFrame, factors: DataFrame, days: int,
                          weather: DataFrame | None = None,
                          damping: float = C.V5_DOW_DAMPING, served: DataFrame | None = None, model=None,
                          origins: DataFrame | None = None, keys=tuple(KEY)) -> DataFrame:
    """M12 + M13: each day's rounded forecast feeds the next day's lags and means. ``model`` is a
    trained predictor (``v5.Recursion``), None the stand-in. Series outside ``served`` get their seasonal mean
    (0 without one) as forecast and quantiles, which feeds on unrounded. ``origins`` and ``keys`` as in ``forecast_direct``.

    Sequential in days, parallel in series: the whole recursion runs inside one
    ``aggregate`` over each series' step array, whose state is the last 14 values
    (bounded), so there is no driver loop and no per-series job."""
    origin = latest_origin(panel, C.V5_MIN_HISTORY) if origins is None else origins.where(F.col("_n") >= C.V5_MIN_HISTORY)
    grid = future_grid(origin, days)
    if weather is not None:
        from faultline.operators.weather import lookup_weather
        grid = lookup_weather(grid, weather)
    else:
        grid = grid.withColumn("es_lluvia_fuerte", F.lit(0))
    grid = mark_served(attach_stats(grid, seasonal, factors, keys), served)
    if model is not None:
        grid = model.grid(grid)
    risky = ((F.col("es_lluvia_fuerte") == 1) | (F.col("es_quincena") == 1)
             | (F.col("es_lunes") == 1))
    steps = _steps(grid, [F.col("Horizonte").alias("h"), F.col("Fecha").alias("f"),
                          F.col("dow_factor").alias("k"), F.col("seasonal").alias("s"),
                          risky.alias("r"), F.col("_served").alias("m"), *[F.col(c) for c in (model.fields if model else ())]], keys)
    state0 = origin.select(*keys, "_win").join(steps, list(keys))
    if model is not None:
        state0 = model.state(state0)
    out_t = "array<struct<Fecha:date,Prediccion_Tickets:bigint,Pred_Q30:bigint,Pred_Q50:bigint,Pred_Q70:bigint>>"

    def step(acc, s):
        w = acc["win"]
        ma7 = _avg(F.slice(w, -7, 7))
        ma14 = _avg(F.slice(w, -14, 14))
        found = F.array(F.least(ma7, ma14), ma7, F.greatest(ma7, ma14)) if model is None else model.quantiles(w, s, ma7, ma14)
        seas = F.coalesce(s["s"], F.lit(0.0))
        a, b, c = v5_blend_weights(s["r"])

        def own(x, p):
            return F.coalesce(F.when(s["m"] & p[1].isNotNull(), x), seas)

        def rounded(p):
            final = blend(a * p[0] + b * p[1] + c * p[2], s["k"], s["s"], damping)
            return F.struct(p.alias("p"), own(F.greatest(F.lit(0.0), F.bround(final, 0)), p).alias("fr"))

        def row(v):
            p, fr = v["p"], v["fr"]
            out = F.struct(s["f"].alias("Fecha"), nonneg_round(fr).alias("Prediccion_Tickets"), nonneg_round(own(p[0], p)).alias("Pred_Q30"),
                           nonneg_round(own(p[1], p)).alias("Pred_Q50"), nonneg_round(own(p[2], p)).alias("Pred_Q70"))
            return F.struct(F.slice(F.concat(w, F.array(fr)), -14, 14).alias("win"), F.concat(acc["out"], F.array(out)).alias("out"))

        return bound(bound(found, rounded), row)

    init = F.struct(F.col("_win").alias("win"), F.array().cast(out_t).alias("out"))
    res = state0.select(*keys, F.aggregate("_steps", init, step, lambda acc: acc["out"]).alias("_o"))
    return res.select(*keys, F.inline("_o")).select(*[k for k in keys if k not in V5_COLUMNS], *V5_COLUMNS)


def forecast_v1_recursive(panel: DataFrame, days: int, y: str = "Tickets_Total", model=None) -> DataFrame:
    """v1 recursion, with ``model`` (``v5.RecursionV1``) or the stand-in (mean of the previous
    up-to-7 values); future dates start the day after the *global* last date, for every pair."""
    last = panel.agg(F.max("Fecha")).first()[0]
    w = Window.partitionBy(*KEY).orderBy("Fecha")
    hist = (panel.select(*KEY, "Fecha", y)
            .withColumn("_win", F.collect_list(F.col(y).cast("double")).over(w.rowsBetween(-13, 0)))
            .withColumn("_rn", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("Fecha"))))
            .filter("_rn = 1").select(*KEY, "_win"))
    if model is not None:
        hist = model.state(hist)
    dates = F.transform(F.sequence(F.lit(1), F.lit(days)), lambda h: F.date_add(F.lit(last), h))
    out_t = "array<struct<Fecha:date,Prediccion_Tickets:bigint>>"

    def step(acc, d):
        w_ = acc["win"]
        k = F.least(F.size(w_), F.lit(7))
        p = _avg(F.slice(w_, -k, k)) if model is None else model.point(w_, d)
        fr = F.greatest(F.lit(0.0), F.bround(p, 0))
        return F.struct(F.slice(F.concat(w_, F.array(fr)), -14, 14).alias("win"),
                        F.concat(acc["out"], F.array(F.struct(
                            d.alias("Fecha"), fr.cast("long").alias("Prediccion_Tickets")))).alias("out"))

    init = F.struct(F.col("_win").alias("win"), F.array().cast(out_t).alias("out"))
    res = hist.select(*KEY, F.aggregate(dates, init, step, lambda acc: acc["out"]).alias("_o"))
    return res.select(*KEY, F.inline("_o")).select(*FORECAST_COLUMNS)


def model_predictor(model, out: str = "_p", te: DataFrame | None = None):
    """Adapter: a fitted quantile model (``operators.quantile``) as the base predictor
    of the direct forecasts. Origin features are there under their V4 names and, without
    ``_origin``, under the V5 ones; ``te`` adds the series' target encodings (0 where a
    series has none)."""
    def run(grid: DataFrame) -> DataFrame:
        if te is not None:
            grid = grid.join(te, KEY, "left").fillna(0.0, subset=["nodo_target_mean", "nodo_target_std"])
        origin = [c for c in grid.columns if c.endswith("_origin")]
        return model.predict(grid.withColumns({c.removesuffix("_origin"): F.col(c) for c in origin}), out)
    return run
