"""Trained demand models: V4 and V5 per segment (M9, M11), their forecasts (M10, M12-M14), the
v1 model and its recursion (M8, M15), and the bundle store (M19).

A segment is a zone, or in ``node_zone`` a single node, which needs 30 samples. All segments and
quantiles, V4's and V5's, are one boosting run (``boosting.fit``): the number of jobs does not grow
with them. A model is data (arrays of trees) joined to the rows of its segment, so the recursive forecasts
score it inside the ``aggregate`` over each series' steps: one plan, no driver loop.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline import config as C
from faultline.functions import calendar_columns
from faultline.operators import boosting, forecast, samples, stats
from faultline.operators.weather import FEATURES as WEATHER_FEATURES
from faultline.operators.weather import lookup_weather

KEY = ["Zona", "Nodo"]
V5_FEATURES = ["Dia_Semana", "Mes", "Horizonte", "Lag_1", "Lag_7", "Media_Movil_7d", "Media_Movil_14d",
               "es_festivo", "es_quincena", "semana_del_mes", "dia_del_mes", "es_lunes", "es_viernes",
               "es_finsemana", *WEATHER_FEATURES, "nodo_target_mean", "nodo_target_std"]
V1_FEATURES = ["Dia_Semana", "Mes", "Lag_1", "Lag_7", "Media_Movil_7d", "Media_Movil_14d"]
STATE = ["Horizonte", "Lag_1", "Lag_7", "Media_Movil_7d", "Media_Movil_14d"]
RENAME = {"Lag_1_origin": "Lag_1", "Lag_7_origin": "Lag_7", "Media_Movil_7d_origin": "Media_Movil_7d",
          "Media_Movil_14d_origin": "Media_Movil_14d"}


def segment_of(node_zone: str = C.CENTRO) -> Column:
    """A row's segment: its zone, in ``node_zone`` its node."""
    return F.when(F.col("Zona") == node_zone, F.concat_ws("/", "Zona", "Nodo")).otherwise(F.col("Zona"))


def values_of(panel: DataFrame, columns: list) -> dict:
    """The distinct values of each column, as many as the one-hot features of a model."""
    return {c: sorted(r[0] for r in panel.select(c).distinct().collect() if r[0] is not None) for c in columns}


def one_hot(values: dict) -> dict:
    """Indicator columns of the values: name -> Column."""
    return {f"{c}_{v}": (F.col(c) == v).cast("double") for c, vs in values.items() for v in vs}


def training_frame(panel: DataFrame, weather: DataFrame | None, te: DataFrame, span_days: int | None = None) -> DataFrame:
    """Direct samples (J10), all of them or the targets of the last ``span_days`` days, with calendar
    (P18), weather (J8) and target encoding (J7) features."""
    s = samples.direct_samples(panel)
    if span_days is not None:
        hi = panel.agg(F.max("Fecha")).first()[0]
        s = s.filter(F.col("Fecha") > F.date_sub(F.lit(hi), span_days))
    s = s.withColumnsRenamed(RENAME).withColumns(calendar_columns("Fecha"))
    return _encoded(_weathered(s, weather), te)


def _weathered(df: DataFrame, weather: DataFrame | None) -> DataFrame:
    return lookup_weather(df, weather) if weather is not None else df.withColumns({c: F.lit(0.0) for c in WEATHER_FEATURES})


def _encoded(df: DataFrame, te: DataFrame) -> DataFrame:
    return df.join(te, KEY, "left").fillna(0.0, subset=["nodo_target_mean", "nodo_target_std"])


@dataclass
class Bundle:
    """What a forecast needs: models (rows of ``boosting.MODEL_DDL``), statistics, parameters."""
    models: DataFrame
    features: list
    values: dict
    node_zone: str
    te: DataFrame
    seasonal: DataFrame
    factors: DataFrame
    fitted: object = None


def train(panel: DataFrame, weather: DataFrame | None = None, rounds: int = 100, depth: int = 3, rate: float = 0.1,
          subsample: float = 0.8, node_zone: str = C.CENTRO, v4: bool = True, v5: bool = True, span_days: int | None = None, **more) -> Bundle:
    """M9 + M11: V4 (alpha 0.6; one-hot nodes) and V5 (0.3 / 0.5 / 0.7; target encoding) for every
    segment in one fit. ``more`` goes to every ``boosting.Spec``."""
    te = stats.target_encoding(panel)
    values = values_of(panel, ["Nodo"]) if v4 else {}
    frame = training_frame(panel, weather, te, span_days).withColumns(one_hot(values) | {"_segment": segment_of(node_zone)})
    shape = dict(objective="pinball", rounds=rounds, depth=depth, rate=rate, subsample=subsample) | more
    plain = [f for f in V5_FEATURES if not f.startswith("nodo_target")]
    specs = [boosting.Spec("v4", alpha=C.V4_QUANTILE_ALPHA, only=(*plain, *one_hot(values)), **shape)] if v4 else []
    specs += [boosting.Spec(q, alpha=a, only=tuple(V5_FEATURES), **shape) for q, a in C.V5_QUANTILES.items()] if v5 else []
    features = [*V5_FEATURES, *one_hot(values)]
    fitted = boosting.fit(frame, features, specs, "Tickets_Total", "_segment", least={f"{node_zone}/": C.MIN_SEGMENT_SAMPLES})
    return Bundle(fitted.frame(panel.sparkSession), features, values, node_zone, te, stats.seasonal_means(panel), stats.dow_factors(panel), fitted)


def direct_predictor(bundle: Bundle, spec: str, out: str):
    """The model of a spec as the base predictor of ``forecast.forecast_direct``; a series whose segment
    has no model gets null, and there the seasonal mean."""
    def run(grid: DataFrame) -> DataFrame:
        g = _encoded(grid, bundle.te).withColumns({new: F.col(old) for old, new in RENAME.items()}).withColumns(one_hot(bundle.values))
        g = g if set(WEATHER_FEATURES) <= set(g.columns) else _weathered(g, None)
        g = boosting.attach(g, bundle.models.where(F.col("spec") == spec), segment_of(bundle.node_zone))
        return g.withColumn(out, boosting.scored([F.col(f"m_{spec}")], boosting.vector(bundle.features))[0])
    return run


class Recursion:
    """The V5 quantile models inside the recursion of ``forecast.forecast_v5_iterative``."""

    def __init__(self, bundle: Bundle):
        self.bundle = bundle
        self.fields = [c for c in V5_FEATURES if c not in STATE]

    def grid(self, grid: DataFrame) -> DataFrame:
        grid = grid if set(WEATHER_FEATURES) <= set(grid.columns) else _weathered(grid.drop("es_lluvia_fuerte"), None)
        return _encoded(grid, self.bundle.te)

    def state(self, state: DataFrame) -> DataFrame:
        return boosting.attach(state, self.bundle.models.where(F.col("spec").isin(*C.V5_QUANTILES)), segment_of(self.bundle.node_zone))

    def quantiles(self, win, step, mean_7, mean_14) -> Column:
        now = {c: step[c] for c in self.fields} | {"Horizonte": step["h"], "Lag_1": F.element_at(win, -1), "Lag_7": F.element_at(win, -7),
                                                   "Media_Movil_7d": mean_7, "Media_Movil_14d": mean_14}
        x = boosting.vector(self.bundle.features, {c: now.get(c, F.lit(None)) for c in self.bundle.features})
        return boosting.scored([F.col(f"m_{q}") for q in C.V5_QUANTILES], x)


def forecast_v4_model(panel: DataFrame, bundle: Bundle, days: int, weather: DataFrame | None = None) -> DataFrame:
    """M10 by the trained V4 models."""
    return forecast.forecast_v4(panel, bundle.seasonal, bundle.factors, days, direct_predictor(bundle, "v4", "_p"), weather)


def forecast_v5_model(panel: DataFrame, bundle: Bundle, days: int, weather: DataFrame | None = None) -> DataFrame:
    """M12 + M13 by the trained V5 models; a segment without one takes the seasonal mean."""
    return forecast.forecast_v5_iterative(panel, bundle.seasonal, bundle.factors, days, weather, model=Recursion(bundle))


def forecast_v5_direct_model(panel: DataFrame, bundle: Bundle, days: int, weather: DataFrame | None = None) -> DataFrame:
    """M14 by the trained V5 median models."""
    return forecast.forecast_v5_direct(panel, bundle.seasonal, bundle.factors, days, direct_predictor(bundle, "q50", "_p50"), weather)


# -- v1 ---------------------------------------------------------------------------------

class RecursionV1:
    """The v1 model inside the recursion of ``forecast.forecast_v1_recursive``."""

    def __init__(self, models: DataFrame, features: list, values: dict):
        self.models, self.features, self.values = models, features, values

    def state(self, state: DataFrame) -> DataFrame:
        return boosting.attach(state.withColumns(one_hot(self.values)), self.models, F.lit("all"))

    def point(self, win, day) -> Column:
        def mean(k):
            last = F.slice(win, -F.least(F.size(win), F.lit(k)), F.lit(k))
            return F.aggregate(last, F.lit(0.0), lambda a, x: a + x) / F.size(last)
        now = {"Dia_Semana": F.weekday(day), "Mes": F.month(day), "Lag_1": F.element_at(win, -1), "Lag_7": F.element_at(win, -F.least(F.size(win), F.lit(7))),
               "Media_Movil_7d": mean(7), "Media_Movil_14d": mean(14)}
        x = boosting.vector(self.features, {f: now[f] if f in now else F.col(f"`{f}`") for f in self.features})
        return boosting.scored([F.col("m_v1")], x)[0]


def train_v1(panel: DataFrame, rounds: int = 100, depth: int = 4, rate: float = 0.1, subsample: float = 0.8, **more) -> RecursionV1:
    """M8: one squared-error model over all series: zone and node one-hot and six panel features."""
    values = values_of(panel, KEY)
    features = [*V1_FEATURES, *one_hot(values)]
    spec = boosting.Spec("v1", rounds=rounds, depth=depth, rate=rate, subsample=subsample, **more)
    fitted = boosting.fit(panel.withColumns(one_hot(values)), features, [spec], "Tickets_Total")
    return RecursionV1(fitted.frame(panel.sparkSession), features, values)


# -- store ------------------------------------------------------------------------------

def save_bundle(bundle: Bundle, path: str) -> str:
    """A new version of models and statistics under ``path``. Its line in the manifest is
    written last, by Spark's committing writer, so a half-written version is never read."""
    spark = bundle.models.sparkSession
    version = uuid.uuid4().hex
    for name in ("models", "te", "seasonal", "factors"):
        getattr(bundle, name).write.parquet(f"{path}/versions/{version}/{name}")
    row = [(version, bundle.features, list(bundle.values.items()), bundle.node_zone)]
    line = spark.createDataFrame(row, "version string, features array<string>, values array<struct<name:string,items:array<string>>>, node_zone string")
    line.withColumn("published", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def load_bundle(spark: SparkSession, path: str, version: str | None = None) -> Bundle:
    """The latest published version, or the named one."""
    lines = spark.read.parquet(f"{path}/manifest")
    line = (lines if version is None else lines.where(F.col("version") == version)).orderBy(F.desc("published"), "version").first()
    if line is None:
        raise ValueError(f"no published version under {path}")
    tables = {n: spark.read.parquet(f"{path}/versions/{line['version']}/{n}") for n in ("models", "te", "seasonal", "factors")}
    return Bundle(features=line["features"], values={r["name"]: r["items"] for r in line["values"]}, node_zone=line["node_zone"], **tables)
