"""M18 (re-aimed): one linear autoregression per zone over its last seven days, all zones at once.

The normal equations of every zone come from one aggregation of products. They are kept exact: demand is whole
numbers, and n * sum(xy) - sum(x) * sum(y) is taken in decimals, so no digits are lost before the only division. The
seven equations of a zone are solved by elimination inside one row's expression. Min-max scaling (W7) is left out of
the arithmetic: least squares with an intercept gives the same forecast for any linear scaling of a zone's demand.

Cases: a zone with fewer than eight days has no row; a lag that tells nothing beside the ones before it (constant demand, say)
gets the coefficient 0; null demand counts as no row of the day.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions import demand_alert
from faultline.operators.boosting import bound

LAGS = 7
#: a pivot under this share of its first value counts as zero
TOLERANCE = 1e-9


def lagged(zd: DataFrame, y: str = "Tickets_Total", lags: int = LAGS) -> DataFrame:
    """Zona, Fecha, y, x1 .. x7 (yesterday first) of every day of a zone with a full week before it."""
    w = Window.partitionBy("Zona").orderBy("Fecha")
    rows = zd.where(F.col(y).isNotNull()).select("Zona", "Fecha", F.col(y).cast("long").alias("y"), *[
        F.lag(y, k).over(w).cast("long").alias(f"x{k}") for k in range(1, lags + 1)])
    return rows.where(F.col(f"x{lags}").isNotNull())


def coefficients(rows: DataFrame, lags: int = LAGS) -> DataFrame:
    """Zona, n (days fitted), b0 (intercept), b1 .. b7 by least squares over the rows of ``lagged``."""
    names = [f"x{k}" for k in range(1, lags + 1)]
    wide = {c: F.col(c).cast("decimal(19,0)") for c in [*names, "y"]}
    sums = [F.sum(c).cast("decimal(19,0)").alias(f"s_{c}") for c in [*names, "y"]]
    products = [F.sum((wide[a] * wide[b]).cast("decimal(28,0)")).cast("decimal(19,0)").alias(f"p_{a}_{b}")
                for i, a in enumerate(names) for b in [*names[i:], "y"]]
    zone = rows.groupBy("Zona").agg(F.count(F.lit(1)).alias("n"), *sums, *products)
    n = F.col("n").cast("decimal(19,0)")

    def centred(a, b):
        pair = f"p_{a}_{b}" if b == "y" or int(a[1:]) <= int(b[1:]) else f"p_{b}_{a}"
        return (n * F.col(pair) - F.col(f"s_{a}") * F.col(f"s_{b}")).cast("double")

    matrix = F.array(*[F.array(*[centred(a, b) for b in [*names, "y"]]) for a in names])
    zone = zone.withColumn("_m", matrix)

    def eliminate(acc, k):
        def clear(pivot):
            return F.transform(acc, lambda r, i: F.when(i == k, pivot).otherwise(
                F.zip_with(r, pivot, lambda x, p: x - F.get(r, k) * p)))

        row = F.get(acc, k)
        at = F.get(row, k)
        useful = at > F.lit(TOLERANCE) * F.get(F.get(F.col("_m"), k), k)
        return bound(F.transform(row, lambda x: F.when(useful, x / at).otherwise(F.lit(0.0))), clear)

    solved = zone.withColumn("_b", F.transform(F.aggregate(F.sequence(F.lit(0), F.lit(lags - 1)), F.col("_m"), eliminate), lambda r: F.get(r, F.lit(lags))))
    slopes = [F.get("_b", F.lit(k)) for k in range(lags)]
    b0 = F.col("s_y").cast("double")
    for name, b in zip(names, slopes):
        b0 = b0 - b * F.col(f"s_{name}").cast("double")
    return solved.select("Zona", "n", (b0 / F.col("n")).alias("b0"), *[b.alias(f"b{k}") for k, b in enumerate(slopes, 1)])


def _point(b, xs):
    """b: intercept and coefficients, xs: the last values, yesterday first."""
    total = b[0]
    for coefficient, x in zip(b[1:], xs):
        total = total + coefficient * x
    return total


def predict(rows: DataFrame, fitted: DataFrame, lags: int = LAGS) -> DataFrame:
    """``rows`` of ``lagged`` with Pred, the one-day forecast by the zone's coefficients."""
    b = [F.col(f"b{k}") for k in range(lags + 1)]
    return rows.join(fitted.drop("n"), "Zona").withColumn("Pred", _point(b, [F.col(f"x{k}") for k in range(1, lags + 1)])).select(*rows.columns, "Pred")


def weekly_forecast(zd: DataFrame, days: int = 7, y: str = "Tickets_Total", lags: int = LAGS) -> DataFrame:
    """Zona, Fecha, Volumen, Media_Zona, Alerta of the ``days`` days after the last date of all zones: each day's unrounded
    forecast is the next day's first lag; the volume is cut to a whole number, never negative, and graded against the
    zone's mean demand (P22). The recursion is one expression over the steps, parallel in zones."""
    fitted = coefficients(lagged(zd, y, lags), lags)
    newest = Window.partitionBy("Zona").orderBy(F.desc("Fecha"))
    seen = zd.where(F.col(y).isNotNull()).withColumn("_rn", F.row_number().over(newest))
    zone = seen.groupBy("Zona").agg(
        F.avg(y).alias("Media_Zona"), F.max("Fecha").alias("_last"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_rn") <= lags, F.struct("_rn", F.col(y).cast("double").alias("v"))))), lambda s: s["v"]).alias("_win"))
    last = zone.agg(F.max("_last").alias("_end"))
    b = [F.col(f"b{k}") for k in range(lags + 1)]

    def step(acc, _):
        value = _point(b, [F.get(acc, F.lit(k)) for k in range(lags)])
        return F.concat(F.array(value), acc)

    steps = F.aggregate(F.sequence(F.lit(1), F.lit(days)), F.col("_win"), step)
    ahead = F.reverse(F.slice(steps, 1, days))
    out = zone.join(fitted, "Zona").crossJoin(F.broadcast(last)).select("Zona", "Media_Zona", "_end", F.posexplode(ahead).alias("_h", "_p"))
    volume = F.greatest(F.lit(0).cast("long"), F.col("_p").cast("long"))
    return out.select("Zona", F.date_add("_end", F.col("_h") + 1).alias("Fecha"), volume.alias("Volumen"), "Media_Zona",
                      demand_alert(volume.cast("double"), F.col("Media_Zona")).alias("Alerta"))
