"""Per-series statistics: seasonal mean (D5), weekday factor (D6), smoothed target
encoding (D7), calendar flags on a frame (P18)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline import config as C
from faultline.functions import calendar_columns

KEY = ["Zona", "Nodo"]


def seasonal_means(df: DataFrame, y: str = "Tickets_Total") -> DataFrame:
    """Mean of y by (Zona, Nodo, weekday)."""
    return (df.groupBy(*KEY, F.weekday("Fecha").alias("dow"))
            .agg(F.avg(y).alias("seasonal")))


def dow_factors(df: DataFrame, y: str = "Tickets_Total") -> DataFrame:
    """mean(weekday) / mean(all) per series; 1.0 where the overall mean <= 0.
    The overall mean is rebuilt from the weekday sums (<= 7 rows per series)."""
    by = (df.groupBy(*KEY, F.weekday("Fecha").alias("dow"))
          .agg(F.sum(y).alias("_s"), F.count(y).alias("_c")))
    w = Window.partitionBy(*KEY)
    overall = F.sum("_s").over(w) / F.sum("_c").over(w)
    mean_d = F.col("_s") / F.col("_c")
    return (by.withColumn("_all", overall)
            .select(*KEY, "dow", F.when(F.col("_all") > 0, mean_d / F.col("_all"))
                    .otherwise(F.lit(1.0)).alias("dow_factor")))


def stats_at(panel: DataFrame, cutoffs, y: str = "Tickets_Total") -> tuple[DataFrame, DataFrame]:
    """D5 and D6 as of many cutoffs, from one aggregation: (seasonal means, weekday factors), both keyed by Split too.
    ``cutoffs``: (Split, Corte) pairs; a cutoff's training rows are those on or before Corte. Every row is summed
    once, into the first cutoff that covers it, and a running sum over the cutoffs of a (series, weekday) gives the
    statistics; a cutoff without rows of its own is filled up first, so each has every earlier weekday."""
    order = sorted(cutoffs, key=lambda x: x[1])
    steps = F.array(*[F.lit(c).cast("date") for _, c in order])
    first = F.size(F.filter(steps, lambda c: c < F.col("Fecha")))  # the number of cutoffs that end before the row
    own = panel.withColumn("_at", first).where(F.col("_at") < len(order)).groupBy(*KEY, F.weekday("Fecha").alias("dow"), "_at").agg(
        F.sum(y).alias("_s"), F.count(y).alias("_c"))
    each = own.groupBy(*KEY, "dow").agg(F.collect_list(F.struct("_at", "_s", "_c")).alias("_parts"), F.min("_at").alias("_from"))
    upto = each.withColumn("_k", F.explode(F.sequence(F.col("_from"), F.lit(len(order) - 1))))

    def total(field, kind):
        seen = F.filter("_parts", lambda p: p["_at"] <= F.col("_k"))
        return F.aggregate(seen, F.lit(0).cast(kind), lambda acc, p: acc + F.coalesce(p[field], F.lit(0)).cast(kind))

    kind = own.schema["_s"].dataType.simpleString()
    names = F.array(*[F.lit(s) for s, _ in order])
    by = upto.select(F.get(names, F.col("_k")).alias("Split"), *KEY, "dow", total("_s", kind).alias("_s"), total("_c", "long").alias("_c"))
    w = Window.partitionBy("Split", *KEY)
    overall, mean_d = F.sum("_s").over(w) / F.sum("_c").over(w), F.col("_s") / F.col("_c")
    factors = by.withColumn("_all", overall).select("Split", *KEY, "dow", F.when(F.col("_all") > 0, mean_d / F.col("_all")).otherwise(F.lit(1.0)).alias("dow_factor"))
    return by.select("Split", *KEY, "dow", mean_d.alias("seasonal")), factors


def global_mean(df: DataFrame, y: str = "Tickets_Total") -> float:
    """Driver scalar: the mean of y over all rows."""
    return df.agg(F.avg(y)).first()[0]


def target_encoding(df: DataFrame, y: str = "Tickets_Total", k: float = C.TARGET_SMOOTH,
                    prior: float | None = None) -> DataFrame:
    """(n*mean + k*global)/(n + k) and the sample std (NULL -> 0) per series."""
    g = global_mean(df, y) if prior is None else prior
    a = df.groupBy(*KEY).agg(F.avg(y).alias("_m"), F.stddev_samp(y).alias("_sd"),
                             F.count(y).alias("_n"))
    return a.select(*KEY,
                    ((F.col("_n") * F.col("_m") + F.lit(k) * F.lit(g)) / (F.col("_n") + F.lit(k)))
                    .alias("nodo_target_mean"),
                    F.coalesce(F.col("_sd"), F.lit(0.0)).alias("nodo_target_std"))


def add_calendar(df: DataFrame, date_col: str = "Fecha", holidays=None) -> DataFrame:
    """P18 flags for every row; ``holidays``: dates (None: the fixed list)."""
    return df.withColumns(calendar_columns(date_col, holidays))


def out_of_fold_encoding(df: DataFrame, cats, label: str, fold: str = "fold", least: float = 20.0, slope: float = 10.0) -> DataFrame:
    """M3: adds ``<cat>_te`` for each category column: the label's mean over the category's rows of all other
    folds, blended with those folds' overall mean by the weight 1 / (1 + exp(-(n - least) / slope)). Sums of a
    category and of a fold come from one aggregate of (category, fold) rows; own sums are taken off the
    totals, so no row is encoded by its own label. A category met in its own fold only gets the prior."""
    out = df
    for c in cats:
        part = df.groupBy(F.col(c).alias("_cat"), F.col(fold).alias("_fold")).agg(F.sum(label).cast("double").alias("_s"), F.count(label).alias("_n"))
        whole = Window.partitionBy("_cat")
        totals = part.groupBy("_fold").agg(F.sum("_s").alias("_fs"), F.sum("_n").alias("_fn"))
        every = totals.agg(F.sum("_fs").alias("_as"), F.sum("_fn").alias("_an"))
        prior = totals.crossJoin(F.broadcast(every)).select("_fold", ((F.col("_as") - F.col("_fs")) / F.nullif(F.col("_an") - F.col("_fn"), F.lit(0))).alias("_prior"))
        rest = part.withColumns({"_rs": F.sum("_s").over(whole) - F.col("_s"), "_rn": F.sum("_n").over(whole) - F.col("_n")}).join(prior, "_fold")
        weight = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("_rn") - F.lit(least)) / F.lit(slope)))
        value = F.when(F.col("_rn") > 0, F.col("_prior") * (F.lit(1.0) - weight) + F.col("_rs") / F.col("_rn") * weight).otherwise(F.col("_prior"))
        rest = rest.select("_cat", "_fold", value.alias(f"{c}_te"))
        out = out.join(rest, F.col(c).eqNullSafe(F.col("_cat")) & F.col(fold).eqNullSafe(F.col("_fold")), "left").drop("_cat", "_fold")
    return out
