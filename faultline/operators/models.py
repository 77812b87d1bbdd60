"""pyspark.ml models: SLA breach classifier (M1, M3-M5, D26), resolution-time
regressor (M2), feature importances (K5), ticket scoring (M17), weekly zone
autoregression (M18) and persistence (M19)."""
from __future__ import annotations

import functools
import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexer, TargetEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions import sla_risk_tier
from faultline.operators.splits import hashed_folds
from faultline.session import landed

SLA_CATEGORICALS = ["Prioridad", "CENTRAL", "SUEPERVISOR"]
REGRESSOR_CATEGORICALS = ["Prioridad", "Nodo", "Tipo_Falla"]
REGRESSOR_NUMERIC = ["Usuarios_Afectados", "Hora_sin", "Hora_cos", "Dia_sin", "Dia_cos"]
#: FIXED VALUES: the source's search space of M1 and M2 and its range of trees
SEARCH_SPACE = {"maxDepth": (3, 9, "int"), "stepSize": (0.01, 0.2, "log"), "subsamplingRate": (0.6, 1.0, "float")}
SEARCH_TREES = (50, 300)


def encoded_stages(cats, label: str, target_type: str):
    """M3: StringIndexer then TargetEncoder, inside the pipeline so every CV fold fits
    its own encoding (decision Q13: no leakage from the held-out rows)."""
    idx = [f"_{c}_idx" for c in cats]
    enc = [f"_{c}_te" for c in cats]
    num = [f"_{c}_num" for c in cats]
    # the encoder keeps the indexer's nominal metadata; re-derive plain numeric columns
    # so the trees split them as continuous values
    strip = SQLTransformer(statement="SELECT *, " + ", ".join(
        f"`{e}` + 0.0 AS `{n}`" for e, n in zip(enc, num)) + " FROM __THIS__")
    return ([StringIndexer(inputCols=cats, outputCols=idx, handleInvalid="keep"),
             TargetEncoder(inputCols=idx, outputCols=enc, labelCol=label, targetType=target_type,
                           smoothing=1.0, handleInvalid="keep"), strip], num)


def random_grid(est, space: dict, n: int, seed: int = 42):
    """M4: a seeded random sample of ``n`` points from the search space."""
    rng = random.Random(seed)
    maps = []
    for _ in range(n):
        pm = {}
        for param, (lo, hi, kind) in space.items():
            p = est.getParam(param)
            if kind == "int":
                pm[p] = rng.randint(lo, hi)
            elif kind == "log":
                import math
                pm[p] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            else:
                pm[p] = rng.uniform(lo, hi)
        maps.append(pm)
    return maps


def search_grid(est, n: int, trees, seed: int = 42):
    """M4: ``n`` points of the search space; ``trees`` is the range of trees to draw from, or a number for all points."""
    if isinstance(trees, int):
        return [{est.maxIter: trees, **pm} for pm in random_grid(est, SEARCH_SPACE, n, seed)]
    return random_grid(est, {**SEARCH_SPACE, "maxIter": (*trees, "int")}, n, seed)


def cross_validated(pipe: Pipeline, grid: list, ev, data: DataFrame, folds: int, parallelism: int | None = None) -> PipelineModel:
    """M4: every point fitted on every fold of ``cvfold`` and judged on the rows held out, then the point with the best
    mean fitted on all rows. All points x folds are one queue, longest first, so that no fold waits for the slowest
    fit of another. Without ``parallelism`` as many run at once as fill the cores: a fit of few partitions is
    bound by the latency of its many small jobs."""
    parts = []
    if parallelism is None:
        parallelism = max(2, 2 * data.sparkSession.sparkContext.defaultParallelism // max(1, data.rdd.getNumPartitions()))
    try:
        for k in range(folds):
            parts.append((data.filter(F.col("cvfold") != k).cache(), data.filter(F.col("cvfold") == k).cache()))
            if any(p.isEmpty() for p in parts[-1]):
                raise ValueError(f"fold {k} has no rows to train on or none held out")

        def judged(job):
            i, k = job
            return ev.evaluate(pipe.fit(parts[k][0], grid[i]).transform(parts[k][1]))

        def length(job):
            return -np.prod([v for p, v in grid[job[0]].items() if p.name in ("maxIter", "maxDepth")])

        jobs = sorted([(i, k) for i in range(len(grid)) for k in range(folds)], key=length)
        # each with local properties of its own, which the fits' jobs write to
        tasks = [inheritable_thread_target(data.sparkSession)(functools.partial(judged, job)) for job in jobs]
        pool = ThreadPoolExecutor(min(parallelism, len(jobs)))
        try:
            found = dict(zip(jobs, pool.map(lambda task: task(), tasks)))
        finally:
            pool.shutdown(cancel_futures=True)
    finally:
        for p in (p for pair in parts for p in pair):
            p.unpersist()
    means = [np.mean([found[i, k] for k in range(folds)]) for i in range(len(grid))]
    return pipe.fit(data, grid[int(np.argmax(means) if ev.isLargerBetter() else np.argmin(means))])


def row_key(df: DataFrame, id_col: str):
    """A key that a re-plan or retry does not change: the id column where there is one, else a
    hash of all columns (equal rows then share a fold)."""
    return F.col(id_col) if id_col in df.columns else F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def train_sla_classifier(sla: DataFrame, trials: int = 10, folds: int = 3, max_iter=SEARCH_TREES,
                         seed: int = 42, parallelism: int | None = None):
    """M1: target-encoded categoricals, class weight n(0)/n(1) on the positive class,
    stratified hashed folds, random search on weighted F1 (over the number of trees too, where
    ``max_iter`` is a range), then an 80/20 report. Returns (fitted PipelineModel, report DataFrame)."""
    from faultline.operators.reports import label_balance
    sla = landed(sla, "sla")  # every stage, fold and trial reads the rows anew
    w = label_balance(sla).first()["Peso_Clase"]
    data = sla.withColumn("_w", F.when(F.col("Target") == 1, F.lit(float(w))).otherwise(F.lit(1.0)))
    data = hashed_folds(data.withColumn("_rid", row_key(data, "event_id")), ["_rid"], 5, seed, label="Target")
    data = data.select(*SLA_CATEGORICALS, "Target", "_w", "_rid", "fold")
    train, test = data.filter("fold <> 0"), data.filter("fold = 0")
    enc_stages, enc = encoded_stages(SLA_CATEGORICALS, "Target", "binary")
    gbt = GBTClassifier(featuresCol="_x", labelCol="Target", weightCol="_w", seed=seed)
    pipe = Pipeline(stages=enc_stages + [VectorAssembler(inputCols=enc, outputCol="_x"), gbt])
    grid = search_grid(gbt, trials, max_iter, seed)
    ev = MulticlassClassificationEvaluator(labelCol="Target", metricName="weightedFMeasure")
    train = train.withColumn("cvfold", F.pmod(F.xxhash64("_rid", F.lit(seed + 1)), F.lit(folds)).cast("int"))
    model = cross_validated(pipe, grid, ev, train, folds, parallelism)
    return model, classification_report(model.transform(test))


def classification_report(pred: DataFrame, label: str = "Target") -> DataFrame:
    """Per-class precision / recall / F1 / support and the weighted F1, from
    confusion counts (a 2x2 aggregate)."""
    c = pred.groupBy(F.col(label).cast("int").alias("y"), F.col("prediction").cast("int").alias("p")) \
        .agg(F.count(F.lit(1)).alias("n"))
    tp = c.filter("y = p").groupBy("y").agg(F.sum("n").alias("tp"))
    sup = c.groupBy("y").agg(F.sum("n").alias("support"))
    pp = c.groupBy(F.col("p").alias("y")).agg(F.sum("n").alias("pred_pos"))
    r = sup.join(tp, "y", "left").join(pp, "y", "left").fillna(0)
    r = r.withColumns({"precision": F.when(F.col("pred_pos") > 0, F.col("tp") / F.col("pred_pos")).otherwise(0.0),
                       "recall": F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)})
    r = r.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                  2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                     .otherwise(0.0))
    tot = Window.partitionBy()
    return r.withColumn("weighted_f1", F.sum(F.col("f1") * F.col("support")).over(tot) / F.sum("support").over(tot)) \
        .select(F.col("y").alias("clase"), "precision", "recall", "f1", "support", "weighted_f1")


def train_resolution_regressor(tickets: DataFrame, trials: int = 10, folds: int = 3,
                               max_iter=SEARCH_TREES, seed: int = 42, parallelism: int | None = None):
    """M2: 8 features (categoricals target-encoded), random search with 3-fold CV on
    MAE (over the number of trees too, where ``max_iter`` is a range), then MAE / RMSE on a
    hashed 80/20 split. Returns (model, metrics)."""
    cats = [c for c in REGRESSOR_CATEGORICALS if c in tickets.columns]
    nums = [c for c in REGRESSOR_NUMERIC if c in tickets.columns]
    data = tickets.withColumn("_rid", row_key(tickets, "event_id")).select(*cats, *nums, "Minutos_Resolucion", "_rid")
    data = landed(data, "tickets")  # every stage, fold and trial reads the rows anew
    data = data.withColumn("_split", F.pmod(F.xxhash64("_rid", *[F.col(c) for c in cats], F.lit(seed)), F.lit(5)))
    train, test = data.filter("_split <> 0"), data.filter("_split = 0")
    enc_stages, enc = encoded_stages(cats, "Minutos_Resolucion", "continuous")
    gbt = GBTRegressor(featuresCol="_x", labelCol="Minutos_Resolucion", seed=seed)
    pipe = Pipeline(stages=enc_stages + [VectorAssembler(inputCols=enc + nums, outputCol="_x"), gbt])
    grid = search_grid(gbt, trials, max_iter, seed)
    ev = RegressionEvaluator(labelCol="Minutos_Resolucion", metricName="mae")
    train = train.withColumn("cvfold", F.pmod(F.xxhash64("_rid", F.lit(seed + 1)), F.lit(folds)).cast("int"))
    model = cross_validated(pipe, grid, ev, train, folds, parallelism)
    p = model.transform(test)
    e = F.col("prediction") - F.col("Minutos_Resolucion")
    m = p.agg(F.avg(F.abs(e)).alias("MAE"), F.sqrt(F.avg(e * e)).alias("RMSE"), F.count(F.lit(1)).alias("Test"))
    return model, m


def feature_importances(model: PipelineModel, spark, top: int = 10) -> DataFrame:
    """K5: the final tree ensemble's importances joined to the assembler's input names."""
    asm = [s for s in model.stages if isinstance(s, VectorAssembler)][-1]
    names = asm.getInputCols()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(names, imp), key=lambda x: (-x[1], x[0]))[:top]
    return spark.createDataFrame(rows, "feature string, importance double")


def score_tickets(model: PipelineModel, tickets: DataFrame) -> DataFrame:
    """Class-1 probability (percent) and risk tier for a batch of new tickets."""
    p = model.transform(tickets)
    pct = vector_to_array("probability")[1] * 100.0
    keep = [c for c in tickets.columns]
    return p.select(*keep, pct.alias("Riesgo_Pct")).withColumn("Nivel", sla_risk_tier("Riesgo_Pct"))


def save_model(model: PipelineModel, path: str) -> None:
    """ML writer (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def align_features(df: DataFrame, features) -> DataFrame:
    """The trained feature list, in order; features missing from ``df`` are 0."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(0.0)).alias(c) for c in features])


# FIXED VALUES: tuned regressor parameters recorded by the source (trees, rate, depth, subsample)
TUNED_TREES, TUNED_RATE, TUNED_DEPTH, TUNED_SUBSAMPLE = 118, 0.034236, 9, 0.81929


def temporal_evaluation(tickets: DataFrame, cutoff, max_iter: int = TUNED_TREES) -> DataFrame:
    """M6: fixed-parameter regressor trained on tickets created before ``cutoff`` and
    scored on the rest (the next period): MAE, accumulated real / predicted minutes."""
    c = F.lit(cutoff).cast("timestamp_ntz")
    cats = [x for x in REGRESSOR_CATEGORICALS if x in tickets.columns]
    nums = [x for x in REGRESSOR_NUMERIC if x in tickets.columns]
    tickets = landed(tickets.select(*cats, *nums, "Minutos_Resolucion", "Fecha_Creacion"), "tickets")  # every stage reads them anew
    train = tickets.filter(F.col("Fecha_Creacion") < c)
    test = tickets.filter(F.col("Fecha_Creacion") >= c)
    enc_stages, enc = encoded_stages(cats, "Minutos_Resolucion", "continuous")
    gbt = GBTRegressor(featuresCol="_x", labelCol="Minutos_Resolucion", maxIter=max_iter,
                       stepSize=TUNED_RATE, maxDepth=TUNED_DEPTH, subsamplingRate=TUNED_SUBSAMPLE, seed=42)
    model = Pipeline(stages=enc_stages + [VectorAssembler(inputCols=enc + nums, outputCol="_x"), gbt]).fit(train)
    p = model.transform(test)
    e = F.abs(F.col("prediction") - F.col("Minutos_Resolucion"))
    return p.agg(F.avg(e).alias("MAE"), F.sum("Minutos_Resolucion").alias("Real_Acumulado"),
                 F.sum("prediction").alias("Prediccion_Acumulada"), F.count(F.lit(1)).alias("Tickets"))
