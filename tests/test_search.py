"""M1 and M2 are searched whole: the source's trials, folds and range of trees."""
import inspect

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor

from faultline.operators import models
from faultline.plans import q_models


class Stop(Exception):
    pass


@pytest.mark.parametrize("query, train", [("resolution_feature_importances", "train_resolution_regressor"), ("sla_classifier_report", "train_sla_classifier")])
def test_query_trains_with_the_whole_search(monkeypatch, query, train):
    whole, given = getattr(models, train), {}

    def noted(*args, **kw):
        call = inspect.signature(whole).bind(*args, **kw)
        call.apply_defaults()
        given.update(call.arguments)
        raise Stop

    monkeypatch.setattr(models, train, noted)
    monkeypatch.setattr(q_models, "D", type("D", (), {"tickets_clean": lambda t: None, "sla_with_id": lambda t: None}))
    with pytest.raises(Stop):
        getattr(q_models, query)(None)
    assert given["trials"] == 10 and given["folds"] == 3 and given["max_iter"] == (50, 300)


def test_grid_draws_trees(spark):
    gbt = GBTRegressor()
    drawn = models.search_grid(gbt, 10, models.SEARCH_TREES)
    assert len(drawn) == 10 and all(50 <= pm[gbt.maxIter] <= 300 for pm in drawn)
    assert len({pm[gbt.maxIter] for pm in drawn}) > 5
    fixed = models.search_grid(gbt, 3, 7)
    assert [pm[gbt.maxIter] for pm in fixed] == [7] * 3
    plain = models.random_grid(gbt, models.SEARCH_SPACE, 3)
    assert [{p: v for p, v in pm.items() if p != gbt.maxIter} for pm in fixed] == plain


def label_rows(spark):
    rows = [(i, f"P{i % 3}", f"N{i % 5}", f"S{i % 2}", int(i % 3 == 0 or i % 7 == 0)) for i in range(120)]
    return spark.createDataFrame(rows, "event_id long, Prioridad string, CENTRAL string, SUEPERVISOR string, Target int")


def time_rows(spark):
    rows = [(i, f"P{i % 3}", f"N{i % 5}", f"F{i % 2}", float(i % 4), float(30 + 10 * (i % 3) + i % 5)) for i in range(120)]
    return spark.createDataFrame(rows, "event_id long, Prioridad string, Nodo string, Tipo_Falla string, Usuarios_Afectados double, Minutos_Resolucion double")


@pytest.mark.parametrize("train, rows", [(models.train_sla_classifier, label_rows), (models.train_resolution_regressor, time_rows)])
def test_every_trial_is_fitted_on_every_fold(spark, monkeypatch, train, rows):
    fitted, fit = [], Pipeline.fit

    def noted(self, data, params=None):
        fitted.append(tuple(sorted((p.name, v) for p, v in params.items())))
        return fit(self, data, params)

    monkeypatch.setattr(Pipeline, "fit", noted)
    model, _ = train(rows(spark), trials=3, folds=2, max_iter=(1, 3))
    assert len(set(fitted)) == 3 and len(fitted) == 3 * 2 + 1
    assert sorted(fitted.count(p) for p in set(fitted)) == [2, 2, 3]
    assert model.stages[-1].getNumTrees == dict(fitted[-1])["maxIter"]


def test_best_point_is_that_of_the_least_error(spark):
    """A rate of next to nothing leaves the mean; the drawn point with the other rate is the one to take."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F
    data = spark.range(60).selectExpr("double(id % 6) AS x", "double(id % 6) * 10 AS y", "int(id % 3) AS cvfold")
    gbt = GBTRegressor(featuresCol="_x", labelCol="y", maxIter=2, maxDepth=3)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="_x"), gbt])
    grid = [{gbt.maxDepth: 1}, {gbt.maxDepth: 3}, {gbt.maxDepth: 2}]
    ev = RegressionEvaluator(labelCol="y", metricName="mae")
    assert models.cross_validated(pipe, grid, ev, data, 3).stages[-1].getOrDefault("maxDepth") == 3
    with pytest.raises(ValueError):
        models.cross_validated(pipe, grid, ev, data.withColumn("cvfold", F.lit(0)), 3)
