"""Boosting of many models at once, its scoring as data, the demand models on it and their store."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.operators import boosting, v5


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    out = []
    for i in range(3000):
        seg = "hot" if i % 3 else f"s{i % 2}"
        a, b, c = rng.random(3)
        out.append((seg, float(a), float(b) if i % 10 else None, float(c), float((10 if seg == "hot" else -5) + (4 if a > 0.5 else 0) + rng.normal() * 2), i % 4, int(a > 0.5 or c > 0.9)))
    return spark.createDataFrame(out, "seg string, a double, b double, c double, y double, fold int, z int").repartition(3)


def scored(df, fitted, features, spec, segment="seg"):
    spark = df.sparkSession
    d = boosting.attach(df, fitted.frame(spark), F.col(segment) if segment else F.lit("all"))
    return d.withColumn("p", boosting.scored([F.col(f"m_{spec}")], boosting.vector(features))[0])


def test_segments_and_quantiles_in_one_fit(rows):
    feats = ["a", "b", "c"]
    specs = [boosting.Spec("mid", rounds=6, rate=0.8, depth=2), boosting.Spec("q70", "pinball", 0.7, rounds=6, rate=0.8, depth=2)]
    fitted = boosting.fit(rows, feats, specs, "y", "seg")
    assert set(fitted.trees) == {(s, i) for s in ("hot", "s0", "s1") for i in (0, 1)}
    d = scored(rows, fitted, feats, "mid")
    assert d.agg(F.avg(F.abs(F.col("p") - F.col("y")))).first()[0] < 1.75  # the noise alone is 1.6
    share = scored(rows, fitted, feats, "q70").agg(F.avg((F.col("y") <= F.col("p")).cast("double"))).first()[0]
    assert 0.62 < share < 0.85
    top = fitted.importances(rows.sparkSession).where("spec = 'mid'").groupBy("feature").agg(F.avg("importance").alias("i")).orderBy(F.desc("i")).first()
    assert top.feature == "a" and top.i > 0.7


def test_split_is_the_best_one(spark):
    """One level, squared error: the tree is what all cuts tried one by one give."""
    rng = np.random.default_rng(7)
    x, y = rng.integers(0, 8, (200, 2)).astype(float), rng.normal(size=200)
    y += 3 * (x[:, 1] > 4)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, y double")
    fitted = boosting.fit(df, ["a", "b"], [boosting.Spec("m", rounds=1, rate=1.0, depth=1, l2=0.5, l1=0.25)], "y")
    base = y.mean()

    def part(m):
        g = -(y[m] - base).sum()
        g = np.sign(g) * max(abs(g) - 0.25, 0)
        return g * g / (m.sum() + 0.5), -g / (m.sum() + 0.5)
    best = max(((part(x[:, j] <= c)[0] + part(x[:, j] > c)[0], j, c) for j in (0, 1) for c in range(7) if 0 < (x[:, j] <= c).sum() < 200), key=lambda t: t[0])
    tree = fitted.trees["all", 0][0]
    assert tree.feature[0] == best[1] and fitted.edges[best[1]][tree.cut[0]] == best[2]
    m = x[:, best[1]] <= best[2]
    assert tree.value == pytest.approx([part(m)[1], part(~m)[1]], rel=1e-4)


def test_logistic_and_search(rows):
    space = {"rate": (0.1, 0.6, "log"), "depth": (1, 3, "int"), "subsample": (0.6, 1.0, "float"), "l2": (1e-3, 1.0, "log")}
    draws = boosting.draw(space, 4)
    assert draws == boosting.draw(space, 4) and len({tuple(d.items()) for d in draws}) == 4
    specs = boosting.trials(boosting.Spec("", "logistic", rounds=6), draws, 3)
    fitted = boosting.fit(rows, ["a", "b", "c"], specs, "z", fold="fold", halving=(3,))
    h = fitted.history_frame(rows.sparkSession).toPandas()
    assert len(h[h["round"] == 0]) == 12 and len(h[h["round"] == 5]) == 6  # two of four trials stop after three rounds
    best = boosting.best_trials(fitted)["all"]
    assert best[2] < h[h["round"] == 0].loss.mean()


def test_expanding_folds_use_the_past_only(spark):
    df = spark.createDataFrame([(float(i % 5), float(k * 10), k) for k in range(4) for i in range(50)], "x double, y double, fold int")
    specs = boosting.trials(boosting.Spec("", rounds=1), [{}], 3, expanding=True)
    assert [s.fold for s in specs] == [1, 2, 3]
    fitted = boosting.fit(df, ["x"], specs, "y", fold="fold")
    assert {r[3]: r[6] for r in fitted.history} == {1: 50, 2: 50, 3: 50}


def test_least_rows_and_empty(spark, rows):
    fitted = boosting.fit(rows, ["a"], [boosting.Spec("m", rounds=1)], "y", "seg", least={"s": 10_000})
    assert {k[0] for k in fitted.trees} == {"hot"}
    d = scored(rows, fitted, ["a"], "m")
    assert d.where("seg != 'hot' AND p IS NOT NULL").count() == 0
    none = boosting.fit(rows.limit(0), ["a"], [boosting.Spec("m", rounds=1)], "y", "seg")
    assert not none.trees and none.frame(spark).count() == 0


@pytest.fixture(scope="module")
def panel(spark):
    from faultline.operators import demand
    day = dt.date(2026, 1, 1)
    level = {("Z", "A"): 3, ("Z", "B"): 8, ("C", "x"): 5, ("C", "y"): 2}
    counts = spark.createDataFrame([(day + dt.timedelta(days=i), z, n, k) for (z, n), k in level.items() for i in range(60)],
                                   "Fecha date, Zona string, Nodo string, Tickets_Total long")
    return demand.demand_panel(counts), level


def test_demand_models_and_their_store(spark, panel, tmp_path):
    """Flat series are forecast at their level by every trained model; a stored bundle gives equal forecasts and
    a half-written version is not read."""
    df, level = panel
    bundle = v5.train(df, rounds=12, depth=2, rate=0.9, subsample=1.0, node_zone="C")
    assert {r.segment for r in bundle.models.select("segment").distinct().collect()} == {"Z", "C/x", "C/y"}
    made = {"v5": v5.forecast_v5_model(df, bundle, 10), "v4": v5.forecast_v4_model(df, bundle, 10), "direct": v5.forecast_v5_direct_model(df, bundle, 10)}
    for name, fc in made.items():
        got = fc.collect()
        assert len(got) == 40 and {(r.Zona, r.Nodo, r.Prediccion_Tickets) for r in got} == {(*k, v) for k, v in level.items()}, name
    path = str(tmp_path / "store")
    first = v5.save_bundle(bundle, path)
    bundle.te.write.parquet(f"{path}/versions/half-written/te")
    again = v5.load_bundle(spark, path)
    assert sorted(map(tuple, v5.forecast_v5_model(df, again, 10).collect())) == sorted(map(tuple, made["v5"].collect()))
    assert v5.save_bundle(bundle, path) != first and v5.load_bundle(spark, path, first).node_zone == "C"


def test_v1_model_and_jobs(spark, panel):
    from faultline.operators import forecast
    from faultline.plans import jobs
    df, level = panel
    model = v5.train_v1(df, rounds=4, depth=3, rate=0.9)
    got = forecast.forecast_v1_recursive(df, 5, model=model).collect()
    assert len(got) == 20 and {(r.Zona, r.Nodo, r.Prediccion_Tickets) for r in got} == {(*k, v) for k, v in level.items()}
    cut = dt.date(2026, 2, 20)
    m = jobs.holdout_comparison(df, cut, with_models=True, rounds=10, depth=2, rate=0.9, subsample=1.0, node_zone="C").collect()
    assert {(r.Zona, r.Modelo) for r in m} == {(z, n) for z in "ZC" for n in ("V4", "V5_Iter", "V5_Direct")} and all(r.MAE < 0.5 for r in m)
    assert jobs.month_evaluation(df, cut, rounds=4, depth=3, rate=0.9, subsample=1.0).first().MAE < 0.5
    today = jobs.today_forecast(df, dt.date(2026, 3, 5), bundle=v5.train(df, rounds=2, depth=1, rate=0.9, node_zone="C", v5=False))
    assert today.count() >= 2


def test_equal_rows_are_one_cell(spark, monkeypatch):
    """Rows of few kinds are packed as cells, with and without drawing, and give the models and losses of plain rows."""
    rng = np.random.default_rng(3)
    a, b, k = rng.integers(0, 5, 4000), rng.integers(0, 3, 4000), rng.integers(0, 3, 4000)
    data = [(float(x), float(y), int(rng.random() < 0.2 + 0.1 * x), int(f)) for x, y, f in zip(a, b, k)]
    df = spark.createDataFrame(data, "a double, b double, z int, fold int").coalesce(1)
    specs = boosting.trials(boosting.Spec("", "logistic", rounds=6), [{"subsample": 0.7}, {"depth": 2}], 3)
    sizes = []
    packed = boosting._packed

    def run():
        fitted = boosting.fit(df, ["a", "b"], specs, "z", fold="fold", halving=(3,))
        return {h[:5]: (h[5], h[6]) for h in fitted.history}

    def noted(*args):
        out = packed(*args)
        sizes.append(out.agg(F.sum("n")).first()[0])
        return out
    monkeypatch.setattr(boosting, "_packed", noted)
    cells = run()
    monkeypatch.setattr(boosting, "_cells", lambda *columns: None)
    rows = run()
    assert sizes == [90, 4000]  # 5 x 3 feature values, 2 labels, 3 folds
    assert cells.keys() == rows.keys()
    for h in cells:
        assert cells[h] == pytest.approx(rows[h], rel=1e-9)
