"""Quantile boosting: loss goes down, coverage tracks alpha; model save/load."""
import random

from pyspark.sql import functions as F

from faultline.operators.quantile import QuantileGBM, pinball_loss


def test_quantile_gbm(spark, tmp_path):
    rng = random.Random(3)
    rows = [(float(x), float(rng.gauss(2 * x, 1 + x))) for x in [rng.uniform(0, 5) for _ in range(3000)]]
    df = spark.createDataFrame(rows, "x double, y double")
    m = QuantileGBM(alpha=0.7, features=["x"], rounds=6, depth=3, rate=0.5).fit(df, "y")
    p = m.predict(df, "q")
    r = pinball_loss(p, "y", "q", 0.7).first()
    base = pinball_loss(df.withColumn("q", F.lit(float(m.init))), "y", "q", 0.7).first()
    assert r.pinball < base.pinball
    assert 0.6 < r.cobertura < 0.8
    path = str(tmp_path / "qgbm")
    m.save(path)
    m2 = QuantileGBM.load(path)
    a = [x.q for x in p.orderBy("x").limit(20).collect()]
    b = [x.q for x in m2.predict(df, "q").orderBy("x").limit(20).collect()]
    assert a == b
