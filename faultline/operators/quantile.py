"""One quantile (pinball-loss) model over a whole frame: ``boosting`` with a single segment."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators import boosting


@dataclass
class QuantileGBM:
    alpha: float
    features: list
    rounds: int = 100
    depth: int = 4
    rate: float = 0.1
    min_rows_leaf: int = 20
    seed: int = 42
    init: float = 0.0
    models: DataFrame | None = field(default=None, repr=False)

    def fit(self, df: DataFrame, label: str) -> "QuantileGBM":
        spec = boosting.Spec("q", "pinball", self.alpha, rounds=self.rounds, rate=self.rate, depth=self.depth, child_weight=self.min_rows_leaf, seed=self.seed)
        fitted = boosting.fit(df, self.features, [spec], label)
        self.models, self.init = fitted.frame(df.sparkSession), float(fitted.base["all", 0])
        return self

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        scored = boosting.attach(df, self.models, F.lit("all"), "_model_")
        return scored.withColumn(out, boosting.scored([F.col("_model_q")], boosting.vector(self.features))[0]).drop("_model_q")

    def save(self, path: str) -> None:
        """The model is plain data."""
        self.models.select("*", F.lit(self.alpha).alias("alpha"), F.array(*[F.lit(f) for f in self.features]).alias("features")) \
            .coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> "QuantileGBM":
        models = SparkSession.getActiveSession().read.parquet(path)
        r = models.first()
        return cls(alpha=r["alpha"], features=r["features"], init=r["base"], models=models.drop("alpha", "features"))


def pinball_loss(df: DataFrame, y: str, pred: str, alpha: float) -> DataFrame:
    """Mean pinball loss and the share of rows at or below the prediction."""
    d = F.col(y).cast("double") - F.col(pred)
    loss = F.when(d >= 0, F.lit(alpha) * d).otherwise(F.lit(alpha - 1.0) * d)
    return df.agg(F.avg(loss).alias("pinball"), F.avg((d <= 0).cast("double")).alias("cobertura"))
