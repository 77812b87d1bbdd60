"""Node risk profile (D3), top-N (K1), clustering (M7) and its summary."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline import config as C


def node_profiles(tickets: DataFrame, min_faults: int = 5) -> DataFrame:
    """D3: per node: non-null fault types, mean minutes, count of ALTA/CRÍTICA
    priorities and their percentage; nodes with <= min_faults are dropped.
    A hot node is pre-aggregated map-side like any other key."""
    crit = F.upper(F.col("Prioridad")).isin(C.CRITICAL_PRIORITIES)
    p = (tickets.groupBy("Nodo")
         .agg(F.count("Tipo_Falla").alias("Total_Fallas"),
              F.avg("Minutos_Resolucion").alias("Tiempo_Promedio_Minutos"),
              F.count_if(crit).alias("Fallas_Criticas")))
    p = p.withColumn("Porcentaje_Critico",
                     F.col("Fallas_Criticas") / F.col("Total_Fallas") * F.lit(100.0))
    return p.filter(F.col("Total_Fallas") > min_faults)


def top_critical_nodes(profiles: DataFrame, n: int = 10) -> DataFrame:
    """K1: top-n by Total_Fallas (ties by Nodo) -- a TakeOrdered, no global sort."""
    return profiles.orderBy(F.desc("Total_Fallas"), F.asc("Nodo")).limit(n)


def cluster_nodes(profiles: DataFrame, k: int = 3, restarts: int = 10, seed: int = 42):
    """M7: standardise the three profile features, K-means with several seeded
    restarts (keep the lowest training cost), then pick the cluster with the highest
    mean Total_Fallas (D25). Returns (profiles with Grupo_IA, critical nodes)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    feats = ["Total_Fallas", "Tiempo_Promedio_Minutos", "Porcentaje_Critico"]
    base = profiles.withColumn("Total_Fallas", F.col("Total_Fallas").cast("double"))
    prep = Pipeline(stages=[
        VectorAssembler(inputCols=feats, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_x", withMean=True, withStd=True),
    ]).fit(base)
    x = prep.transform(base).cache()
    best, best_cost = None, None
    for r in range(restarts):
        m = KMeans(k=k, seed=seed + r, featuresCol="_x", predictionCol="Grupo_IA").fit(x)
        cost = m.summary.trainingCost
        if best_cost is None or cost < best_cost:
            best, best_cost = m, cost
    out = best.transform(x).drop("_raw", "_x")
    x.unpersist()
    crit = critical_group(out)
    return out, out.join(crit, "Grupo_IA", "left_semi")


def critical_group(clustered: DataFrame) -> DataFrame:
    """Cluster mean of Total_Fallas and the argmax cluster (one row)."""
    means = clustered.groupBy("Grupo_IA").agg(F.avg("Total_Fallas").alias("media_fallas"))
    return means.agg(F.max_by("Grupo_IA", "media_fallas").alias("Grupo_IA"))
