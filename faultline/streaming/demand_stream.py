"""Daily demand counts kept up to date from a folder of landed ticket files.

The batch operator D1 (tickets per day, zone and node) run as a Structured
Streaming aggregation: a watermark on the creation time bounds the state, so late
tickets within ``lateness`` are still counted and older state is dropped.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def daily_counts_stream(spark: SparkSession, path: str, schema: StructType,
                        lateness: str = "2 days") -> DataFrame:
    """Streaming D1 over typed ticket files (Fecha_Creacion, Zona, Nodo, ...)."""
    s = spark.readStream.schema(schema).parquet(path)
    s = s.withColumn("_ts", F.col("Fecha_Creacion").cast("timestamp")).withWatermark("_ts", lateness)
    return (s.groupBy(F.window("_ts", "1 day").alias("w"), "Zona", "Nodo")
            .agg(F.count(F.lit(1)).alias("Tickets_Total"))
            .select(F.to_date("w.start").alias("Fecha"), "Zona", "Nodo", "Tickets_Total"))


def start_counts(spark: SparkSession, path: str, schema: StructType, out: str, checkpoint: str):
    """Append finalized days to Parquet; the checkpoint makes restarts exactly-once."""
    return (daily_counts_stream(spark, path, schema).writeStream.outputMode("append")
            .format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
