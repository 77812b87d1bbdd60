"""Session construction and small cluster-safety helpers."""
from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "faultline") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        # local runs: the driver JVM is the only executor
        builder = (builder.master(master)
                   .config("spark.driver.memory", os.environ.get("FAULTLINE_DRIVER_MEMORY", "10g"))
                   .config("spark.driver.maxResultSize", "4g"))
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set one only where unset (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not conf_dir:
        conf_dir = os.path.join("/tmp", "faultline-ckpt-" + uuid.uuid4().hex[:8])
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def landed(df: DataFrame, name: str = "landed") -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back: the lineage
    ends there and a lost executor recomputes nothing that lies before."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._landed_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a ``landed`` frame that no later plan reads."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._landed_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """End a lineage in the shared folder (survives executor loss)."""
    return landed(df, "cut")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
