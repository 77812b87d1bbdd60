"""Splits: date cut (P27), per-zone chronological 85/15 (W8), expanding-window CV
folds by target date (W12), walk-forward bounds (W13), hashed / stratified folds (M5),
back-cast cutoffs (W14)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline import config as C


def date_cut(df: DataFrame, cutoff, col: str = "Fecha"):
    """Train strictly before the cutoff, test from it on (prunes partitions
    when the table is partitioned by date)."""
    c = F.lit(cutoff).cast("date")
    return df.filter(F.col(col) < c), df.filter(F.col(col) >= c)


def sorted_dates(df: DataFrame, col: str = "Fecha") -> list:
    """Distinct dates (a calendar: at most a few thousand scalars)."""
    lo, hi, n = df.agg(F.min(col), F.max(col), F.count_distinct(col)).first()
    if lo is None:
        return []
    if n == (hi - lo).days + 1:  # dense panel: no need to ship the dates
        return [lo + dt.timedelta(days=i) for i in range(n)]
    return [r[0] for r in df.select(col).distinct().orderBy(col).collect()]


def walk_forward_bounds(n: int, n_splits: int = 3, days_ahead: int = 14,
                        min_train: int = C.WF_MIN_TRAIN) -> list[tuple[int, int, int, int]]:
    """W13 on date indices: (split, train_end_idx, test_start_idx, test_end_idx).
    Decision Q21: a series too short to hold one test day raises."""
    if n < min_train + n_splits * days_ahead:
        n_splits = 1
    if min_train + 1 >= n:
        raise ValueError(f"{n} dates cannot hold {min_train} training dates plus a test date")
    step = max(1, (n - min_train - days_ahead) // n_splits)
    out = []
    for i in range(n_splits):
        tr = min_train + i * step
        ts = tr + 1
        if ts >= n:
            raise ValueError(f"split {i + 1} starts past the last date")
        te = min(ts + days_ahead - 1, n - 1)
        out.append((i + 1, tr, ts, te))
    return out


def walk_forward_splits(df: DataFrame, n_splits: int = 3, days_ahead: int = 14,
                        min_train: int = C.WF_MIN_TRAIN) -> DataFrame:
    """The split table (Split, Inicio, Corte_Train, Inicio_Test, Fin_Test)."""
    dates = sorted_dates(df)
    rows = [(s, dates[0], dates[tr], dates[ts], dates[te])
            for s, tr, ts, te in walk_forward_bounds(len(dates), n_splits, days_ahead, min_train)]
    return df.sparkSession.createDataFrame(
        rows, "Split int, Inicio date, Corte_Train date, Inicio_Test date, Fin_Test date")


def chrono_split(series: DataFrame, by: str = "Zona", window: int = 7, train_frac: float = 0.85,
                 min_rows: int = 15) -> DataFrame:
    """Per group, sample j (targets after the first ``window`` rows) is train when
    j < floor(train_frac * samples); groups with < min_rows rows are skipped."""
    w = Window.partitionBy(by).orderBy("Fecha")
    s = series.withColumns({"_rn": F.row_number().over(w),
                            "_cnt": F.count(F.lit(1)).over(Window.partitionBy(by))})
    s = s.filter((F.col("_cnt") >= min_rows) & (F.col("_rn") > window))
    j = F.col("_rn") - 1 - window
    cut = F.floor((F.col("_cnt") - window) * F.lit(train_frac))
    return s.withColumn("Particion", F.when(j < cut, F.lit("train")).otherwise(F.lit("test"))) \
        .drop("_rn", "_cnt")


def time_folds(df: DataFrame, n_splits: int = 5, col: str = "Fecha") -> DataFrame:
    """W12 (decision Q8: folds by target date, not row order): fold k in 1..n_splits
    validates on the k-th of the last n_splits date blocks and trains on every
    earlier date; fold 0 rows are training-only."""
    dates = sorted_dates(df, col)
    d = len(dates)
    size = d // (n_splits + 1)
    if size == 0:
        raise ValueError("too few dates for the requested folds")
    first = d - n_splits * size
    lo = dates[0]
    dense = dates[-1] == lo + dt.timedelta(days=d - 1)
    if dense:
        idx = F.datediff(F.col(col), F.lit(lo))
        return df.withColumn("fold", F.when(idx < first, F.lit(0))
                             .otherwise(F.floor((idx - first) / size) + 1).cast("int"))
    starts = [dates[first + k * size] for k in range(n_splits)]
    e = F.lit(0)
    for k, s in enumerate(starts, start=1):
        e = F.when(F.col(col) >= F.lit(s), F.lit(k)).otherwise(e)
    return df.withColumn("fold", e.cast("int"))


def hashed_folds(df: DataFrame, key_cols, k: int, seed: int = 42,
                 label: str | None = None) -> DataFrame:
    """M5: fold id from a seeded hash (MD5, as any SQL engine has it) of the key. With ``label`` the hash also covers
    the label, so every class spreads evenly over the folds (stratified in
    expectation) without gathering a class into one task."""
    cols = [F.col(c).cast("string") for c in key_cols] + ([F.col(label).cast("string")] if label else [])
    digest = F.md5(F.concat_ws("|", *cols, F.lit(str(seed))))
    return df.withColumn("fold", F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(k)).cast("int"))


def backcast_cutoffs(spark: SparkSession, cutoffs_days) -> DataFrame:
    """Fixed (cutoff, horizon days) pairs as a small table."""
    rows = [(dt.date.fromisoformat(c) if isinstance(c, str) else c, int(d)) for c, d in cutoffs_days]
    return spark.createDataFrame(rows, "Corte date, Dias int")


#: hash buckets in which rows are ranked; a class is never one task
RANK_BUCKETS = 4096


def stratified_folds(df: DataFrame, key_cols, k: int, label: str, seed: int = 42) -> DataFrame:
    """M5: exactly stratified folds: every class's rows are numbered in the order of their key's hash and dealt
    in turn, so a class's fold sizes differ by one at most. The number of a row is the count of its class in
    earlier hash buckets (one row a bucket) and its place within its own bucket."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))))
    rows = df.withColumns({"_hash": digest, "_bucket": F.pmod(F.conv(F.substring(digest, 1, 3), 16, 10).cast("int"), F.lit(RANK_BUCKETS))})
    counts = rows.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(label).orderBy("_bucket")) - F.col("_n"))
    before = before.select(F.col(label).alias("_label"), F.col("_bucket").alias("_at"), "_before")
    own = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_hash", *key_cols)) - 1
    ranked = rows.withColumn("_own", own).join(before, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_bucket") == F.col("_at")))
    return ranked.withColumn("fold", F.pmod(F.col("_before") + F.col("_own"), F.lit(k)).cast("int")).drop(
        "_hash", "_bucket", "_label", "_at", "_before", "_own")
