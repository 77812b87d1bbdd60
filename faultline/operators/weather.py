"""Weather dimension: flags (P20), 3-day rain (W4), climatology (D12), lookup with
fallbacks (J8), coverage and holes of a store and its update (S4), payload parsing (S5), keep-first union (U1/W11)."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline import config as C
from faultline.functions import weather_flags
from faultline.session import discard, landed

MEASURES = ["precipitacion_mm", "temp_max", "viento_max_kmh"]
FEATURES = ["precipitacion_mm", "temp_max", "viento_max_kmh", "es_lluvia_fuerte", "es_lluvia",
            "lluvia_acum_3d"]
WEATHER_COLUMNS = ["Fecha", "Zona", "precipitacion_mm", "temp_max", "viento_max_kmh", "weathercode",
                   "es_lluvia_fuerte", "es_tormenta", "es_lluvia", "lluvia_acum_3d"]

PAYLOAD_SCHEMA = ("daily struct<time: array<string>, precipitation_sum: array<double>, "
                  "temperature_2m_max: array<double>, windspeed_10m_max: array<double>, "
                  "weathercode: array<int>>")


def weather_features(raw: DataFrame) -> DataFrame:
    """P20 flags + W4 rain summed over the current and two previous rows per zone
    (partial windows allowed). The window is partitioned by zone: one row per day."""
    w = Window.partitionBy("Zona").orderBy("Fecha").rowsBetween(-2, 0)
    out = (raw.withColumn("Zona", F.trim("Zona"))
           .withColumns(weather_flags(F.col("precipitacion_mm"), F.col("weathercode")))
           .withColumn("lluvia_acum_3d", F.sum("precipitacion_mm").over(w)))
    return out.select(*WEATHER_COLUMNS)


def climatology(weather: DataFrame) -> DataFrame:
    """Per (Zona, month) means used when a date is missing."""
    return (weather.groupBy("Zona", F.month("Fecha").alias("_mes"))
            .agg(F.avg("precipitacion_mm").alias("c_precip"), F.avg("temp_max").alias("c_temp"),
                 F.avg("viento_max_kmh").alias("c_wind"), F.avg("lluvia_acum_3d").alias("c_acum"),
                 F.lit(True).alias("_has_month")))


def lookup_weather(dates: DataFrame, weather: DataFrame, zone_col: str = "Zona",
                   date_col: str = "Fecha") -> DataFrame:
    """Exact (zone, date) row; else the zone-month mean with flags 0; else the
    fixed fallbacks. Both dimensions are one row per zone-day / zone-month; they
    are joined by key, and AQE broadcasts them when they turn out small."""
    exact = weather.select(F.col("Zona").alias("_wz"), F.col("Fecha").alias("_wf"),
                           *[F.col(c).alias("_e_" + c) for c in FEATURES],
                           F.lit(True).alias("_has_day"))
    clim = climatology(weather).withColumnRenamed("Zona", "_cz")
    j = (dates.join(exact, (F.col(zone_col) == F.col("_wz")) & (F.col(date_col) == F.col("_wf")), "left")
         .join(clim, (F.col(zone_col) == F.col("_cz")) & (F.month(date_col) == F.col("_mes")), "left"))
    day, mon = F.col("_has_day").isNotNull(), F.col("_has_month").isNotNull()
    fb = C.WEATHER_FALLBACK

    def pick(feat, month_col, fallback):
        return (F.when(day, F.col("_e_" + feat))
                .when(mon, F.col(month_col) if month_col else F.lit(fallback))
                .otherwise(F.lit(fallback)))

    cols = {
        "precipitacion_mm": pick("precipitacion_mm", "c_precip", fb["precipitacion_mm"]).cast("double"),
        "temp_max": pick("temp_max", "c_temp", fb["temp_max"]).cast("double"),
        "viento_max_kmh": pick("viento_max_kmh", "c_wind", fb["viento_max_kmh"]).cast("double"),
        "es_lluvia_fuerte": F.when(day, F.col("_e_es_lluvia_fuerte")).otherwise(F.lit(0)).cast("int"),
        "es_lluvia": F.when(day, F.col("_e_es_lluvia")).otherwise(F.lit(0)).cast("int"),
        "lluvia_acum_3d": pick("lluvia_acum_3d", "c_acum", fb["lluvia_acum_3d"]).cast("double"),
    }
    keep = [c for c in dates.columns if c not in cols]
    return j.select(*keep, *[v.alias(k) for k, v in cols.items()])


def coverage(weather: DataFrame, start, end, zones=None) -> DataFrame:
    """Per zone, whether the stored table covers [start, end] (decision Q9:
    checked per zone, not globally)."""
    w = weather if zones is None else weather.filter(F.col("Zona").isin(list(zones)))
    return (w.groupBy("Zona").agg(F.min("Fecha").alias("desde"), F.max("Fecha").alias("hasta"))
            .withColumn("cubre", (F.col("desde") <= F.lit(start).cast("date"))
                        & (F.col("hasta") >= F.lit(end).cast("date"))))


def missing_intervals(weather: DataFrame, start, end, zones=None) -> DataFrame:
    """Zona, desde, hasta, dias of every maximal run of days in [start, end] that the store lacks, one
    row a run; a zone without rows lacks the whole range. ``zones``: names, or a table with a column Zona (None:
    the zones of the store). A zone's distinct days stand between two sentinels, the days beside the range, and each
    step of more than one day is a hole; a range that ends before it starts has none."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    if zones is None:
        zones = weather.select("Zona").distinct()
    elif not isinstance(zones, DataFrame):
        zones = weather.sparkSession.createDataFrame([(z,) for z in sorted(set(zones))], "Zona string")
    edges = zones.select("Zona", F.explode(F.array(F.date_sub(lo, 1), F.date_add(hi, 1))).alias("Fecha"))
    own = weather.join(zones.select("Zona"), "Zona", "left_semi").where(F.col("Fecha").between(lo, hi)).select("Zona", "Fecha")
    days = own.unionByName(edges).distinct()
    before = F.lag("Fecha").over(Window.partitionBy("Zona").orderBy("Fecha"))
    steps = days.withColumn("_before", before).where(F.datediff("Fecha", "_before") > 1)
    return steps.where(lo <= hi).select("Zona", F.date_add("_before", 1).alias("desde"), F.date_sub("Fecha", 1).alias("hasta"),
                        (F.datediff("Fecha", "_before") - 1).alias("dias"))


def read_stored_weather(weather: DataFrame, start, end, zones=None):
    """The stored rows of [start, end] of the zones without a hole in it, and the holes of the
    others (``missing_intervals``), which would need fetching."""
    missing = missing_intervals(weather, start, end, zones)
    rows = weather.join(missing.select("Zona"), "Zona", "left_anti").filter(
        F.col("Fecha").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if zones is not None:
        asked = zones.select("Zona") if isinstance(zones, DataFrame) else list(zones)
        rows = rows.join(asked, "Zona", "left_semi") if isinstance(zones, DataFrame) else rows.where(F.col("Zona").isin(asked))
    return rows, missing


#: the store's partition columns: a zone's year is rewritten whole
STORE_PARTS = ["Zona", "Anio"]


def read_store(like: DataFrame, path: str) -> DataFrame:
    """The store's rows, with the columns of ``like`` (raw rows) and Anio. They are given, not inferred: a store
    that got no row yet has no file to tell them, and a zone named 007 stays text."""
    schema = like.select(*[c for c in like.columns if c not in STORE_PARTS], F.col("Zona").cast("string"), F.lit(None).cast("int").alias("Anio")).schema
    return like.sparkSession.read.schema(schema).parquet(path)


def update_store(fetched: DataFrame, path: str) -> None:
    """Merge fetched raw rows (Fecha, Zona, measures, weathercode) into the store at ``path``. Only partitions
    (zone, year) that get rows are rewritten, by dynamic overwrite; a stored day wins over a fetched one (U1). The
    merged rows are landed first, so nothing is overwritten while it is read."""
    new = fetched.withColumn("Anio", F.year("Fecha"))
    try:
        old = read_store(fetched, path)
        touched = new.select(*STORE_PARTS).distinct()
        old = old.join(touched, STORE_PARTS, "left_semi")
        new = union_keep_first(old.select(*new.columns), new)
    except AnalysisException:
        new = union_keep_first(new)
    merged = landed(new, "weather-merge")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*STORE_PARTS).parquet(path)
    discard(merged)


def payloads_from_weather(raw: DataFrame) -> DataFrame:
    """Land daily weather as API-style payloads of parallel arrays, one per
    (zone, month), so each payload stays small."""
    grp = raw.groupBy("Zona", F.date_trunc("MONTH", "Fecha").alias("_m"))
    srt = F.array_sort(F.collect_list(F.struct(
        F.date_format("Fecha", "yyyy-MM-dd").alias("t"), F.col("precipitacion_mm").alias("p"),
        F.col("temp_max").alias("x"), F.col("viento_max_kmh").alias("v"),
        F.col("weathercode").alias("c"))))
    a = grp.agg(srt.alias("s"))
    daily = F.struct(F.col("s.t").alias("time"), F.col("s.p").alias("precipitation_sum"),
                     F.col("s.x").alias("temperature_2m_max"), F.col("s.v").alias("windspeed_10m_max"),
                     F.col("s.c").alias("weathercode"))
    return a.select("Zona", F.to_json(F.struct(daily.alias("daily"))).alias("payload"))


def parse_payload(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """JSON of parallel daily arrays -> one row per (zone, day)."""
    p = payloads.withColumn("_j", F.from_json(payload_col, PAYLOAD_SCHEMA))
    z = p.select("Zona", F.explode(F.arrays_zip(
        F.col("_j.daily.time").alias("time"),
        F.col("_j.daily.precipitation_sum").alias("precipitation_sum"),
        F.col("_j.daily.temperature_2m_max").alias("temperature_2m_max"),
        F.col("_j.daily.windspeed_10m_max").alias("windspeed_10m_max"),
        F.col("_j.daily.weathercode").alias("weathercode"))).alias("d"))
    return z.select(F.to_date("d.time").alias("Fecha"), "Zona",
                    F.col("d.precipitation_sum").alias("precipitacion_mm"),
                    F.col("d.temperature_2m_max").alias("temp_max"),
                    F.col("d.windspeed_10m_max").alias("viento_max_kmh"),
                    F.col("d.weathercode").alias("weathercode"))


def union_keep_first(*frames: DataFrame) -> DataFrame:
    """U1 + W11: union archive/forecast parts; per (Zona, Fecha) keep the row of the
    earliest part (archive before forecast)."""
    tagged = None
    for i, f in enumerate(frames):
        g = f.withColumn("_src", F.lit(i))
        tagged = g if tagged is None else tagged.unionByName(g)
    w = Window.partitionBy("Zona", "Fecha").orderBy("_src")
    return tagged.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_src")
