"""Adapters: driver tables -> the contract tables the operators expect.

* tickets from ``events``: a ticket per event, solved at the user's next event.
* raw ticket export (all strings, export header names) from the same events.
* SLA sheet from the ticket proxy.
* demand tickets and weather from ``lineitem`` x ``supplier`` x ``nation`` x ``region``.

These are fixtures for checking semantics, not models of real operations.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline import config as C
from faultline.functions import minutes_between, priority_from_value, spanish_jira_text

N_NODES = 20
N_ZONES = 5
N_SUPERVISORS = 7
BREACH_MINUTES = 480


def next_event_time(df: DataFrame, key: str, ts: str, tie: str, out: str,
                    bucket_unit: str = "HOUR") -> DataFrame:
    """``lead(ts) over (partition by key order by ts, tie)`` without one task per key.

    A hot key (one user with a third of all events) would put a third of the
    table into a single window partition. The window is therefore evaluated per
    (key, time bucket); the last row of each bucket takes the first timestamp of
    the key's next non-empty bucket, found by a second, tiny window over one row
    per (key, bucket).
    """
    b = df.withColumn("_bkt", F.date_trunc(bucket_unit, F.col(ts)))
    w_in = Window.partitionBy(key, "_bkt").orderBy(F.col(ts), F.col(tie))
    b = b.withColumn("_nx", F.lead(ts).over(w_in))
    firsts = b.groupBy(key, "_bkt").agg(F.min(ts).alias("_first"))
    w_keys = Window.partitionBy(key).orderBy("_bkt")
    firsts = firsts.select(key, "_bkt", F.lead("_first").over(w_keys).alias("_nb"))
    out_df = (b.join(firsts, [key, "_bkt"], "left")
              .withColumn(out, F.coalesce(F.col("_nx"), F.col("_nb")))
              .drop("_bkt", "_nx", "_nb"))
    return out_df


def ticket_events(events: DataFrame) -> DataFrame:
    """Typed ticket rows (before cleaning) from ``events``."""
    ev = events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    ev = next_event_time(ev, "user_id", "ts", "event_id", "Fecha_Solucion")
    zona = F.concat(F.lit("Z"), (F.col("user_id") % N_ZONES).cast("string"))
    return ev.select(
        "event_id", "user_id",
        F.concat(F.lit("NOC/"), zona, F.lit("/"), F.col("event_type")).alias("Resumen"),
        priority_from_value("value").alias("Prioridad"),
        F.col("ts").alias("Fecha_Creacion"),
        "Fecha_Solucion",
        F.concat(F.lit("N"), (F.col("user_id") % N_NODES).cast("string")).alias("Nodo"),
        F.get_json_object("props", "$.k").alias("Usuarios_Afectados"),
        zona.alias("Zona"),
    )


def tickets_raw(events: DataFrame, with_id: bool = False) -> DataFrame:
    """All-string export with the source header names; times as Spanish export text."""
    t = ticket_events(events)
    inv = {v: k for k, v in C.JIRA_COLUMNS_MAP.items()}
    return t.select(
        *(["event_id"] if with_id else []),
        F.col("Resumen").alias(inv["Resumen"]),
        F.col("Prioridad").alias(inv["Prioridad"]),
        spanish_jira_text("Fecha_Creacion").alias(inv["Fecha_Creacion"]),
        spanish_jira_text("Fecha_Solucion").alias(inv["Fecha_Solucion"]),
        F.col("Nodo").alias(inv["Nodo"]),
        F.col("Usuarios_Afectados").alias(inv["Usuarios_Afectados"]),
        F.col("Zona").alias(inv["Zona"]),
    )


def sla_raw(events: DataFrame, with_id: bool = False) -> DataFrame:
    """SLA sheet: breach when resolution exceeds 480 minutes; open tickets unlabeled."""
    t = ticket_events(events)
    mins = minutes_between("Fecha_Creacion", "Fecha_Solucion")
    return t.select(
        *(["event_id"] if with_id else []),
        "Prioridad",
        F.col("Nodo").alias("CENTRAL"),
        F.concat(F.lit("S"), (F.col("user_id") % N_SUPERVISORS).cast("string")).alias("SUEPERVISOR"),
        F.when(mins > BREACH_MINUTES, F.lit("NO CUMPLE"))
         .when(mins.isNotNull(), F.lit("CUMPLE")).alias("CUMPLE/NO CUMPLE"),
    )


def supplier_places(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """supplier -> (Zona = region name, Nodo = nation name). nation/region are fixed-size."""
    geo = (F.broadcast(nation.select("n_nationkey", "n_name", "n_regionkey"))
           .join(F.broadcast(region.select("r_regionkey", "r_name")),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    return (supplier.select("s_suppkey", "s_nationkey")
            .join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", F.trim("r_name").alias("Zona"), F.trim("n_name").alias("Nodo")))


def demand_tickets(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame,
                   region: DataFrame) -> DataFrame:
    """One demand ticket per line: (Fecha_Creacion, Zona, Nodo)."""
    places = supplier_places(supplier, nation, region)
    return (lineitem.select("l_suppkey", "l_shipdate")
            .join(places, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(F.col("l_shipdate").alias("Fecha_Creacion"), "Zona", "Nodo"))


def line_daily(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame,
               region: DataFrame) -> DataFrame:
    """Lines summed up per (Fecha, Zona, Nodo). Lines are joined to their supplier's place as they are: sums per
    (supplier, day) are hardly fewer rows than the lines and cost a shuffle of nearly all of them. AQE broadcasts
    the places while they are small, else it splits a hot supplier's join; the sums begin before the only further shuffle."""
    lines = lineitem.select("l_suppkey", F.to_date("l_shipdate").alias("Fecha"), "l_quantity", "l_discount", "l_tax")
    places = supplier_places(supplier, nation, region)
    return (lines.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("Fecha", "Zona", "Nodo")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("s_qty"),
                 F.sum("l_discount").alias("s_disc"), F.sum("l_tax").alias("s_tax")))


# Scales turning line measures into weather-like magnitudes (set at build time).
RAIN_PER_QTY = 0.4       # l_quantity 1..50 -> 0.4..20 mm
TEMP_BASE = 14.0         # l_discount 0..0.10 -> 14..24 C
TEMP_PER_DISC = 100.0
WIND_PER_TAX = 250.0     # l_tax 0..0.08 -> 0..20 km/h


def weather_from_lines(daily: DataFrame) -> DataFrame:
    """Raw weather per (Fecha, Zona): means of line measures, scaled; code = count % 100."""
    z = (daily.groupBy("Zona", "Fecha")
         .agg(F.sum("n").alias("n"), F.sum("s_qty").alias("q"),
              F.sum("s_disc").alias("d"), F.sum("s_tax").alias("t")))
    return z.select(
        "Fecha", "Zona",
        (F.col("q") / F.col("n") * RAIN_PER_QTY).alias("precipitacion_mm"),
        (F.lit(TEMP_BASE) + F.col("d") / F.col("n") * TEMP_PER_DISC).alias("temp_max"),
        (F.col("t") / F.col("n") * WIND_PER_TAX).alias("viento_max_kmh"),
        (F.col("n") % 100).cast("int").alias("weathercode"),
    )
