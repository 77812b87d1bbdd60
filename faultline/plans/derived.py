"""Contract tables derived from the driver tables (Spark side), memoised per query."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators import clean, demand, weather
from faultline.session import landed
from faultline.sources import proxies


def tickets_typed(t) -> DataFrame:
    return t.memo("tickets_typed", lambda: proxies.ticket_events(t.events))


def tickets_clean(t) -> DataFrame:
    return t.memo("tickets_clean", lambda: clean.clean_tickets(
        tickets_typed(t).drop("event_id", "user_id"), renamed=True))


def tickets_raw(t) -> DataFrame:
    return t.memo("tickets_raw", lambda: proxies.tickets_raw(t.events))


def tickets_raw_with_id(t) -> DataFrame:
    return t.memo("tickets_raw_with_id", lambda: proxies.tickets_raw(t.events, with_id=True))


def tickets_from_raw(t) -> DataFrame:
    return t.memo("tickets_from_raw", lambda: clean.clean_tickets(tickets_raw(t)))


def sla(t) -> DataFrame:
    return t.memo("sla", lambda: clean.clean_sla(proxies.sla_raw(t.events)))


def sla_open(t) -> DataFrame:
    """The SLA rows without a label yet: the tickets still open."""
    return t.memo("sla_open", lambda: proxies.sla_raw(t.events).where("`CUMPLE/NO CUMPLE` IS NULL"))


def sla_with_id(t) -> DataFrame:
    return t.memo("sla_with_id", lambda: clean.clean_sla(proxies.sla_raw(t.events, with_id=True), keep=["event_id"]))


def line_daily(t) -> DataFrame:
    return t.memo("line_daily", lambda: proxies.line_daily(t.lineitem, t.supplier, t.nation,
                                                             t.region))


def land_line_daily(t) -> None:
    """Write the daily sums once, for a query with many plans on them; to be called before frames are built on them."""
    t._cache["line_daily"] = landed(line_daily(t), "line-daily")


def demand_counts(t) -> DataFrame:
    return t.memo("demand_counts", lambda: line_daily(t).select(
        "Fecha", "Zona", "Nodo", F.col("n").alias("Tickets_Total")))


def bounds(t):
    """Global (min, max) date of the demand counts: one scalar job per query; the
    dense panel ends on the max date, so later cutoffs need no further job."""
    return t.memo("bounds", lambda: demand.date_bounds(demand_counts(t)))


def panel(t) -> DataFrame:
    return t.memo("panel", lambda: demand.demand_panel(demand_counts(t), bounds=bounds(t)))


def weather_table(t) -> DataFrame:
    return t.memo("weather", lambda: weather.weather_features(
        proxies.weather_from_lines(line_daily(t))))
