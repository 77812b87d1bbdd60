"""Numeric expressions: coercion, labels, tiers, rounding."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline import config as C
from faultline.functions.text import as_col

__all__ = ["to_double_or", "sla_target", "weather_flags", "sla_risk_tier", "demand_alert",
           "precision_grade", "nonneg_round", "priority_from_value"]


def to_double_or(c, default: float = 1.0) -> Column:
    """Numeric coerce, unparsable/NULL -> default."""
    return F.coalesce(F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str)
                      else as_col(c).try_cast("double"), F.lit(float(default)))


def sla_target(c) -> Column:
    """1 iff trim+upper equals NO CUMPLE (NULL stays 0 only after the NULL drop)."""
    return (F.upper(F.trim(as_col(c))) == F.lit("NO CUMPLE")).cast("int")


def weather_flags(rain, code) -> dict:
    """P20: heavy rain > 10 mm, rain > 2 mm, storm weather codes."""
    return {
        "es_lluvia_fuerte": (as_col(rain) > C.HEAVY_RAIN_MM).cast("int"),
        "es_tormenta": as_col(code).isin(C.STORM_CODES).cast("int"),
        "es_lluvia": (as_col(rain) > C.RAIN_MM).cast("int"),
    }


def sla_risk_tier(prob_pct) -> Column:
    """> 70 % red, > 50 % yellow, else normal."""
    p = as_col(prob_pct)
    return (F.when(p > C.SLA_RED, F.lit("ROJA"))
            .when(p > C.SLA_YELLOW, F.lit("AMARILLA"))
            .otherwise(F.lit("NOMINAL")))


def demand_alert(volume, zone_mean) -> Column:
    """> 1.3x zone mean peak, < 0.7x valley, else nominal."""
    v, m = as_col(volume), as_col(zone_mean)
    return (F.when(v > m * C.PEAK_FACTOR, F.lit("PICO"))
            .when(v < m * C.VALLEY_FACTOR, F.lit("VALLE"))
            .otherwise(F.lit("NOMINAL")))


def precision_grade(pct) -> Column:
    """> 85 high, 70..85 mid, < 70 low."""
    p = as_col(pct)
    return (F.when(p > C.GRADE_HIGH, F.lit("ALTA"))
            .when(p >= C.GRADE_MID, F.lit("MEDIA"))
            .otherwise(F.lit("BAJA")))


def nonneg_round(c) -> Column:
    """max(0, round-half-even(x)) as long."""
    return F.greatest(F.lit(0.0), F.bround(as_col(c), 0)).cast("long")


def priority_from_value(c) -> Column:
    """Proxy priority from a numeric severity value."""
    v = as_col(c)
    return (F.when(v < 15, F.lit("Baja")).when(v < 35, F.lit("Media"))
            .when(v < 70, F.lit("Alta")).otherwise(F.lit("Crítica")))
