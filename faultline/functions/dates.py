"""Date/time expressions: tolerant parsing, durations, calendar features."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline import config as C
from faultline.functions.text import as_col, translate_month_es

__all__ = ["TICKET_TIME_FORMATS", "parse_ticket_time", "minutes_between", "weekday0",
           "cyclic", "calendar_columns", "holiday_flag", "spanish_jira_text"]

# Formats tried in order by the tolerant parser (decision Q19: explicit list).
TICKET_TIME_FORMATS = [
    "d/MMM/yy h:mm a",
    "d/MMM/yy H:mm",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
]


def parse_ticket_time(c, translate: bool = True) -> Column:
    """P3 + P4: translate Spanish months, then try each format; bad -> NULL."""
    s = translate_month_es(c) if translate else as_col(c)
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in TICKET_TIME_FORMATS])


def minutes_between(start, end) -> Column:
    """P5: fractional minutes (microsecond precision)."""
    return F.timestamp_diff("MICROSECOND", as_col(start), as_col(end)) / F.lit(60e6)


def weekday0(c) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(as_col(c))


def cyclic(c, period: float):
    """(sin, cos) of 2*pi*x/period."""
    ang = F.lit(2 * math.pi) * as_col(c) / F.lit(float(period))
    return F.sin(ang), F.cos(ang)


def holiday_flag(c, holidays=None) -> Column:
    """``holidays``: dates or ISO texts (None: the fixed list); a null date is null."""
    days = C.HOLIDAY_DATES if holidays is None else [F.lit(d).cast("date") for d in holidays]
    return F.to_date(as_col(c)).isin(*days).cast("int")


def calendar_columns(c, holidays=None) -> dict:
    """Calendar flags for a date column."""
    d = F.to_date(as_col(c))
    dia = F.dayofmonth(d)
    dow = F.weekday(d)
    return {
        "es_festivo": holiday_flag(d, holidays),
        "es_quincena": (((dia >= 14) & (dia <= 16)) | (dia >= 28) | (dia <= 1)).cast("int"),
        "semana_del_mes": (F.floor((dia - 1) / 7) + 1).cast("int"),
        "dia_del_mes": dia.cast("int"),
        "es_lunes": (dow == 0).cast("int"),
        "es_viernes": (dow == 4).cast("int"),
        "es_finsemana": (dow >= 5).cast("int"),
    }


_MONTHS_ES = list(C.MONTHS_ES_TO_EN.keys())


def spanish_jira_text(ts) -> Column:
    """Render a timestamp as the export's text, e.g. '05/ene/24 3:07 PM'."""
    t = as_col(ts)
    month = F.element_at(F.array(*[F.lit(m) for m in _MONTHS_ES]), F.month(t))
    return F.concat(F.date_format(t, "dd/"), month, F.date_format(t, "/yy h:mm a"))
