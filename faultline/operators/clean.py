"""Ticket and SLA cleaning."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline import config as C
from faultline.functions import (cyclic, fault_type, minutes_between, month_found,
                                 node_label, parse_ticket_time, replace_month,
                                 sla_target, to_double_or, weekday0)

TICKET_COLUMNS = ["Resumen", "Prioridad", "Fecha_Creacion", "Fecha_Solucion", "Nodo",
                  "Usuarios_Afectados", "Zona", "Minutos_Resolucion", "Tipo_Falla",
                  "Hora_Del_Dia", "Hora_sin", "Hora_cos", "Dia_De_La_Semana", "Dia_sin", "Dia_cos"]
SLA_COLUMNS = ["Prioridad", "CENTRAL", "SUEPERVISOR", "CUMPLE/NO CUMPLE"]


def require_columns(df: DataFrame, cols, what: str = "input") -> None:
    """Driver-side schema check."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns in {what}: {missing}")


def select_renamed(df: DataFrame, mapping: dict) -> DataFrame:
    """Select the mapped columns and rename them."""
    require_columns(df, list(mapping), "ticket export")
    return df.select(*[F.col(f"`{k}`").alias(v) for k, v in mapping.items()])


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def with_parsed_times(df: DataFrame, names) -> DataFrame:
    """P3 + P4 on text columns (typed columns are only cast). Each step is a column of its
    own, so it is computed once; the parsed times leave through a one-row ``inline``, which
    keeps filters and features on them from repeating the parse."""
    text = [n for n in names if _is_text(df, n)]
    if not text:
        return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})
    out = df.withColumns({f"_low_{n}": F.lower(n) for n in text})
    out = out.withColumns({f"_month_{n}": month_found(f"_low_{n}") for n in text})
    out = out.withColumns({f"_text_{n}": replace_month(f"_low_{n}", f"_month_{n}") for n in text})
    times = F.struct(*[(parse_ticket_time(f"_text_{n}", translate=False) if n in text else F.col(n))
                       .cast("timestamp_ntz").alias(n) for n in names])
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in names], F.inline(F.array(times)))


def add_time_features(df: DataFrame, ts: str = "Fecha_Creacion") -> DataFrame:
    """Hour and Monday=0 weekday, with sin/cos encodings."""
    hs, hc = cyclic(F.col("Hora_Del_Dia"), 24.0)
    ds, dc = cyclic(F.col("Dia_De_La_Semana"), 7.0)
    return (df.withColumn("Hora_Del_Dia", F.hour(ts))
            .withColumn("Dia_De_La_Semana", weekday0(ts))
            .withColumns({"Hora_sin": hs, "Hora_cos": hc, "Dia_sin": ds, "Dia_cos": dc}))


def ensure_cyclic(df: DataFrame, ts: str = "Fecha_Creacion") -> DataFrame:
    """P10: recompute the cyclic columns only when they are absent."""
    need = [c for c in ("Hora_sin", "Hora_cos", "Dia_sin", "Dia_cos") if c not in df.columns]
    if not need:
        return df
    out = df
    if "Hora_Del_Dia" not in out.columns:
        out = out.withColumn("Hora_Del_Dia", F.hour(ts))
    if "Dia_De_La_Semana" not in out.columns:
        out = out.withColumn("Dia_De_La_Semana", weekday0(ts))
    hs, hc = cyclic(F.col("Hora_Del_Dia"), 24.0)
    ds, dc = cyclic(F.col("Dia_De_La_Semana"), 7.0)
    cols = {"Hora_sin": hs, "Hora_cos": hc, "Dia_sin": ds, "Dia_cos": dc}
    return out.withColumns({k: v for k, v in cols.items() if k in need})


def clean_tickets(df: DataFrame, renamed: bool = False,
                  min_minutes: float = C.MIN_MINUTES_RESOLUTION,
                  max_minutes: float = C.MAX_MINUTES_RESOLUTION) -> DataFrame:
    """Ticket ETL: P1, P2, P3/P4, P5, P6, P7, P9, P11, P12.

    ``df`` is a raw export (source header names) or, with ``renamed=True``, a
    frame already carrying the contract names; time columns may be text or typed.
    """
    t = df if renamed else select_renamed(df, C.JIRA_COLUMNS_MAP)
    t = t.dropna(subset=["Fecha_Solucion", "Fecha_Creacion"])
    t = with_parsed_times(t, ["Fecha_Creacion", "Fecha_Solucion"])
    # unparsable times give a NULL duration, which the range filter below drops
    t = t.withColumns({
        "Minutos_Resolucion": minutes_between("Fecha_Creacion", "Fecha_Solucion"),
        "Tipo_Falla": fault_type("Resumen"),
        "Nodo": node_label("Nodo", upper=True),
        "Zona": F.trim(F.col("Zona")),
        "Usuarios_Afectados": to_double_or(F.col("Usuarios_Afectados"), 1.0),
    })
    t = add_time_features(t)
    t = t.filter(F.col("Minutos_Resolucion").between(min_minutes, max_minutes))
    return t.select(*TICKET_COLUMNS)


def clean_sla(df: DataFrame, keep=()) -> DataFrame:
    """SLA ETL: P13 column check, P2 label NULL drop, P15 target; ``keep``: further columns."""
    require_columns(df, SLA_COLUMNS, "SLA sheet")
    s = df.select(*[F.col(f"`{c}`") for c in [*keep, *SLA_COLUMNS]])
    s = s.dropna(subset=["CUMPLE/NO CUMPLE"])
    return s.withColumn("Target", sla_target(F.col("`CUMPLE/NO CUMPLE`")))


def resolve_demand_columns(columns) -> dict:
    """Map names first, then substring search, for date / zone / node columns."""
    inv = {}
    for raw, clean in C.JIRA_COLUMNS_MAP.items():
        if raw in columns and clean in ("Fecha_Creacion", "Zona", "Nodo"):
            inv[clean] = raw

    def first(pred):
        for c in columns:
            if pred(str(c).lower()):
                return c
        return None

    if "Fecha_Creacion" not in inv:
        found = first(lambda s: "creada" in s or "created" in s or "fecha" in s)
        if not found:
            raise ValueError("no creation-date column found")
        inv["Fecha_Creacion"] = found
    if "Zona" not in inv:
        found = first(lambda s: "proyecto" in s or "project" in s)
        if found:
            inv["Zona"] = found
    if "Nodo" not in inv:
        found = first(lambda s: "nodo" in s or "node" in s)
        if found:
            inv["Nodo"] = found
    return inv


def demand_tickets_from_export(df: DataFrame) -> DataFrame:
    """P14 + P4 + P2 + P8 + P7(fill): ticket rows (Fecha, Zona, Nodo) for the panel."""
    cols = resolve_demand_columns(df.columns)
    out = df.select(*[F.col(f"`{raw}`").alias(clean) for clean, raw in cols.items()])
    out = with_parsed_times(out, ["Fecha_Creacion"])
    out = out.dropna(subset=["Fecha_Creacion"])
    zona = F.trim(F.coalesce(F.col("Zona"), F.lit(C.UNKNOWN))) if "Zona" in cols else F.lit(C.GLOBAL_ZONE)
    nodo = F.coalesce(F.col("Nodo"), F.lit(C.UNKNOWN)) if "Nodo" in cols else F.lit(C.UNKNOWN)
    return out.select(F.to_date("Fecha_Creacion").alias("Fecha"), zona.alias("Zona"),
                      nodo.alias("Nodo"))
