"""Registered ticket / SLA queries (S1-S3, P1-P16, D3, D13, D14, D23, K1, ...)."""
from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import profile
from faultline.plans import derived as D
from faultline.plans import sqlparts as S
from faultline.plans.registry import query

W = "WITH "


@query("node_profile", W + S.CLEAN_TICKETS + """
SELECT Nodo, count(Tipo_Falla) AS Total_Fallas, avg(Minutos_Resolucion) AS Tiempo_Promedio_Minutos,
  count(*) FILTER (WHERE upper(Prioridad) IN ('ALTA', 'CRÍTICA')) AS Fallas_Criticas,
  count(*) FILTER (WHERE upper(Prioridad) IN ('ALTA', 'CRÍTICA')) / count(Tipo_Falla) * 100.0 AS Porcentaje_Critico
FROM clean GROUP BY Nodo HAVING count(Tipo_Falla) > 5""")
def node_profile(t):
    return profile.node_profiles(D.tickets_clean(t))


@query("top_critical_nodes", W + S.CLEAN_TICKETS + """,
p AS (
SELECT Nodo, count(Tipo_Falla) AS Total_Fallas, avg(Minutos_Resolucion) AS Tiempo_Promedio_Minutos,
  count(*) FILTER (WHERE upper(Prioridad) IN ('ALTA', 'CRÍTICA')) AS Fallas_Criticas,
  count(*) FILTER (WHERE upper(Prioridad) IN ('ALTA', 'CRÍTICA')) / count(Tipo_Falla) * 100.0 AS Porcentaje_Critico
FROM clean GROUP BY Nodo HAVING count(Tipo_Falla) > 5)
SELECT * FROM p ORDER BY Total_Fallas DESC, Nodo ASC LIMIT 10""")
def top_critical_nodes(t):
    return profile.top_critical_nodes(profile.node_profiles(D.tickets_clean(t)), 10)


@query("tickets_clean", W + S.CLEAN_TICKETS + " SELECT * FROM clean")
def tickets_clean(t):
    return D.tickets_clean(t)


@query("tickets_from_export", W + S.CLEAN_FROM_RAW + " SELECT * FROM clean")
def tickets_from_export(t):
    return D.tickets_from_raw(t)


@query("tickets_export_text", W + S.RAW_TICKETS + """
SELECT Resumen, Prioridad, Fecha_Creacion AS Creada,
  Fecha_Solucion AS "Campo personalizado (Solución afectación )",
  Nodo AS "Campo personalizado (Nodo Afectado)",
  Usuarios_Afectados AS "Campo personalizado (Usuarios Iniciales Afectados)",
  Zona AS "Nombre del proyecto" FROM raw""")
def tickets_export_text(t):
    return D.tickets_raw(t)


@query("sla_clean", W + S.SLA + " SELECT * FROM sla")
def sla_clean(t):
    return D.sla(t)


def _scratch(t, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    import uuid
    from faultline.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(t.spark)}/faultline-{name}-{uuid.uuid4().hex[:8]}"


@query("tickets_csv_roundtrip", W + S.CLEAN_FROM_RAW + " SELECT * FROM clean")
def tickets_csv_roundtrip(t):
    """S6 + S1: land the raw export as CSV, read it back with
    separator sniffing and all-string columns, clean it."""
    from faultline.operators import clean
    from faultline.sources import files
    path = _scratch(t, "export")
    files.save(D.tickets_raw(t), path, fmt="csv")
    return clean.clean_tickets(files.read_tickets(t.spark, path))


@query("tickets_csv_tolerant", W + S.CLEAN_FROM_RAW + " SELECT * FROM clean")
def tickets_csv_tolerant(t):
    """The same export through the tolerant reader (long lines quarantined)."""
    from faultline.operators import clean
    from faultline.sources import files
    path = _scratch(t, "export-tol")
    D.tickets_raw(t).write.mode("overwrite").options(header=True, sep=";").csv(path)
    return clean.clean_tickets(files.read_tickets_tolerant(t.spark, path))


@query("sla_from_store", W + S.SLA + " SELECT * FROM sla")
def sla_from_store(t):
    """S3 + S7: the SLA sheet stored once as Parquet, then loaded and cleaned."""
    from faultline.operators import clean
    from faultline.sources import files, proxies
    path = _scratch(t, "sla")
    stored = files.load_or_build(t.spark, path, lambda: proxies.sla_raw(t.events), partition_by=None)
    return clean.clean_sla(files.read_sla(t.spark, path)) if stored is not None else None
