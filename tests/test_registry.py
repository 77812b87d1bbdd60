"""Driver contract: entry runs, every oracle belongs to a query, queries resolve."""
from tests.conftest import SF


def test_entry_and_registry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_queries_resolve(spark):
    """Every registered query analyses (schema known) on the smallest tables."""
    import __spark_entry__ as e
    skip = {"sla_classifier_report", "ticket_risk_scores", "resolution_regressor_metrics",
            "resolution_feature_importances", "forecast_v5_model", "node_clusters", "critical_cluster_top",
            "tickets_csv_roundtrip", "tickets_csv_tolerant", "sla_from_store",
            "walk_forward_metrics", "walk_forward_summary", "walk_forward_compare",
            "holdout_model_metrics", "demand_v1_recursive_model", "search_results"}
    for name, fn in e.queries().items():
        if name in skip:
            continue
        assert fn(spark, SF).schema.fields, name


def test_api_process_jira_roundtrip(spark, tmp_path):
    """S1 + P1-P12 through the API name, from a semicolon export with a repeated header."""
    from faultline import api
    path = tmp_path / "export.csv"
    head = ("Resumen;Prioridad;Creada;Campo personalizado (Solución afectación );"
            "Campo personalizado (Nodo Afectado);Campo personalizado (Usuarios Iniciales Afectados);"
            "Nombre del proyecto;Comentario;Comentario")
    lines = [head,
             'NOC/A/ corte fibra ;Alta;12/may/26 3:45 PM;12/may/26 6:45 PM;Chapinero;12;Zona Centro;"a;b";x',
             'NOC/A/energia;Baja;02/sep/26 15:45;02/sep/26 15:50;;1,2;Zona Centro;;',
             'sin barra;Media;junk;12/may/26 6:45 PM;N;3;Z;;']
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    rows = api.process_jira(spark, str(path)).collect()
    assert len(rows) == 1  # 5-minute ticket and unparsable date dropped
    r = rows[0]
    assert r.Tipo_Falla == "CORTE FIBRA" and r.Minutos_Resolucion == 180.0 and r.Nodo == "CHAPINERO"
