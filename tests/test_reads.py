"""Training reads its source once, and the lines are shuffled once for the daily sums."""
import datetime as dt

import pytest

from faultline.operators import models
from faultline.plans import derived as D
from faultline.plans import q_models
from faultline.plans.registry import Tables
from faultline.sources import proxies


def counted(df, seen):
    def run(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    return df.mapInPandas(run, df.schema)


def test_classifier_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = [(i, f"P{i % 3}", f"N{i % 5}", f"S{i % 2}", int(i % 3 == 0 or i % 7 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "event_id long, Prioridad string, CENTRAL string, SUEPERVISOR string, Target int")
    _, report = models.train_sla_classifier(counted(df, seen), trials=1, folds=2, max_iter=1)
    assert {r.clase for r in report.collect()} == {0, 1}
    assert seen.value == 200


@pytest.fixture(scope="module")
def tickets(spark):
    day = dt.datetime(2026, 1, 1)
    rows = [(day + dt.timedelta(hours=i), f"P{i % 3}", f"N{i % 5}", f"F{i % 2}", float(i % 4), float(30 + 10 * (i % 3) + i % 5)) for i in range(200)]
    return spark.createDataFrame(rows, "Fecha_Creacion timestamp_ntz, Prioridad string, Nodo string, Tipo_Falla string, Usuarios_Afectados double, Minutos_Resolucion double")


def test_regressor_reads_its_rows_once(spark, tickets):
    seen = spark.sparkContext.accumulator(0)
    _, m = models.train_resolution_regressor(counted(tickets, seen), trials=1, folds=2, max_iter=1)
    assert 0 < m.first().Test < 200
    assert seen.value == 200


def test_temporal_evaluation_reads_its_rows_once(spark, tickets):
    seen = spark.sparkContext.accumulator(0)
    r = models.temporal_evaluation(counted(tickets, seen), "2026-01-07", max_iter=1).first()
    assert r.Tickets == 200 - 6 * 24
    assert seen.value == 200


def test_daily_sums(spark, tmp_path):
    day = dt.datetime(2026, 1, 1)
    lines = [(i % 3, day + dt.timedelta(days=i % 60), float(i), 0.25, 0.5) for i in range(600)]
    tables = {"region": ([(0, "Z")], "r_regionkey int, r_name string"), "nation": ([(0, "A", 0), (1, "B", 0)], "n_nationkey int, n_name string, n_regionkey int"),
              "supplier": ([(0, 0), (1, 1), (2, 0)], "s_suppkey long, s_nationkey int"),
              "lineitem": (lines, "l_suppkey long, l_shipdate timestamp_ntz, l_quantity double, l_discount double, l_tax double")}
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    t = Tables(spark, str(tmp_path))
    daily = proxies.line_daily(t.lineitem, t.supplier, t.nation, t.region)
    want = {}
    for k, d, q, *_ in lines:
        n, s = want.get((d.date(), "AB"[k % 2]), (0, 0.0))
        want[d.date(), "AB"[k % 2]] = n + 1, s + q
    assert {(r.Fecha, r.Nodo): (r.n, r.s_qty) for r in daily.collect()} == want
    assert daily._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    q_models.train_panel(t)
    assert "lineitem" not in "".join(D.panel(t).inputFiles() + D.weather_table(t).inputFiles())
