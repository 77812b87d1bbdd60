"""The weather store without a dry day to begin with, and with zones that look like numbers."""
import datetime as dt

import pytest

from faultline.operators import weather


def test_store_update_without_a_dry_day(spark, tmp_path):
    """The first merge writes no row; the holes are then the whole range and all days are merged."""
    from faultline.plans.catalog import QUERIES
    day = dt.datetime(1996, 12, 30)
    tables = {"region": ([(0, "ASIA ")], "r_regionkey int, r_name string"), "nation": ([(0, "INDIA", 0)], "n_nationkey int, n_name string, n_regionkey int"),
              "supplier": ([(1, 0)], "s_suppkey long, s_nationkey int"),
              "lineitem": ([(1, day + dt.timedelta(days=i), 50.0, 0.02, 0.04) for i in range(4)], "l_suppkey long, l_shipdate timestamp_ntz, l_quantity double, l_discount double, l_tax double")}
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    got = QUERIES["weather_store_update"](spark, str(tmp_path)).orderBy("Fecha").collect()
    assert [(r.Fecha, r.Zona, r.weathercode) for r in got] == [((day + dt.timedelta(days=i)).date(), "ASIA", 1) for i in range(4)]
    assert [r.precipitacion_mm for r in got] == pytest.approx([20.0] * 4)


def test_store_keeps_zone_names_as_text(spark, tmp_path):
    ddl = "Fecha date, Zona string, precipitacion_mm double, temp_max double, viento_max_kmh double, weathercode int"
    first, second = ([(dt.date(2026, 1, d), "007", float(m), 20.0, 5.0, 1)] for d, m in ((1, 1), (2, 2)))
    path = str(tmp_path / "store")
    for rows in (first, second, [(dt.date(2026, 1, 1), "007", 9.0, 20.0, 5.0, 1)]):
        weather.update_store(spark.createDataFrame(rows, ddl), path)
    got = weather.read_store(spark.createDataFrame(first, ddl), path).orderBy("Fecha").collect()
    assert [(r.Zona, r.precipitacion_mm, r.Anio) for r in got] == [("007", 1.0, 2026), ("007", 2.0, 2026)]
