"""Holes of a weather store and its update, statistics and origins keyed by cutoff, the autoregression of a zone."""
import datetime as dt
import random

import numpy as np
import pytest

from faultline.operators import autoregression, backtest, forecast, metrics, stats, weather

DAY = dt.date(2026, 1, 1)
STORE = "Fecha date, Zona string, precipitacion_mm double, temp_max double, viento_max_kmh double, weathercode int"


def day(i):
    return DAY + dt.timedelta(days=i)


def stored(spark, zone, days, rain=1.0):
    return spark.createDataFrame([(day(i), zone, rain, 20.0, 5.0, 1) for i in days], STORE)


def holes(df):
    return sorted((r.Zona, r.desde, r.hasta, r.dias) for r in df.collect())


def test_a_missing_week_is_one_interval(spark):
    store = stored(spark, "A", [*range(10), *range(17, 30), 5]).unionByName(stored(spark, "B", range(3, 30)))
    assert holes(weather.missing_intervals(store, day(0), day(29))) == [("A", day(10), day(16), 7), ("B", day(0), day(2), 3)]
    assert holes(weather.missing_intervals(store, day(5), day(31), ["A", "C"])) == [
        ("A", day(10), day(16), 7), ("A", day(30), day(31), 2), ("C", day(5), day(31), 27)]
    assert holes(weather.missing_intervals(store, day(5), day(4))) == []
    rows, missing = weather.read_stored_weather(store, day(3), day(20))
    assert {r.Zona for r in rows.collect()} == {"B"} and rows.count() == 18 and [r.Zona for r in missing.collect()] == ["A"]


def test_update_rewrites_only_touched_parts(spark, tmp_path):
    path = str(tmp_path / "store")
    weather.update_store(stored(spark, "A", range(5)).unionByName(stored(spark, "B", range(5))), path)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet") if "Zona=B" in str(p)}
    weather.update_store(stored(spark, "A", range(3, 8), rain=9.0), path)
    assert before and all(p.stat().st_mtime_ns == t for p, t in before.items())
    rain = {r.Fecha: r.precipitacion_mm for r in spark.read.parquet(path).where("Zona = 'A'").collect()}
    assert rain == {day(i): 1.0 if i < 5 else 9.0 for i in range(8)}
    weather.update_store(stored(spark, "A", []), path)
    assert spark.read.parquet(path).count() == 13


def series(spark, days=70, holes=()):
    rng = random.Random(3)
    rows = [(day(i), z, n, rng.randrange(9)) for z, n in (("Z", "a"), ("Z", "b"), ("Y", "c")) for i in range(days) if (n, i) not in holes]
    return spark.createDataFrame(rows, "Fecha date, Zona string, Nodo string, Tickets_Total long")


def test_statistics_and_origins_equal_those_of_each_cut(spark):
    panel = series(spark, holes={("c", i) for i in range(20, 45)} | {("b", i) for i in range(0, 33)})
    cutoffs = [(2, day(40)), (1, day(30)), (3, day(41))]
    means, factors = stats.stats_at(panel, cutoffs)
    origins = forecast.origins_at(panel, cutoffs)
    for split, cut in cutoffs:
        train = panel.where(f"Fecha <= DATE '{cut}'")
        for keyed, plain in ((means, stats.seasonal_means(train)), (factors, stats.dow_factors(train)),
                             (origins.where("_n >= 7").drop("_n"), forecast.latest_origin(train, 7))):
            got = keyed.where(f"Split = {split}").drop("Split")
            assert sorted(map(tuple, got.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))


def test_backcasts_equal_one_forecast_a_cutoff(spark):
    panel = series(spark)
    cuts = [("2026-02-01", 5), (day(45), 9)]
    got = sorted(map(tuple, backtest.backcasts(panel, cuts).collect()), key=lambda r: (r[0], r[-1]))
    expected = []
    for cut, days in cuts:
        train = panel.where(f"Fecha < DATE '{cut}'")
        fc = forecast.forecast_v4(train, stats.seasonal_means(train), stats.dow_factors(train), days)
        m = metrics.error_metrics(metrics.real_vs_pred(panel, fc)).collect()
        expected += [(*r, dt.date.fromisoformat(str(cut))) for r in m]
    expected.sort(key=lambda r: (r[0], r[-1]))
    assert [(r[0], r[-1]) for r in got] == [(r[0], r[-1]) for r in expected]
    for a, b in zip(got, expected):
        assert a[1:-1] == pytest.approx(b[1:-1])


def test_autoregression_equals_least_squares(spark):
    rng = random.Random(5)
    y = [rng.randrange(1000) for _ in range(60)]
    zd = spark.createDataFrame([("A", day(i), v) for i, v in enumerate(y)] + [("K", day(i), 4) for i in range(60)]
                               + [("S", day(i), i) for i in range(6)], "Zona string, Fecha date, Tickets_Total long")
    fitted = {r.Zona: r for r in autoregression.coefficients(autoregression.lagged(zd)).collect()}
    assert set(fitted) == {"A", "K"}
    x = np.array([[1.0, *[y[i - k] for k in range(1, 8)]] for i in range(7, 60)])
    expected = np.linalg.lstsq(x, np.array(y[7:], float), rcond=None)[0]
    assert np.allclose([fitted["A"][f"b{k}"] for k in range(8)], expected, rtol=1e-6)
    assert [fitted["K"][f"b{k}"] for k in range(8)] == [4.0] + [0.0] * 7
    ahead = autoregression.weekly_forecast(zd).orderBy("Zona", "Fecha").collect()
    win, volumes = y[::-1][:7], []
    for _ in range(7):
        win.insert(0, expected[0] + float(np.dot(expected[1:], win[:7])))
        volumes.append(max(0, int(win[0])))
    assert [r.Volumen for r in ahead if r.Zona == "A"] == volumes
    flat = [r for r in ahead if r.Zona == "K"]
    assert [(r.Fecha, r.Volumen, r.Alerta) for r in flat] == [(day(60 + i), 4, "NOMINAL") for i in range(7)]
