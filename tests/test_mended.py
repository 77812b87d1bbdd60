"""Cases of the second round: tolerant CSV, weather store, stable folds, one week a window."""
import datetime as dt

from faultline.operators import splits, weather
from faultline.operators.series import scaled_windows
from faultline.sources import files


def test_tolerant_read_rejects_long_records(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('Resumen;Prioridad;Creada\na;b;c\nlong;1;2;3\nshort;1\n"quoted;sep";"two\nlines";z\n"q;q";1;2;"3;4"\n', encoding="utf-8")
    good, rejects = files.tolerant_parts(spark, str(path), ["Resumen", "Prioridad", "Creada"])
    assert good.count() == 3 and rejects.count() == 2
    assert sorted(tuple(r) for r in good.collect()) == [("a", "b", "c"), ("quoted;sep", "two\nlines", "z"), ("short", "1", None)]
    assert sorted(r[0][:4] for r in rejects.collect()) == ['"q;q', "long"]


def test_absent_zone_and_rain_before_the_range(spark):
    from faultline import api
    day = dt.date(2026, 1, 1)
    rows = [(day + dt.timedelta(days=i), "Z", 10.0, 20.0, 5.0, 1) for i in range(10)]
    stored = spark.createDataFrame(rows, "Fecha date, Zona string, precipitacion_mm double, temp_max double, viento_max_kmh double, weathercode int")
    got, missing = api.get_weather_for_zones(stored, "2026-01-04", "2026-01-08", ["Z", "Y"])
    assert [r.Zona for r in missing.collect()] == ["Y"]
    rain = {r.Fecha: r.lluvia_acum_3d for r in got.collect()}
    assert len(rain) == 5 and rain[dt.date(2026, 1, 4)] == 30.0
    assert weather.coverage(stored, "2026-01-04", "2026-01-08").first().cubre


def test_folds_do_not_depend_on_partitions(spark):
    df = spark.range(500).selectExpr("id AS event_id", "id % 2 AS Target")
    a, b = ({r.event_id: r.fold for r in splits.hashed_folds(df.repartition(n), ["event_id"], 5, label="Target").collect()} for n in (8, 5))
    assert a == b and set(a.values()) == {0, 1, 2, 3, 4}


def test_one_week_is_dropped_once(spark):
    day = dt.date(2026, 1, 1)
    zd = spark.createDataFrame([("Z", day + dt.timedelta(days=i), i % 5) for i in range(27)], "Zona string, Fecha date, Tickets_Total long")
    parts = splits.chrono_split(scaled_windows(zd), window=0, min_rows=8).groupBy("Particion").count().collect()
    assert {r[0]: r[1] for r in parts} == {"train": 17, "test": 3}


def test_v5_direct_takes_a_trained_model(spark):
    """A model over the V5 names serves the direct forecast; a flat series is forecast at its level."""
    import datetime as dt
    from faultline.operators import demand, forecast, stats, v5
    from faultline.operators.quantile import QuantileGBM
    day = dt.date(2026, 1, 1)
    counts = spark.createDataFrame([(day + dt.timedelta(days=i), "Z", n, k) for i in range(60) for n, k in (("A", 3), ("B", 8))],
                                   "Fecha date, Zona string, Nodo string, Tickets_Total long")
    panel = demand.demand_panel(counts)
    te = stats.target_encoding(panel)
    frame = v5.training_frame(panel, None, te)
    features = [c for c in v5.V5_FEATURES if c not in v5.WEATHER_FEATURES]
    model = QuantileGBM(alpha=0.5, features=features, rounds=8, depth=2, rate=0.7).fit(frame, "Tickets_Total")
    got = forecast.forecast_v5_direct(panel, stats.seasonal_means(panel), stats.dow_factors(panel), 7,
                                      predictor=forecast.model_predictor(model, "_p50", te)).collect()
    assert len(got) == 14 and {(r.Nodo, r.Prediccion_Tickets) for r in got} == {("A", 3), ("B", 8)}


def test_parsed_times_do_not_repeat_and_empty_audit(spark):
    """Filters on parsed times don't repeat the parse; the audit of an empty table gives zeros."""
    from faultline.operators import clean, reports
    raw = spark.createDataFrame([("12/may/26 3:45 PM", "2026-05-12 16:45"), ("junk", None)], "a string, b string")
    out = clean.with_parsed_times(raw, ["a", "b"]).where("a < b").selectExpr("a", "b", "hour(a) AS h")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp") <= 10
    assert [r.h for r in out.collect()] == [15]
    rows = reports.distinct_audit(raw.limit(0), ["a", "b"]).collect()
    assert [(r.Columna, r.Distintos, r.Minimo) for r in rows] == [("a", 0, None), ("b", 0, None)]


def test_served_series_count_their_samples(spark):
    from faultline.operators import samples
    day = dt.date(2026, 1, 1)
    lengths = {("C", "a"): 12, ("C", "b"): 17, ("C", "c"): 18, ("C", "d"): 60, ("Z", "e"): 10, ("Z", "f"): 20, ("Y", "g"): 10}
    panel = spark.createDataFrame([(day + dt.timedelta(days=i), z, n, i) for (z, n), k in lengths.items() for i in range(k)],
                                  "Fecha date, Zona string, Nodo string, Tickets_Total long")
    made = {r.Nodo: r["count"] for r in samples.direct_samples(panel).groupBy("Nodo").count().collect()}
    served = {r.Nodo for r in samples.served_series(panel, "C", 30).collect()}
    assert served == {n for (z, n) in lengths if (made.get(n, 0) >= 30 if z == "C" else z == "Z")}
    assert "d" in served and "a" not in served
