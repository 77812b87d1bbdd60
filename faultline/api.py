"""Entry points named after the source package's public API,
each a thin composition of faultline operators. All take and return DataFrames
(plus a session where a file is read); nothing is collected."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultline import config as C
from faultline.functions import translate_month_es
from faultline.operators import (backtest, clean, demand, forecast, metrics, models, profile,
                                 stats, v5, weather)
from faultline.plans import jobs
from faultline.sources import files

# --- data processor ---------------------------------------------------------
translate_date = translate_month_es                                     # P3


def process_jira(spark: SparkSession, input_file: str) -> DataFrame:    # S1, P1-P12
    return clean.clean_tickets(files.read_tickets(spark, input_file))


def process_ans(spark: SparkSession, table_path: str) -> DataFrame:     # S3, P13, P2, P15
    return clean.clean_sla(files.read_sla(spark, table_path))


def process_demand_series(spark: SparkSession, input_file: str) -> DataFrame:  # S1, P14, D1, P17, J1, J2, W1-W3
    raw = files.read_tickets(spark, input_file, all_columns=True)
    return demand.demand_panel(demand.daily_counts(clean.demand_tickets_from_export(raw)))


save_processed_data = files.save                                        # S6

# --- weather ----------------------------------------------------------------


def get_weather_for_zones(stored: DataFrame, start_date, end_date, zones=None):  # S4, U1, W11, P20, W4
    # features over the whole store first: the range's first days need the rain before them
    return weather.read_stored_weather(weather.weather_features(stored), start_date, end_date, zones)


get_weather_features_for_dates = weather.lookup_weather                 # J8, D12

# --- models -----------------------------------------------------------------
train_ans_classifier = models.train_sla_classifier                       # M1, M3-M5, D14, D26
train_oraculo_regressor = models.train_resolution_regressor              # M2-M5
load_model = models.load_model                                           # M19

# --- anomaly detector -------------------------------------------------------
build_node_profiles = profile.node_profiles                              # D3
detect_anomalies = profile.cluster_nodes                                 # M7, D25
get_top_critical_nodos = profile.top_critical_nodes                      # K1

# --- demand forecasters -----------------------------------------------------
compute_seasonal = stats.seasonal_means                                  # D5
compute_dow_factors = stats.dow_factors                                  # D6
compute_target_encoding = stats.target_encoding                          # D7
add_calendar = stats.add_calendar                                        # P18


def predict_future_v1(panel: DataFrame, days: int = 30) -> DataFrame:    # M15
    return forecast.forecast_v1_recursive(panel, days)


def predict_future_v4(panel: DataFrame, days: int = 30, predictor=forecast.trailing_mean_predictor,
                      weather_df: DataFrame | None = None) -> DataFrame:  # M10
    return forecast.forecast_v4(panel, stats.seasonal_means(panel), stats.dow_factors(panel), days,
                                predictor, weather_df)


def train_v5(panel: DataFrame, weather_df: DataFrame | None = None, **kw) -> v5.Bundle:  # M11
    return v5.train(panel, weather_df, v4=False, **kw)


def train_v4(panel: DataFrame, weather_df: DataFrame | None = None, **kw) -> v5.Bundle:  # M9
    return v5.train(panel, weather_df, v5=False, **kw)


def predict_future_v5(panel: DataFrame, bundle: v5.Bundle, days: int = 30,
                      weather_df: DataFrame | None = None) -> DataFrame:  # M12, M13
    return v5.forecast_v5_model(panel, bundle, days, weather_df)


def predict_future_direct_v5(panel: DataFrame, days: int = 30, predictor=forecast.trailing_band_predictor,
                             weather_df: DataFrame | None = None) -> DataFrame:  # M14
    return forecast.forecast_v5_direct(panel, stats.seasonal_means(panel), stats.dow_factors(panel), days,
                                       predictor, weather_df)


# --- validation and scripts -------------------------------------------------


def evaluate_preds(df_real: DataFrame, df_pred: DataFrame) -> DataFrame:  # D4, J3, D9
    return metrics.error_metrics(metrics.real_vs_pred(df_real, df_pred))


walk_forward_validate = backtest.walk_forward                            # B5
run_single_holdout = jobs.holdout_comparison                              # B4
run_full_pipeline = jobs.master_pipeline                                  # B1
run_forecasting = jobs.demand_forecasting                                 # B2
retrain = jobs.retrain                                                    # B6
test_may_forecast = jobs.month_evaluation                                 # B7
run_today = jobs.today_forecast                                           # B8
run_backcasts = jobs.backcasts                                            # B9
discrepancy_analysis = jobs.discrepancy_analysis                          # B10
hot_zone_report = jobs.hot_zone_report                                    # B11

MIN_MINUTES, MAX_MINUTES = C.MIN_MINUTES_RESOLUTION, C.MAX_MINUTES_RESOLUTION
