"""Imports every query module so the registry is complete."""
from faultline.plans import q_backtest, q_demand, q_forecast, q_models, q_reports, q_tickets  # noqa: F401
from faultline.plans.registry import ORACLES, QUERIES, wrapped_oracles  # noqa: F401
