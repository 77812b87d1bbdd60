"""Business constants.

FIXED VALUES: the numbers, names and lists in this module must equal the
source system's values for results to agree. They are kept together, in
their natural order, and used as plain data by the operators.
"""
from __future__ import annotations

import datetime as _dt

# --- FIXED VALUES: resolution-time bounds in minutes (inclusive) ---------
MIN_MINUTES_RESOLUTION = 15
MAX_MINUTES_RESOLUTION = 7200

# --- FIXED VALUES: source export column -> contract column ---------------
JIRA_COLUMNS_MAP = {
    "Resumen": "Resumen",
    "Prioridad": "Prioridad",
    "Creada": "Fecha_Creacion",
    "Campo personalizado (Solución afectación )": "Fecha_Solucion",
    "Campo personalizado (Nodo Afectado)": "Nodo",
    "Campo personalizado (Usuarios Iniciales Afectados)": "Usuarios_Afectados",
    "Nombre del proyecto": "Zona",
}

# --- FIXED VALUES: Spanish month abbreviation -> English, in map order ---
MONTHS_ES_TO_EN = {
    "ene": "Jan", "feb": "Feb", "mar": "Mar", "abr": "Apr",
    "may": "May", "jun": "Jun", "jul": "Jul", "ago": "Aug",
    "sep": "Sep", "oct": "Oct", "nov": "Nov", "dic": "Dec",
}

# --- FIXED VALUES: (zone -> allowed nodes) allow-list --------------------
VALID_ZONES_NODES = {
    "Zona Suroccidente ": ["Chiminangos", "Troncal", "Colon", "Camino Real", "Palmira",
                           "Tristan", "Santa Mónica", "DESCONOCIDO"],
    "Zona Centro": ["Chapinero", "Asturias", "Española", "Progreso", "Toberín", "DESCONOCIDO"],
    "Zona Noroccidente": ["Transversal", "Guayabal", "Envigado", "Itagüí", "Galán", "Sabaneta",
                          "DESCONOCIDO"],
    "Zona Area Metropolitana": ["Mosquera ", "Madrid", "Villa de Leyva", "DESCONOCIDO"],
    "Mantenimiento Preventivo": ["Troncal", "Colon", "Chiminangos", "Palmira", "Galán", "Española",
                                 "Progreso", "DESCONOCIDO"],
}

# --- FIXED VALUES: accent folds and spelling exceptions for node names ---
ACCENT_FROM = "óüíá"
ACCENT_TO = "ouia"
# (substrings that must all occur, replacement), checked in this order
NODE_SPELLING_EXCEPTIONS = [
    (("itag",), "itagui"),
    (("monica",), "santa monica"),
    (("espa", "ola"), "espanola"),
]
UNKNOWN = "DESCONOCIDO"
GLOBAL_ZONE = "GLOBAL"

# --- FIXED VALUES: priorities counted as critical by the node profile ----
CRITICAL_PRIORITIES = ["ALTA", "CRÍTICA"]

# --- FIXED VALUES: holidays 2026 -----------------------------------------
HOLIDAYS_2026 = [
    "2026-01-01", "2026-01-12", "2026-03-23", "2026-04-02", "2026-04-03",
    "2026-04-05", "2026-05-01", "2026-05-18", "2026-06-08", "2026-06-15",
    "2026-07-05", "2026-07-20", "2026-08-15", "2026-08-16", "2026-10-12",
    "2026-11-02", "2026-11-16", "2026-12-08", "2026-12-25",
]
HOLIDAY_DATES = [_dt.date.fromisoformat(d) for d in HOLIDAYS_2026]

# --- FIXED VALUES: weather thresholds and fallbacks ----------------------
HEAVY_RAIN_MM = 10
RAIN_MM = 2
STORM_CODES = [95, 96, 99]
WEATHER_FALLBACK = {
    "precipitacion_mm": 3.5,
    "temp_max": 18.5,
    "viento_max_kmh": 12.0,
    "lluvia_acum_3d": 10.0,
}

# --- FIXED VALUES: forecaster parameters ---------------------------------
V4_QUANTILE_ALPHA = 0.6
ENSEMBLE_XGB_W = 0.6
V4_DOW_DAMPING = 0.4
V5_DOW_DAMPING = 0.35
TARGET_SMOOTH = 10.0
V5_QUANTILES = {"q30": 0.3, "q50": 0.5, "q70": 0.7}
V5_WEIGHTS_RISKY = (0.25, 0.35, 0.40)
V5_WEIGHTS_NORMAL = (0.35, 0.45, 0.20)
SAMPLE_MIN_TARGET_IDX = 14
SAMPLE_MIN_ORIGIN_IDX = 7
MAX_HORIZON = 30
V4_MIN_HISTORY = 7
V5_MIN_HISTORY = 14
CENTRO = "Zona Centro"
MIN_SEGMENT_SAMPLES = 30

# --- FIXED VALUES: tiers and grades --------------------------------------
SLA_RED = 70
SLA_YELLOW = 50
PEAK_FACTOR = 1.3
VALLEY_FACTOR = 0.7
GRADE_HIGH = 85
GRADE_MID = 70

# --- FIXED VALUES: display labels ----------------------------------------
MONTH_NAMES_ES = {1: "Enero", 2: "Febrero", 3: "Marzo", 4: "Abril", 5: "Mayo"}
WEEKDAY_SHORT_ES = ["Lun", "Mar", "Mie", "Jue", "Vie", "Sab", "Dom"]
WEEKDAY_LONG_ES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]

# --- FIXED VALUES: walk-forward and run-rate defaults --------------------
WF_MIN_TRAIN = 60
HEATMAP_MIN_TOTAL = 20
HEATMAP_TOP = 15
RUNRATE_ELAPSED_DAYS = 12
RUNRATE_MONTH_DAYS = 30
PEAK_DAY_THRESHOLD = 55
