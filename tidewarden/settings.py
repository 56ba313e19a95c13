"""Names, thresholds and dictionaries the jobs run with. All are defaults of arguments."""

from __future__ import annotations

from typing import NamedTuple

# ---------------------------------------------------------------------------
# Job names, provider and status words stored in the tables.
# ---------------------------------------------------------------------------
INGEST_JOB = "ingest_openmeteo_all_stations"
TRANSFORM_JOB = "transform_raw_to_fact"
CHECKS_JOB = "dq_check_run"
DETECTION_JOB = "anomaly_detection"
PROVIDER = "OpenMeteo"
LIVE_INCIDENT_STATUSES = ("open", "acknowledged")
ANOMALY_TYPES = ("silent_station", "stale_data", "spike", "drop", "flatline")


class PayloadMetric(NamedTuple):
    code: str
    field: str
    unit: str
    kind: str = "num"


# Metric code, payload field and canonical unit of the provider.
PAYLOAD_METRICS = (
    PayloadMetric("temperature_2m", "temperature_2m", "degrees Celsius"),
    PayloadMetric("relative_humidity_2m", "relative_humidity_2m", "percent"),
    PayloadMetric("surface_pressure", "surface_pressure", "hectopascals"),
    PayloadMetric("wind_speed_10m", "wind_speed_10m", "metres per second"),
    PayloadMetric("wind_direction_10m", "wind_direction_10m", "degrees"),
    PayloadMetric("wind_gusts_10m", "wind_gusts_10m", "metres per second"),
    PayloadMetric("precipitation", "precipitation", "millimetres"),
    PayloadMetric("weather_code", "weather_code", "dimensionless code"),
)

# Contract dictionary (code, unit, value type, min, max).
CONTRACT_METRICS = (
    ("temp_air_c", "°C", "numeric", -10, 55),
    ("rain_mm", "mm", "numeric", 0, 500),
    ("wind_speed_ms", "m/s", "numeric", 0, 60),
    ("wind_gust_ms", "m/s", "numeric", 0, 80),
    ("humidity_pct", "%", "numeric", 0, 100),
    ("pressure_hpa", "hPa", "numeric", 850, 1100),
)

# Detector thresholds per metric code.
JUMP_THRESHOLDS = {
    "air_temp_c": 5.0,
    "rel_hum_pct": 15.0,
    "press_hpa": 8.0,
    "wind_spd_ms": 6.0,
    "wind_dir_deg": 90.0,
}
FLATLINE_EPSILONS = {
    "air_temp_c": 0.2,
    "rel_hum_pct": 1.0,
    "press_hpa": 0.3,
    "wind_spd_ms": 0.2,
}
SILENT_AFTER_MINUTES = 30
STALE_AFTER_MINUTES = 120
JUMP_LOOKBACK_MINUTES = 180
FLATLINE_WINDOW_MINUTES = 180
FLATLINE_MIN_POINTS = 6

# Contract and dashboard limits.
ALLOWED_LATENESS_HOURS = 24
RECENT_HOURS = 24
FRESHNESS_OBJECTIVE_MINUTES = 120
RECENT_INCIDENT_LIMIT = 50
MESSAGE_LIMIT = 4000
