"""Default metric dictionary and unit names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewarden.functions.lookup import constant_frame
from tidewarden.schemas import DECIMAL, SCHEMAS
from tidewarden.settings import CONTRACT_METRICS

# Other names of the contract codes: the payload field, then the detector's name.
ALIASES = {
    "temp_air_c": ["temperature_2m", "air_temp_c"],
    "rain_mm": ["precipitation"],
    "wind_speed_ms": ["wind_speed_10m", "wind_spd_ms"],
    "wind_gust_ms": ["wind_gusts_10m"],
    "humidity_pct": ["relative_humidity_2m", "rel_hum_pct"],
    "pressure_hpa": ["surface_pressure", "press_hpa"],
}
# Written-out payload units and their symbols in the contract.
UNIT_NAMES = (
    ("degrees Celsius", "°C"),
    ("millimetres", "mm"),
    ("metres per second", "m/s"),
    ("percent", "%"),
    ("hectopascals", "hPa"),
)


def default_metrics(spark: SparkSession) -> DataFrame:
    """``dim_metric`` of the contract. The aliases let payload codes find their metric in the
    transform and detector limits find theirs; codes without one are reported by the
    contract check."""
    rows = [
        (number, code, unit, kind, low, high, True, ALIASES[code])
        for number, (code, unit, kind, low, high) in enumerate(CONTRACT_METRICS, start=1)
    ]
    return constant_frame(spark, rows, SCHEMAS["dim_metric"])


def default_unit_factors(spark: SparkSession) -> DataFrame:
    """Factors for :func:`~tidewarden.operators.transform.normalize_units`."""
    rows = [(name, symbol, 1, 0) for name, symbol in UNIT_NAMES]
    return constant_frame(
        spark, rows, f"unit string, unit_canonical string, factor {DECIMAL}, offset {DECIMAL}"
    )
