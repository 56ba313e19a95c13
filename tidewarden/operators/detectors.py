"""Anomaly detectors.

Each ``*_findings`` function returns flat columns; ``detect_*`` packs them into the
common shape ``(anomaly_type, station_id, metric_id, severity, details)``. The
dimensions are joined after the per-series reduction, on few rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidewarden import settings
from tidewarden.functions.clock import Instant, elapsed_minutes, instant, minutes
from tidewarden.functions.lookup import metric_limits
from tidewarden.functions.text import details_json
from tidewarden.schemas import DECIMAL
from tidewarden.operators.circular import arcs, turn
from tidewarden.operators.series import (
    SERIES, last_seen_by_series, last_seen_by_station, latest_pairs, series_heads, since,
)

Config = Mapping[str, float] | DataFrame


def active_stations(station: DataFrame) -> DataFrame:
    """Current real stations with a position: the ones to ingest."""
    usable = monitored(station).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return usable.select("station_external_id", "lat", "lon")


def monitored(station: DataFrame) -> DataFrame:
    """Current stations that are not smoke tests; a null flag excludes the station."""
    return station.where("is_current AND NOT is_smoketest")


def _watch(findings: DataFrame, station: DataFrame) -> DataFrame:
    """Findings of monitored stations.

    The keys of a stored dimension take many times the room of its compressed file, by which its size is guessed, and
    several detectors run at once: they are merged at every size, so that none of them goes through the driver.
    """
    return findings.join(monitored(station).select("station_id").hint("merge"), "station_id")


def silent_findings(
    fact: DataFrame, station: DataFrame, as_of: Instant = None, after_minutes: int = settings.SILENT_AFTER_MINUTES
) -> DataFrame:
    """Stations never seen, or last seen before ``as_of - after_minutes``."""
    now, last = F.col("_now"), F.col("last_observed_at")
    seen = monitored(station).select("station_id").join(last_seen_by_station(fact), "station_id", "left")
    silent = seen.withColumn("_now", instant(as_of)).where(last.isNull() | (last < now - minutes(after_minutes)))
    return silent.select(
        "station_id", last, F.round(elapsed_minutes(now, last), 2).alias("minutes_silent")
    )


def stale_findings(
    fact: DataFrame, station: DataFrame, as_of: Instant = None, after_minutes: int = settings.STALE_AFTER_MINUTES
) -> DataFrame:
    """Series last seen before ``as_of - after_minutes``."""
    now, last = F.col("_now"), F.col("last_observed_at")
    stale = last_seen_by_series(fact).withColumn("_now", instant(as_of)).where(last < now - minutes(after_minutes))
    return _watch(stale, station).select(
        *SERIES,
        last,
        F.round(elapsed_minutes(now, last), 2).alias("minutes_stale"),
        F.lit(after_minutes).alias("stale_threshold_minutes"),
    )


def jump_findings(
    heads: DataFrame,
    station: DataFrame,
    metric: DataFrame,
    thresholds: Config,
    rising: bool,
    lookback_minutes: int = settings.JUMP_LOOKBACK_MINUTES,
    circular: Sequence[str] = (),
) -> DataFrame:
    """Series whose newest value exceeds (or falls short of) the one before it by more
    than the threshold, both within ``lookback_minutes``. Metrics named ``circular`` turn
    the short way round: from 350 to 10 is a rise of 20."""
    return jumps_of_pairs(latest_pairs(heads), station, metric, thresholds, rising, lookback_minutes, circular)


def jumps_of_pairs(
    pairs: DataFrame,
    station: DataFrame,
    metric: DataFrame,
    thresholds: Config,
    rising: bool,
    lookback_minutes: int = settings.JUMP_LOOKBACK_MINUTES,
    circular: Sequence[str] = (),
) -> DataFrame:
    """:func:`jump_findings` for newest values that are beside the ones before them already."""
    delta = F.col("last_value") - F.col("prev_value")
    if circular:
        delta = F.when(F.col("metric_code").isin(*circular), turn(delta)).otherwise(delta)
    recent = pairs.where(
        F.col("prev_observed_at") >= F.col("last_observed_at") - minutes(lookback_minutes)
    )
    limited = recent.join(metric_limits(metric, thresholds, "threshold"), "metric_id")
    jumped = limited.where((delta if rising else -delta) > F.col("threshold"))
    return _watch(jumped, station).select(
        *SERIES,
        "metric_code",
        "last_observed_at",
        "prev_observed_at",
        "last_value",
        "prev_value",
        delta.alias("delta"),
        "threshold",
        F.lit(lookback_minutes).alias("lookback_minutes"),
    )


def flatline_findings(
    fact: DataFrame,
    station: DataFrame,
    metric: DataFrame,
    epsilons: Config = settings.FLATLINE_EPSILONS,
    as_of: Instant = None,
    window_minutes: int = settings.FLATLINE_WINDOW_MINUTES,
    min_points: int = settings.FLATLINE_MIN_POINTS,
    circular: Sequence[str] = (),
) -> DataFrame:
    """Series with enough recent points whose values stay within the epsilon.

    Directions of ``circular`` metrics stay within the smallest arc that holds them all.

    The time filter goes first and reaches the scan (and the day partitions, if the
    frame has them); there is no upper bound, so future observations count. Points without a value count as points.
    """
    recent = since(fact, "observed_at", instant(as_of) - minutes(window_minutes), "observed_date")
    spans = recent.groupBy(*SERIES).agg(
        F.count("*").alias("points"),
        F.min("observed_at").alias("window_start_at"),
        F.max("observed_at").alias("window_end_at"),
        F.min("value_num").alias("min_value"),
        F.max("value_num").alias("max_value"),
    )
    enough = spans.where(F.col("points") >= min_points)
    spread = F.col("max_value") - F.col("min_value")
    limited = enough.join(metric_limits(metric, epsilons, "epsilon"), "metric_id")
    if circular:
        # Only directions are looked at value by value, and only where the range leaves it open.
        round_ids = metric.where(F.col("metric_code").isin(*circular)).select("metric_id")
        directions = recent.join(round_ids, "metric_id", "left_semi")
        limited = limited.join(arcs(directions, SERIES, "value_num", "arc"), SERIES, "left")
        spread = F.when(F.col("metric_code").isin(*circular), F.col("arc")).otherwise(spread)
    limited = limited.withColumn("range", spread.cast(DECIMAL))
    return _watch(limited.where(F.col("range") <= F.col("epsilon")), station).select(
        *SERIES,
        "metric_code",
        F.lit(window_minutes).alias("window_minutes"),
        F.lit(min_points).alias("min_points"),
        "points",
        "window_start_at",
        "window_end_at",
        "min_value",
        "max_value",
        "range",
        "epsilon",
    )


def as_anomalies(findings: DataFrame, anomaly_type: str, severity: str) -> DataFrame:
    """Pack flat findings into the common anomaly shape."""
    fields = [F.col(c) for c in findings.columns if c not in SERIES]
    metric_id = F.col("metric_id") if "metric_id" in findings.columns else F.lit(None)
    return findings.select(
        F.lit(anomaly_type).alias("anomaly_type"),
        "station_id",
        metric_id.cast("bigint").alias("metric_id"),
        F.lit(severity).alias("severity"),
        details_json(*fields).alias("details"),
    )


@dataclass(frozen=True)
class Observed:
    """What detectors look at: the facts and the two dimensions.

    ``heads`` is the stored summary of the series, if there is one. Detectors that need no
    more than each series' newest rows then leave the facts unread.
    """

    fact: DataFrame
    station: DataFrame
    metric: DataFrame
    heads: DataFrame | None = None

    @property
    def newest(self) -> DataFrame:
        """Rows that hold the newest time of every series."""
        return self.fact if self.heads is None else self.heads

    @property
    def pairs(self) -> DataFrame:
        """The newest two rows of every series."""
        return series_heads(self.newest)


@dataclass(frozen=True)
class DetectorConfig:
    """Limits of the built-in detectors."""

    silent_after: int = settings.SILENT_AFTER_MINUTES
    stale_after: int = settings.STALE_AFTER_MINUTES
    jump_lookback: int = settings.JUMP_LOOKBACK_MINUTES
    spike: Config = None
    drop: Config = None
    flatline: Config = None
    flatline_window: int = settings.FLATLINE_WINDOW_MINUTES
    flatline_points: int = settings.FLATLINE_MIN_POINTS
    circular: tuple[str, ...] = ()  # metrics that are directions in degrees

    def __post_init__(self):
        for name, default in (
            ("spike", settings.JUMP_THRESHOLDS),
            ("drop", settings.JUMP_THRESHOLDS),
            ("flatline", settings.FLATLINE_EPSILONS),
        ):
            if getattr(self, name) is None:
                object.__setattr__(self, name, default)


Detect = Callable[[Observed, DetectorConfig, Instant], DataFrame]


@dataclass(frozen=True)
class Detector:
    """A named detector; ``detect`` returns the common anomaly shape."""

    name: str
    detect: Detect


def _silent(o: Observed, c: DetectorConfig, as_of: Instant) -> DataFrame:
    return as_anomalies(silent_findings(o.newest, o.station, as_of, c.silent_after), "silent_station", "high")


def _stale(o: Observed, c: DetectorConfig, as_of: Instant) -> DataFrame:
    return as_anomalies(stale_findings(o.newest, o.station, as_of, c.stale_after), "stale_data", "medium")


def _spike(o: Observed, c: DetectorConfig, as_of: Instant) -> DataFrame:
    found = jump_findings(o.pairs, o.station, o.metric, c.spike, True, c.jump_lookback, c.circular)
    return as_anomalies(found, "spike", "medium")


def _drop(o: Observed, c: DetectorConfig, as_of: Instant) -> DataFrame:
    found = jump_findings(o.pairs, o.station, o.metric, c.drop, False, c.jump_lookback, c.circular)
    return as_anomalies(found, "drop", "medium")


def _flatline(o: Observed, c: DetectorConfig, as_of: Instant) -> DataFrame:
    found = flatline_findings(
        o.fact, o.station, o.metric, c.flatline, as_of, c.flatline_window, c.flatline_points, c.circular
    )
    return as_anomalies(found, "flatline", "medium")


BUILT_IN = (
    Detector("silent_station", _silent),
    Detector("stale_data", _stale),
    Detector("spike", _spike),
    Detector("drop", _drop),
    Detector("flatline", _flatline),
)


def detect_all(
    observed: Observed,
    config: DetectorConfig = DetectorConfig(),
    as_of: Instant = None,
    detectors: Sequence[Detector] = BUILT_IN,
) -> DataFrame:
    """All detectors as one plan, tagged with the detector's name.

    Spike and drop use the same series heads, silent and stale the same maxima: the
    repeated exchanges are planned once and reused.
    """
    parts = [
        d.detect(observed, config, as_of).withColumn("detector", F.lit(d.name)) for d in detectors
    ]
    return reduce(DataFrame.unionByName, parts)


def enabled_only(found: DataFrame, anomaly_types: DataFrame) -> DataFrame:
    """Anomalies whose type is switched on. By default detectors ignore the switch."""
    return found.join(anomaly_types.where("is_enabled").select("anomaly_type"), "anomaly_type", "left_semi")


def detector_counts(detected: DataFrame, inserted: DataFrame, linked: DataFrame) -> DataFrame:
    """Rows detected, inserted and linked per detector, zero-filled.

    Each input carries a ``detector`` column; counting is one aggregate over the
    tagged union.
    """
    tagged = reduce(
        DataFrame.unionByName,
        [
            df.select("detector", F.lit(name).alias("_stage"))
            for name, df in (("detected", detected), ("inserted", inserted), ("linked", linked))
        ],
    )
    return tagged.groupBy("detector").agg(
        *[F.count_if(F.col("_stage") == s).alias(f"rows_{s}") for s in ("detected", "inserted", "linked")]
    )
