"""Detector boundaries and laws on hand-made series."""

from datetime import timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from conftest import at, rows
from tidewarden.operators import detectors as d
from tidewarden.operators.series import latest_pairs, series_heads
from tidewarden.schemas import SCHEMAS

NOW = at("2024-03-01 12:00:00")
FACT = SCHEMAS["fact_observation"]


def facts(spark, points):
    """points: (station, metric, time, value)"""
    data = [
        (s, m, t, None if v is None else Decimal(str(v)), "x", t, False, "r") for s, m, t, v in points
    ]
    return spark.createDataFrame(data, FACT)


@pytest.fixture(scope="module")
def metric(spark):
    return spark.createDataFrame([(1, "air_temp_c"), (2, "rel_hum_pct"), (3, "other")], "metric_id long, metric_code string")


@pytest.fixture(scope="module")
def station(spark):
    flags = [(1, True, False), (2, True, False), (3, False, False), (4, True, True), (5, None, False), (6, True, None)]
    return spark.createDataFrame(flags, "station_id long, is_current boolean, is_smoketest boolean")


def jump(spark, station, metric, points, rising=True, thresholds={"air_temp_c": 5.0}):
    return d.jump_findings(series_heads(facts(spark, points)), station, metric, thresholds, rising)


def test_threshold_is_strict_and_exact(spark, station, metric):
    before = NOW - timedelta(hours=1)
    points = [
        (1, 1, before, 16.3), (1, 1, NOW, 21.3),            # exactly 5.0
        (2, 1, before, 16.3), (2, 1, NOW, 21.300001),       # a hair more
    ]
    assert rows(jump(spark, station, metric, points), "station_id", "delta") == [(2, Decimal("5.000001"))]


def test_lookback_is_inclusive(spark, station, metric):
    edge = NOW - timedelta(minutes=180)
    points = [
        (1, 1, edge, 0), (1, 1, NOW, 50),
        (2, 1, edge - timedelta(microseconds=1), 0), (2, 1, NOW, 50),
    ]
    assert rows(jump(spark, station, metric, points), "station_id") == [(1,)]


def test_metric_without_threshold_never_alerts(spark, station, metric):
    points = [(1, 3, NOW - timedelta(hours=1), 0), (1, 3, NOW, 999)]
    assert rows(jump(spark, station, metric, points), "station_id") == []
    assert rows(jump(spark, station, metric, points, thresholds={}), "station_id") == []


def test_threshold_frame_equals_mapping(spark, station, metric):
    points = [(s, 1, NOW - timedelta(minutes=m), v) for s, m, v in ((1, 30, 0), (1, 0, 9), (2, 30, 0), (2, 0, 4))]
    frame = spark.createDataFrame([("air_temp_c", 5.0)], "metric_code string, threshold double")
    by_frame = jump(spark, station, metric, points, thresholds=frame)
    assert rows(by_frame, "station_id", "threshold") == rows(jump(spark, station, metric, points), "station_id", "threshold")


def test_only_monitored_stations_are_reported(spark, station, metric):
    points = [p for s in range(1, 7) for p in ((s, 1, NOW - timedelta(hours=1), 0), (s, 1, NOW, 50))]
    assert rows(jump(spark, station, metric, points), "station_id") == [(1,), (2,)]


series = st.lists(
    st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(-20, 20))),
    min_size=1, max_size=7, unique_by=lambda p: p[0],
)


@hypothesis_settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(series, min_size=1, max_size=12))
def test_pairs_equal_full_history_lag(spark, many):
    """Brute force over the whole series: lag, drop rows without a previous value, take the newest."""
    points, expected = [], []
    for number, one in enumerate(many):
        ordered = sorted(one)
        points += [(number, 1, NOW + timedelta(hours=h), v) for h, v in ordered]
        candidates = [
            (h, v, ordered[i - 1]) for i, (h, v) in enumerate(ordered) if i and ordered[i - 1][1] is not None
        ]
        if candidates and candidates[-1][1] is not None:
            h, v, (ph, pv) = candidates[-1]
            # The newest row with a previous value alerts only if it has a value itself.
            if h == ordered[-1][0]:
                expected.append((number, Decimal(v), Decimal(pv)))
    got = rows(latest_pairs(series_heads(facts(spark, points))), "station_id", "last_value", "prev_value")
    assert got == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    # A row that is not the newest never alerts: its successor has a null previous value
    # only if the row itself has no value.
    for one in many:
        ordered = sorted(one)
        for i in range(1, len(ordered) - 1):
            later = [j for j in range(i + 1, len(ordered)) if ordered[j - 1][1] is not None]
            assert later or ordered[i][1] is None


def test_spike_of_negated_values_is_drop(spark, station, metric):
    points = [
        (1, 1, NOW - timedelta(hours=1), 3), (1, 1, NOW, 11), (2, 1, NOW - timedelta(hours=1), 8), (2, 1, NOW, 1),
        (1, 2, NOW - timedelta(hours=1), 3), (1, 2, NOW, 40), (2, 2, NOW - timedelta(hours=1), 30), (2, 2, NOW, 1),
    ]
    limits = {"air_temp_c": 5.0, "rel_hum_pct": 15.0}
    negated = [(s, m, t, -v) for s, m, t, v in points]
    spikes = jump(spark, station, metric, points, True, limits)
    drops = jump(spark, station, metric, negated, False, limits)
    assert rows(spikes, "station_id", "metric_id") == rows(drops, "station_id", "metric_id") != []


def test_flatline_edges(spark, station, metric):
    def run(station_id, metric_id, values, start=NOW - timedelta(minutes=180)):
        return [(station_id, metric_id, start + timedelta(minutes=30 * i), v) for i, v in enumerate(values)]

    points = (
        run(1, 1, [5, 5.2, 5, 5, 5, 5])                 # six points, range exactly epsilon
        + run(2, 1, [5, 5, 5, 5, 5])                    # five points
        + run(1, 2, [50, None, None, 51, 50, 50])       # nulls count as points
        + run(2, 2, [50, 50, 50, 50, 50, 51.000001])    # a hair too wide
        + run(1, 3, [1, 1, 1, 1, 1, 1])                 # no epsilon
    )
    found = d.flatline_findings(facts(spark, points), station, metric, as_of=NOW)
    assert rows(found, "station_id", "metric_id", "points") == [(1, 1, 6), (1, 2, 6)]
    # One microsecond later the first point leaves the window.
    later = d.flatline_findings(facts(spark, points), station, metric, as_of=NOW + timedelta(microseconds=1))
    assert rows(later, "station_id") == []
    # No upper bound: observations after as_of count.
    future = run(1, 1, [5] * 6, NOW + timedelta(days=1))
    assert rows(d.flatline_findings(facts(spark, future), station, metric, as_of=NOW), "points") == [(6,)]


def test_silent_edges(spark, station):
    points = [(1, 1, NOW - timedelta(minutes=30), 1), (3, 1, NOW, 1)]
    # Station 1 is exactly at the limit, 2 was never seen; the others are not watched.
    found = d.silent_findings(facts(spark, points), station, NOW)
    assert rows(found) == [(2, None, None)]
    later = d.silent_findings(facts(spark, points), station, NOW + timedelta(microseconds=1))
    assert rows(later, "station_id", "minutes_silent") == [(1, Decimal("30.00")), (2, None)]
    # A future observation keeps a station alive.
    ahead = d.silent_findings(facts(spark, [(1, 1, NOW + timedelta(hours=2), 1), (2, 1, NOW, 1)]), station, NOW)
    assert rows(ahead) == []


def test_stale_rounds_half_up(spark, station):
    # 200 minutes and 0.3 s = 200.005 minutes
    seen = NOW - timedelta(minutes=200, milliseconds=300)
    found = d.stale_findings(facts(spark, [(1, 1, seen, 1), (1, 2, NOW - timedelta(minutes=120), 1)]), station, NOW)
    assert rows(found, "metric_id", "minutes_stale") == [(1, Decimal("200.01"))]


def test_stations_do_not_go_through_the_driver(spark, tmp_path):
    """A stored dimension is guessed far too small by its compressed file; its keys are merged at every size."""
    many = spark.range(0, 20_000, 1, 2).select(
        F.col("id").alias("station_id"), F.lit(True).alias("is_current"), F.lit(False).alias("is_smoketest"))
    many.write.parquet(str(tmp_path / "stations"))
    points = facts(spark, [(7, 1, NOW - timedelta(days=30), 1.0), (20_001, 1, NOW - timedelta(days=30), 1.0)])
    found = d.stale_findings(points, spark.read.parquet(str(tmp_path / "stations")), NOW)
    assert rows(found, "station_id", "metric_id") == [(7, 1)]
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan, plan


def test_common_shape_keeps_null_details(spark, station, metric):
    observed = d.Observed(facts(spark, []), station, metric)
    found = d.detect_all(observed, as_of=NOW)
    assert found.columns == ["anomaly_type", "station_id", "metric_id", "severity", "details", "detector"]
    assert rows(found, "station_id", "details") == [
        (s, '{"last_observed_at":null,"minutes_silent":null}') for s in (1, 2)
    ]


def test_day_partition_prunes_without_changing_the_result(spark, station, metric):
    points = [(1, 1, NOW - timedelta(minutes=30 * i), 5) for i in range(20)]
    plain = facts(spark, points)
    by_day = plain.withColumn("observed_date", F.to_date("observed_at"))
    args = (station, metric, {"air_temp_c": 1}, NOW, 600, 6)
    assert rows(d.flatline_findings(by_day, *args)) == rows(d.flatline_findings(plain, *args)) != []


def test_switched_off_types(spark, station, metric):
    found = d.detect_all(d.Observed(facts(spark, []), station, metric), as_of=NOW)
    types = spark.createDataFrame([("silent_station", False), ("spike", True)], "anomaly_type string, is_enabled boolean")
    assert found.count() == 2 and d.enabled_only(found, types).count() == 0


def test_plugged_in_detector(spark, station, metric):
    def every_fact(observed, config, as_of):
        return d.as_anomalies(observed.fact.select("station_id", "metric_id", "value_num"), "seen", "low")

    observed = d.Observed(facts(spark, [(1, 1, NOW, 1)]), station, metric)
    found = d.detect_all(observed, as_of=NOW, detectors=[d.Detector("seen", every_fact)])
    assert rows(found, "detector", "anomaly_type", "severity", "details") == [
        ("seen", "seen", "low", '{"value_num":1.000000}')
    ]
    counts = d.detector_counts(found, found.limit(0), found.where(F.lit(False)))
    assert rows(counts) == [("seen", 1, 0, 0)]
