from datetime import timedelta

import pytest

from conftest import at, rows
from tidewarden.operators import incidents as inc

NOW = at("2024-03-01 12:00:00")
KEY = ("spike", 1, 1)


def incident_frame(spark, *data):
    return spark.createDataFrame(
        [(i, s, t, st, m, c, c) for i, s, (t, st, m), c in data],
        "incident_id string, status string, anomaly_type string, station_id long, metric_id long, "
        "created_at timestamp, last_seen_at timestamp")


def anomaly_frame(spark, *data):
    return spark.createDataFrame(
        [(i, t, s, m, NOW + timedelta(minutes=n), "high" if n else "medium", f"d{i}") for n, (i, (t, s, m)) in enumerate(data)],
        "anomaly_id string, anomaly_type string, station_id long, metric_id long, detected_at timestamp, severity string, details string")


@pytest.fixture(scope="module")
def stored(spark):
    return incident_frame(
        spark, ("old", "open", KEY, NOW - timedelta(days=9)), ("new", "acknowledged", KEY, NOW - timedelta(days=1)),
        ("done", "resolved", KEY, NOW), ("silent", "open", ("silent_station", 2, None), NOW),
        ("gone", "resolved", ("drop", 3, 1), NOW),
    )


def test_get_or_create(spark, stored):
    found = anomaly_frame(
        spark, ("a1", KEY), ("a2", KEY), ("a3", ("silent_station", 2, None)), ("a4", ("silent_station", 3, None)),
        ("a5", ("drop", 3, 1)), ("a6", ("drop", 3, 1)), ("a7", ("spike", 1, None)),
    )
    resolved = inc.resolve_incidents(stored, found)
    assert rows(resolved, "anomaly_type", "station_id", "metric_id", "is_new") == [
        ("drop", 3, 1, True), ("silent_station", 2, None, False), ("silent_station", 3, None, True),
        ("spike", 1, 1, False), ("spike", 1, None, True),
    ]
    assert rows(resolved.where("NOT is_new"), "incident_id") == [("new",), ("silent",)]
    opened = inc.opened_incidents(resolved, NOW)
    assert rows(opened, "title", "status", "anomaly_id", "details", "severity", "opened_at") == [
        ("drop @ station 3 metric 1", "open", "a5", "da5", "high", NOW),
        ("silent_station @ station 3 metric None", "open", "a4", "da4", "high", NOW),
        ("spike @ station 1 metric None", "open", "a7", "da7", "high", NOW),
    ]
    links = inc.link_incidents(spark.createDataFrame([("new", "a1")], "incident_id string, anomaly_id string"),
                               resolved, found, NOW)
    assert links.count() == 6 and rows(links.where("incident_id = 'new'"), "anomaly_id") == [("a2",)]
    drop = links.where("anomaly_id IN ('a5', 'a6')").select("incident_id").distinct()
    assert drop.count() == 1
    later = NOW + timedelta(days=1)
    touched = inc.touch_incidents(stored, resolved, later)
    assert rows(touched.where(touched.last_seen_at == later), "incident_id") == [("new",), ("silent",)]
    assert touched.count() == stored.count()


def test_the_same_anomalies_open_the_same_incident(spark, stored):
    found = anomaly_frame(spark, ("a5", ("drop", 3, 1)))
    first = inc.opened_incidents(inc.resolve_incidents(stored, found), NOW)
    assert rows(first, "incident_id") == rows(inc.opened_incidents(inc.resolve_incidents(stored, found), NOW), "incident_id")
    # Once stored it is live, so the next anomaly of the key reuses it.
    both = stored.unionByName(first.select(*stored.columns))
    again = inc.resolve_incidents(both, anomaly_frame(spark, ("a9", ("drop", 3, 1))))
    assert rows(again, "incident_id", "is_new") == [(first.first().incident_id, False)]
