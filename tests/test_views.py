from datetime import timedelta

import pytest

from conftest import at, rows
from tidewarden.plans import views
from tidewarden.schemas import SCHEMAS

NOW = at("2024-03-01 12:00:00")
INGEST = "ingest_openmeteo_all_stations"


def table(spark, name, *data):
    fields = SCHEMAS[name].fieldNames()
    return spark.createDataFrame([tuple(d.get(f) for f in fields) for d in data], SCHEMAS[name])


def fact(spark, *times):
    return table(spark, "fact_observation", *[{"station_id": s, "metric_id": 1, "observed_at": t} for s, t in times])


def incident(**given):
    return {"incident_id": "1", "status": "open", "anomaly_type": "stale_data", "station_id": 1, **given}


def status(spark, facts=(), incidents=(), checks=(), runs=()):
    df = views.platform_status(
        fact(spark, *facts), table(spark, "ops_incident", *incidents), table(spark, "ops_dq_check_run", *checks),
        table(spark, "ops_job_run", *runs), NOW,
    )
    assert df.count() == 1
    return df.first()


def test_platform_status_on_empty_tables_is_green(spark):
    row = status(spark)
    assert (row.status, row.worst_freshness_minutes, row.bad_checks, row.open_incidents, row.last_ingest) == ("GREEN", 0, 0, 0, None)


@pytest.mark.parametrize(("given", "expected"), [
    ({"incidents": [incident(status="acknowledged")]}, "RED"),
    ({"incidents": [incident(status="resolved")]}, "GREEN"),
    ({"incidents": [incident(status=None)]}, "GREEN"),
    ({"checks": [{"status": "warn", "evaluated_at": NOW - timedelta(hours=24)}]}, "AMBER"),
    ({"checks": [{"status": "fail", "evaluated_at": NOW - timedelta(hours=24, microseconds=1)}]}, "GREEN"),
    ({"checks": [{"status": "pass", "evaluated_at": NOW}]}, "GREEN"),
    ({"facts": [(1, NOW - timedelta(minutes=120, seconds=59))]}, "GREEN"),
    ({"facts": [(1, NOW - timedelta(minutes=121))]}, "AMBER"),
    ({"facts": [(1, NOW + timedelta(hours=5))]}, "GREEN"),
])
def test_platform_status_rules(spark, given, expected):
    assert status(spark, **given).status == expected


def test_last_ingest_counts_succeeded_ingests_only(spark):
    runs = [
        {"run_id": "a", "job_name": INGEST, "status": "succeeded", "started_at": NOW - timedelta(days=2)},
        {"run_id": "b", "job_name": INGEST, "status": "failed", "started_at": NOW},
        {"run_id": "c", "job_name": "other", "status": "succeeded", "started_at": NOW},
    ]
    assert status(spark, runs=runs).last_ingest == NOW - timedelta(days=2)


def test_latest_result_with_missing_time_comes_first(spark):
    checks = table(
        spark, "ops_dq_check_run",
        {"dq_run_id": "1", "check_name": "a", "status": "pass", "evaluated_at": NOW},
        {"dq_run_id": "2", "check_name": "a", "status": "warn", "evaluated_at": None},
        {"dq_run_id": "3", "check_name": "b", "status": "pass", "evaluated_at": NOW},
        {"dq_run_id": "4", "check_name": "b", "status": None, "evaluated_at": NOW - timedelta(hours=1)},
    )
    assert [tuple(r) for r in views.dq_summary(checks).collect()] == [("b", "succeeded", NOW), ("a", "failed", None)]


def test_pipeline_health_breaks_ties_by_id(spark):
    runs = table(
        spark, "ops_job_run",
        {"run_id": "a", "job_name": "j", "status": "failed", "started_at": NOW},
        {"run_id": "b", "job_name": "j", "status": "succeeded", "started_at": NOW},
    )
    assert rows(views.pipeline_health(runs)) == [("j", NOW, "succeeded")]


def test_freshness_and_health_labels_at_their_limits(spark):
    ages = {1: 3600, 2: 3600.5, 3: 7200, 4: 7201, 5: 6 * 3600, 6: 6 * 3600 + 0.5, 7: -60}
    facts = fact(spark, *[(s, NOW - timedelta(seconds=a)) for s, a in ages.items()])
    stations = table(spark, "dim_station", *[
        {"station_id": s, "station_name": str(s), "is_current": True, "is_smoketest": False} for s in range(1, 9)
    ])
    fresh = views.station_freshness(facts, stations, NOW)
    assert [r[1] for r in rows(fresh, "station_id", "freshness")] == [
        "FRESH", "FRESH", "FRESH", "STALE", "STALE", "STALE", "FRESH", "MISSING"]
    assert [r[1] for r in rows(views.station_health(fresh), "station_id", "freshness")] == [
        "OK", "WARN", "WARN", "WARN", "WARN", "STALE", "OK", "UNKNOWN"]
    assert rows(fresh.where("station_id IN (2, 7)"), "station_id", "staleness_seconds") == [(2, 3600), (7, -60)]
    assert rows(views.station_health(fresh).where("station_id IN (1, 8)"), "last_seen") == [("11:00",), ("—",)]


def test_incident_views(spark):
    incidents = table(
        spark, "ops_incident",
        incident(incident_id="7", created_at=NOW, severity=None, status="resolved", acknowledged_at=NOW),
        incident(incident_id="8", opened_at=NOW - timedelta(days=1), resolved_at=NOW, status="resolved", severity="high"),
        incident(incident_id="9", opened_at=NOW - timedelta(days=3), anomaly_type="silent_station"),
    )
    assert rows(views.incident_summary(incidents), "title", "status", "opened_at", "severity") == [
        ("Silent Station incident #9", "open", NOW - timedelta(days=3), "unknown"),
        ("Stale Data incident #7", "acknowledged", NOW, "unknown"),
        ("Stale Data incident #8", "resolved", NOW - timedelta(days=1), "high"),
    ]
    kpis = views.incident_kpis(incidents, NOW).first()
    assert (kpis.open_count, kpis.resolved_count_total, kpis.resolved_count_24h, kpis.oldest_active_minutes) == (1, 2, 1, 3 * 1440)
    assert (kpis.resolved_in_24h, kpis.oldest_unresolved_minutes) == (1, 3 * 1440)
    assert rows(views.status_conflicts(incidents)) == [("resolved", "acknowledged", 1)]
    newest = views.recent_incidents(incidents, 2).collect()
    assert [r.opened_at for r in newest] == ["2024-03-01 12:00", "2024-02-29 12:00"]


def test_named_views_in_sql(spark):
    names = ("fact_observation", "dim_station", "ops_incident", "ops_dq_check_run", "ops_job_run", "ops_anomaly", "ops_anomaly_type")
    tables = {n: table(spark, n) for n in names}
    tables["ops_anomaly_type"] = table(spark, "ops_anomaly_type", {"anomaly_type": "spike"})
    views.register_views(tables, NOW)
    for view in ("vw_platform_status", "vw_pipeline_health", "vw_dq_summary", "vw_anomaly_summary",
                 "vw_incident_kpis", "vw_incident_summary", "public_station_freshness"):
        spark.sql(f"SELECT * FROM {view}").collect()
    assert rows(spark.table("vw_anomaly_summary")) == [("spike", 0)]
    assert set(views.control_tower(tables, NOW)) == {"status", "pipeline", "dq", "anomalies", "incidents"}


def test_anomaly_summary_boundary(spark):
    def anomaly(number, age):
        return {"anomaly_id": str(number), "anomaly_type": "spike", "detected_at": NOW - age, "severity": "high"}

    anomalies = table(spark, "ops_anomaly", anomaly(1, timedelta(hours=24)), anomaly(2, timedelta(hours=24, microseconds=1)),
                      anomaly(3, -timedelta(hours=1)))
    types = table(spark, "ops_anomaly_type", {"anomaly_type": "spike"}, {"anomaly_type": "drop"})
    assert rows(views.anomaly_summary(anomalies, types, NOW)) == [("drop", 0), ("spike", 2)]
    assert rows(views.anomaly_severity(anomalies, NOW)) == [("spike", "high", 2)]
    assert rows(views.dq_pass_rate(table(spark, "ops_dq_check_run",
        {"check_name": "a", "status": "pass", "evaluated_at": NOW}, {"check_name": "a", "status": None, "evaluated_at": NOW}), NOW)
        ) == [("a", 1, 2, 50.0)]
