from datetime import timedelta
from decimal import Decimal

import pytest

from conftest import at, rows
from tidewarden.operators import ledger, transform
from tidewarden.plans import jobs
from tidewarden.schemas import SCHEMAS

NOW = at("2024-03-01 12:00:00")
RAW = SCHEMAS["raw_observations"]


def raw(spark, *data):
    """data: (external id, metric code, observed_at, ingested_at, value, run)"""
    full = [("x", e, o, m, v if v is None else Decimal(str(v)), None, "u", None, "{}", i, r) for e, m, o, i, v, r in data]
    return spark.createDataFrame(full, RAW)


@pytest.fixture(scope="module")
def station(spark):
    return spark.createDataFrame(
        [(1, "a", True), (2, "b", False), (3, "b", True), (5, "dup", True), (4, "dup", True), (6, "c", None)],
        "station_id long, station_external_id string, is_current boolean")


@pytest.fixture(scope="module")
def metric(spark):
    return spark.createDataFrame([(1, "t", ["temp"]), (2, "h", None)], "metric_id long, metric_code string, aliases array<string>")


def test_late_flag_is_strict(spark, station, metric):
    day = timedelta(hours=24)
    data = raw(spark, ("a", "t", NOW, NOW + day, 1, "r"), ("b", "t", NOW, NOW + day + timedelta(microseconds=1), 1, "r"))
    assert rows(transform.latest_facts(data, station, metric), "station_id", "is_late") == [(1, False), (3, True)]


def test_lookup_rules(spark, station, metric):
    data = raw(
        spark, ("a", "t", NOW, NOW, 1, "r"), ("a", "temp", NOW + timedelta(hours=1), NOW, 2, "r"), ("a", "nope", NOW, NOW, 3, "r"),
        ("a", "h", NOW, NOW, None, "r"), ("dup", "t", NOW, NOW, 4, "r"), ("c", "t", NOW, NOW, 5, "r"), ("zzz", "t", NOW, NOW, 6, "r"),
    )
    facts = transform.latest_facts(data, station, metric)
    assert [(s, m, float(v)) for s, m, v in rows(facts, "station_id", "metric_id", "value_num")] == [
        (1, 1, 1.0), (1, 1, 2.0), (4, 1, 4.0)]
    assert rows(transform.ambiguous_stations(station)) == [("dup", 2)]


def test_later_run_wins_then_later_arrival(spark, station, metric):
    runs = spark.createDataFrame([("r1", NOW), ("r2", NOW + timedelta(hours=1))], "run_id string, started_at timestamp")
    data = raw(
        spark, ("a", "t", NOW, NOW + timedelta(hours=9), 1, "r1"), ("a", "t", NOW, NOW + timedelta(hours=2), 2, "r2"),
        ("a", "t", NOW, NOW + timedelta(hours=3), 3, "r2"), ("a", "t", NOW, NOW + timedelta(hours=99), 4, "other"),
    )
    facts = jobs.transform_pending(data, station, metric, runs)
    assert [(float(v), r) for v, r in rows(facts, "value_num", "ingest_run_id")] == [(3.0, "r2")]


def test_unit_conversion(spark):
    factors = spark.createDataFrame(
        [("°F", "°C", Decimal("0.555556"), Decimal("-17.777778")), ("°C", "°C", Decimal(1), None)],
        "unit string, unit_canonical string, factor decimal(18,6), offset decimal(18,6)")
    data = spark.createDataFrame([(1, Decimal(50), "°F"), (2, Decimal(7), "°C"), (3, Decimal(9), "odd"), (4, None, "°F")],
                                 "id int, value_num decimal(18,6), unit string")
    got = rows(transform.normalize_units(data, factors), "id", "value_num", "unit", "source_unit")
    assert [(i, v and round(float(v), 2), u, s) for i, v, u, s in got] == [
        (1, 10.0, "°C", "°F"), (2, 7.0, "°C", "°C"), (3, 9.0, "odd", "odd"), (4, None, "°C", "°F")]


RUN = "run_id string, job_name string, status string, started_at timestamp, parent_run_id string"


def runs(spark, *data):
    return spark.createDataFrame([(r, j, s, NOW, p) for r, j, s, p in data], RUN)


I, T = "ingest_openmeteo_all_stations", "transform_raw_to_fact"


def test_a_failed_transform_is_not_retried_unless_asked(spark):
    data = runs(
        spark, ("i1", I, "succeeded", None), ("i2", I, "succeeded", None), ("i3", I, "failed", None), ("i4", I, "succeeded", None),
        ("t1", T, "succeeded", "i1"), ("t2", T, "failed", "i2"), ("x", "other", "succeeded", "i4"),
    )
    assert rows(ledger.pending_runs(data), "run_id") == [("i4",)]
    assert rows(ledger.pending_runs(data, retry_failed=True), "run_id") == [("i2",), ("i4",)]


def test_eligible_for_checks(spark):
    data = runs(
        spark, ("i1", I, "succeeded", None), ("i2", I, "succeeded", None), ("i3", I, "succeeded", None), ("i4", I, "failed", None),
        ("t1", T, "succeeded", "i1"), ("t2", T, "failed", "i2"), ("t3", T, "succeeded", "i3"), ("t4", T, "succeeded", "i4"),
        ("t5", T, "succeeded", None),
    )
    results = spark.createDataFrame([("i3",), (None,)], "run_id string")
    assert rows(ledger.eligible_check_runs(data, results), "run_id") == [("i1",)]


def test_manual_selection(spark):
    data = runs(spark, ("i1", I, "failed", None), ("i2", I, "succeeded", None))
    assert rows(jobs.select_runs(data, ["i1"]), "run_id") == [("i1",)]
    with pytest.raises(ValueError):
        jobs.select_runs(data, [])


def test_work_queue_puts_unknown_starts_last(spark):
    data = spark.createDataFrame([("b", NOW), ("c", None), ("a", NOW), ("d", NOW - timedelta(hours=1))], "run_id string, started_at timestamp")
    assert [r.run_id for r in ledger.work_queue(data).collect()] == ["d", "a", "b", "c"]


def test_ledger_fold(spark):
    def start(run, hour):
        return ledger.ledger_start(spark, run, "j", NOW + timedelta(hours=hour), "p")

    events = start("a", 0).unionByName(start("b", 1)).unionByName(
        ledger.ledger_finish(spark, "a", "j", "failed", NOW, error_message="x" * 5000)
    ).unionByName(ledger.ledger_finish(spark, "b", "j", "succeeded", NOW + timedelta(hours=3), {"rows_inserted": 7}))
    state = ledger.ledger_state(events.unionByName(start("c", 2)).unionByName(start("c", 2)))
    got = rows(state, "run_id", "status", "started_at", "ended_at", "rows_inserted", "parent_run_id")
    assert got == [
        ("a", "failed", NOW, NOW, None, "p"),
        ("b", "succeeded", NOW + timedelta(hours=1), NOW + timedelta(hours=3), 7, "p"),
        ("c", "started", NOW + timedelta(hours=2), None, None, "p"),
    ]
    assert len(state.where("run_id = 'a'").first().error_message) == 4000
