"""The four jobs end to end on stored tables."""

import json
import re
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from tidewarden import settings
from tidewarden.operators import detectors, quality
from tidewarden.operators.series import series_heads
from tidewarden.plans import jobs, views
from tidewarden.schemas import SCHEMAS
from tidewarden.sources.warehouse import Warehouse, touched_days

START = at("2024-03-01 00:00:00")
CODES = ("temperature_2m", "relative_humidity_2m")
CHECKS = [
    quality.CheckDefinition(1, "fact_freshness_minutes", "critical", 120, "<="),
    quality.CheckDefinition(2, "late_data_rate_pct", "warning", 5, "<="),
    quality.CheckDefinition(3, "rows_of_run", "warning", 1, ">=", True,
                            "SELECT count(*) AS metric_value FROM fact_observation WHERE ingest_run_id = :run_id"),
]
CONFIG = detectors.DetectorConfig(spike={"temperature_2m": 5}, drop={"temperature_2m": 5}, flatline={})


def land(folder, hour, values):
    """One document per station with a single hour."""
    folder.mkdir()
    time = (START + timedelta(hours=hour)).strftime("%Y-%m-%dT%H:%M")
    documents = [
        {"station_external_id": f"s{i}", "latitude": 1.0, "longitude": 2.0,
         "hourly": {"time": [time], "temperature_2m": [v], "relative_humidity_2m": [50]}, "hourly_units": {}}
        for i, v in enumerate(values, start=1)
    ]
    (folder / "part.json").write_text("\n".join(map(json.dumps, documents)))
    return str(folder)


@pytest.fixture
def warehouse(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "tables"))
    stations = [
        (i, "x", f"s{i}", f"Station {i}", "st", "N", Decimal(1), Decimal(2), START, None, True, smoke)
        for i, smoke in ((1, False), (2, False), (3, True))
    ]
    wh.overwrite("dim_station", spark.createDataFrame(stations, SCHEMAS["dim_station"]))
    metrics = [(i, c, "u", "numeric", Decimal(0), Decimal(100), True, None) for i, c in enumerate(CODES, start=1)]
    wh.overwrite("dim_metric", spark.createDataFrame(metrics, SCHEMAS["dim_metric"]))
    return wh


def test_the_four_jobs(spark, warehouse, tmp_path):
    wh = warehouse
    first = jobs.ingest(wh, land(tmp_path / "h0", 0, [10, 10, 10]), START + timedelta(minutes=1))
    # The smoke-test station is not ingested.
    assert rows(wh.read("raw_observations"), "station_external_id", "metric_code", "value_num") == [
        ("s1", "relative_humidity_2m", Decimal(50)), ("s1", "temperature_2m", Decimal(10)),
        ("s2", "relative_humidity_2m", Decimal(50)), ("s2", "temperature_2m", Decimal(10)),
    ]
    second = jobs.ingest(wh, land(tmp_path / "h1", 1, [20, 11]), START + timedelta(hours=1, minutes=1))
    # The first hour is delivered again with a correction: two rows change, two repeat.
    third = jobs.ingest(wh, land(tmp_path / "h0b", 0, [12, 10]), START + timedelta(hours=2))
    ledger = wh.read("ops_job_run")
    assert {r.run_id: (r.status, r.rows_inserted, r.rows_updated) for r in ledger.collect()} == {
        first: ("succeeded", 4, 0), second: ("succeeded", 4, 0), third: ("succeeded", 0, 4),
    }
    assert ledger.where(f"run_id = '{second}'").first().watermark_to == START + timedelta(hours=1)

    # The re-delivered rows moved to the third run, so the first has nothing left.
    assert jobs.transform_runs(wh, START + timedelta(hours=2, minutes=5)) == 3
    assert jobs.transform_runs(wh, START + timedelta(hours=2, minutes=6)) == 0
    facts = rows(wh.read("fact_observation").where("metric_id = 1"), "station_id", "observed_at", "value_num", "ingest_run_id")
    hour = START + timedelta(hours=1)
    assert facts == [
        (1, START, Decimal(12), third), (1, hour, Decimal(20), second),
        (2, START, Decimal(10), third), (2, hour, Decimal(11), second),
    ]
    done = wh.read("ops_job_run").where(f"job_name = '{settings.TRANSFORM_JOB}'")
    assert rows(done, "parent_run_id", "rows_inserted", "status") == sorted(
        [(first, 0, "succeeded"), (second, 4, "succeeded"), (third, 4, "succeeded")])

    now = START + timedelta(hours=2, minutes=10)
    assert jobs.check_runs(wh, now, CHECKS) == 9
    assert jobs.check_runs(wh, now + timedelta(minutes=1), CHECKS) == 0
    results = wh.read("ops_dq_check_run")
    assert rows(results.where("check_name = 'rows_of_run'"), "run_id", "status") == sorted(
        [(first, "warn"), (second, "pass"), (third, "pass")])
    assert rows(results.where("check_name = 'late_data_rate_pct'"), "run_id", "reason") == sorted(
        [(first, "null_metric"), (second, None), (third, None)])

    jobs.detect_and_open_incidents(wh, now, CONFIG)
    assert rows(wh.read("ops_anomaly"), "anomaly_type", "station_id") == [
        ("silent_station", 1), ("silent_station", 2), ("spike", 1)]
    opened = wh.read("ops_incident")
    assert opened.count() == 3 and wh.read("ops_incident_anomaly").count() == 3
    assert rows(wh.read("ops_anomaly_detector_run"), "detector_name", "rows_detected", "rows_inserted", "rows_linked") == [
        ("drop", 0, 0, 0), ("flatline", 0, 0, 0), ("silent_station", 2, 2, 2), ("spike", 1, 1, 1), ("stale_data", 0, 0, 0)]

    # Within the hour nothing is new; in the next hour the same incidents are touched.
    jobs.detect_and_open_incidents(wh, now + timedelta(minutes=10), CONFIG)
    assert wh.read("ops_anomaly").count() == 3
    later = now + timedelta(hours=1)
    jobs.detect_and_open_incidents(wh, later, CONFIG)
    assert wh.read("ops_anomaly").where(f"detected_at = timestamp'{later}'").count() == 7
    again = wh.read("ops_incident")
    assert rows(again.where("anomaly_type IN ('spike', 'silent_station')"), "incident_id", "last_seen_at") == sorted(
        (r.incident_id, later) for r in opened.collect())
    assert again.count() == 7 and wh.read("ops_incident_anomaly").count() == 10

    tables = {n: wh.read(n) for n in SCHEMAS if n != "ops_job_event"}
    page = views.control_tower(tables, later)
    assert page["status"].first().status == "RED"
    assert page["incidents"].first().open_count == 7


def test_a_failed_detector_is_recorded(warehouse):
    def broken(observed, config, as_of):
        return observed.fact.select("no_such_column")

    with pytest.raises(Exception, match="no_such_column"):
        jobs.detect_and_open_incidents(warehouse, START, CONFIG, [detectors.Detector("broken", broken)])
    assert warehouse.read("ops_job_run").first().status == "failed"
    run = warehouse.read("ops_anomaly_detector_run").first()
    assert (run.detector_name, run.status, run.rows_detected) == ("broken", "failed", 0)
    assert "no_such_column" in run.error_message


def test_a_failed_run_is_recorded(warehouse, tmp_path):
    broken = land(tmp_path / "bad", 0, [1])
    (tmp_path / "bad" / "part.json").write_text(
        json.dumps({"station_external_id": "s1", "hourly": {"time": ["not a time"], "temperature_2m": [1]}}))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        jobs.ingest(warehouse, broken, START)
    run = warehouse.read("ops_job_run").first()
    assert run.status == "failed" and "CAST_INVALID_INPUT" in run.error_message and len(run.error_message) <= 4000
    assert warehouse.read("raw_observations").count() == 0
    assert jobs.transform_runs(warehouse, START) == 0


def test_ingest_again_at_the_same_time_is_the_same_run(warehouse, tmp_path):
    folder = land(tmp_path / "h0", 0, [10])
    runs = {jobs.ingest(warehouse, folder, START) for _ in range(2)}
    assert len(runs) == 1
    assert warehouse.read("raw_observations").count() == 2
    assert rows(warehouse.read("ops_job_run"), "rows_inserted", "rows_updated") == [(2, 0)]


def test_a_merge_replaces_only_the_days_it_touches(spark, warehouse):
    def facts(day, value, run):
        when = START + timedelta(days=day)
        return spark.createDataFrame([(1, 1, when, Decimal(value), "x", when, False, run)], SCHEMAS["fact_observation"])

    for day in range(3):
        warehouse.merge_facts(facts(day, 1, "a"))
    files = {f for f in warehouse.stored("fact_observation").inputFiles()}
    warehouse.merge_facts(facts(1, 2, "b"))
    after = {f for f in warehouse.stored("fact_observation").inputFiles()}
    assert len(files & after) == 2 and len(after) == 3
    assert rows(warehouse.read("fact_observation"), "value_num") == [(Decimal(1),), (Decimal(1),), (Decimal(2),)]
    warehouse.merge_facts(facts(1, 2, "b"))
    assert warehouse.read("fact_observation").count() == 3
    plan = warehouse.stored("fact_observation").where(
        touched_days(facts(1, 2, "b"), F.to_date("observed_at"), "observed_date")
    )._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*observed_date#\d+ = \d+", plan) and "DataFilters: []" in plan


def test_a_bad_template_leaves_the_other_checks_and_is_tried_again(warehouse, tmp_path):
    wh = warehouse
    jobs.ingest(wh, land(tmp_path / "h0", 0, [10]), START)
    jobs.transform_runs(wh, START + timedelta(minutes=1))
    bad = quality.CheckDefinition(9, "bad", "warning", 1, ">=", True, "SELECT no_such_column AS metric_value FROM fact_observation WHERE ingest_run_id = :run_id")
    at_run_time = quality.CheckDefinition(10, "late", "warning", 1, ">=", True, "SELECT CAST(source AS INT) AS metric_value FROM fact_observation WHERE ingest_run_id = :run_id LIMIT 1")
    assert jobs.check_runs(wh, START + timedelta(minutes=2), [*CHECKS, bad, at_run_time]) == len(CHECKS)
    run = wh.read("ops_job_run").where(f"job_name = '{settings.CHECKS_JOB}'").first()
    assert run.status == "failed" and run.ended_at >= run.started_at and run.rows_inserted == len(CHECKS)
    assert "bad: " in run.error_message and "no_such_column" in run.error_message
    assert rows(wh.read("ops_dq_check_outcome"), "check_name", "status", "n_results") == sorted(
        [("bad", "failed", 0), ("late", "failed", 0)] + [(c.name, "succeeded", 1) for c in CHECKS])
    # The next call computes what is missing, once the template is mended; stored results stay.
    mended = bad._replace(sql_template=CHECKS[2].sql_template)
    assert jobs.check_runs(wh, START + timedelta(minutes=3), [*CHECKS, mended]) == 1
    assert jobs.check_runs(wh, START + timedelta(minutes=4), [*CHECKS, mended]) == 0
    assert wh.read("ops_dq_check_run").count() == len(CHECKS) + 1
    # Nothing could be computed at all: that is an error, and the runs stay eligible.
    jobs.ingest(wh, land(tmp_path / "h1", 1, [10]), START + timedelta(minutes=5))
    jobs.transform_runs(wh, START + timedelta(minutes=6))
    with pytest.raises(Exception, match="no_such_column"):
        jobs.check_runs(wh, START + timedelta(minutes=7), [bad])
    assert jobs.check_runs(wh, START + timedelta(minutes=8), CHECKS) == len(CHECKS)


@pytest.mark.parametrize("table", ["ops_incident", "ops_incident_anomaly", "ops_anomaly"])
def test_detection_that_stops_at_a_write_is_completed_by_a_rerun(warehouse, tmp_path, monkeypatch, table):
    wh = warehouse
    jobs.ingest(wh, land(tmp_path / "h0", 0, [10, 10]), START)
    jobs.transform_runs(wh, START + timedelta(minutes=1))
    append = wh.append

    def stop(name, df):
        if name == table:
            raise OSError("lost")
        append(name, df)

    now = START + timedelta(hours=2)
    monkeypatch.setattr(wh, "append", stop)
    with pytest.raises(OSError, match="lost"):
        jobs.detect_and_open_incidents(wh, now, CONFIG)
    monkeypatch.setattr(wh, "append", append)
    jobs.detect_and_open_incidents(wh, now, CONFIG)
    anomalies = rows(wh.read("ops_anomaly"), "anomaly_type", "station_id")
    assert anomalies == [("silent_station", 1), ("silent_station", 2)]
    assert rows(wh.read("ops_incident"), "anomaly_type", "station_id", "status") == [(*a, "open") for a in anomalies]
    assert rows(wh.read("ops_incident_anomaly"), "anomaly_id") == rows(wh.read("ops_anomaly"), "anomaly_id")
    assert {r.status for r in wh.read("ops_anomaly_detector_run").collect()} == {"succeeded"}
    assert wh.read("ops_anomaly_detector_run").count() == 5


def test_broken_lines_are_set_aside(warehouse, tmp_path):
    folder = land(tmp_path / "h0", 0, [10, 11])
    whole = (tmp_path / "h0" / "part.json").read_text().split("\n")
    wrong_kind = whole[0].replace('"latitude": 1.0', '"latitude": "north"').replace('"s1"', '"s9"')
    (tmp_path / "h0" / "more.json").write_text("\n".join([whole[0][:40], "[1, 2", wrong_kind]))
    run = jobs.ingest(warehouse, folder, START)
    noted = warehouse.read("ops_job_run").first()
    assert (noted.run_id, noted.status, noted.rows_inserted, noted.rows_rejected) == (run, "succeeded", 4, 3)
    aside = warehouse.read("ops_rejected_document")
    assert rows(aside, "record") == sorted([(whole[0][:40],), ("[1, 2",), (wrong_kind,)], key=lambda r: (False, str(r[0])))
    assert {r.source_file.rsplit("/")[-1] for r in aside.collect()} == {"more.json"}
    assert {r.run_id for r in aside.collect()} == {run}


def test_a_transform_reads_the_days_and_rows_of_its_runs(warehouse, tmp_path):
    wh = warehouse
    runs = [jobs.ingest(wh, land(tmp_path / f"d{day}", 24 * day, [10 + day, 20]), START + timedelta(days=day)) for day in range(4)]
    assert rows(wh.read("ops_run_day"), "run_id", "observed_date", "n_rows") == sorted(
        ((run, (START + timedelta(days=day)).date(), 4) for day, run in enumerate(runs)), key=lambda r: (False, str(r[0])))
    work = wh.read("ops_job_run").where(F.col("run_id") == runs[2]).select("run_id")
    noted = wh.read("ops_run_day").join(work, "run_id", "left_semi")
    plan = wh.current_raw(touched_days(noted, F.col("observed_date"), "observed_date"), work)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan parquet" in x and "ingest_run_id" in x]
    day = (START + timedelta(days=2)).date().isoformat()
    assert len(scans) == 2 and all(re.search(rf"PartitionFilters: \[[^]]*observed_date#\d+ = {day}", x) for x in scans)
    assert any(f"EqualTo(ingest_run_id,{runs[2]})" in x for x in scans)
    assert jobs.transform_runs(wh, START + timedelta(days=9), [runs[2]]) == 1
    assert {r.ingest_run_id for r in wh.read("fact_observation").collect()} == {runs[2]}


def test_runs_without_noted_days_are_found_by_their_watermarks(warehouse, tmp_path):
    wh = warehouse
    append = wh.append
    wh.append = lambda name, df: None if name == "ops_run_day" else append(name, df)
    jobs.ingest(wh, land(tmp_path / "h0", 0, [10]), START)
    wh.append = append
    jobs.ingest(wh, land(tmp_path / "h30", 30, [11]), START + timedelta(hours=30))
    assert jobs.transform_runs(wh, START + timedelta(days=9)) == 2
    assert wh.read("fact_observation").count() == 4


def test_the_summary_follows_the_facts(spark, warehouse):
    wh = warehouse
    key = ["station_id", "metric_id", "observed_at"]

    def facts(*data):
        full = [(s, 1, START + timedelta(hours=h), Decimal(v), src, START + timedelta(hours=i), False, run) for s, h, v, i, run, src in data]
        return spark.createDataFrame(full, SCHEMAS["fact_observation"])

    def newest():
        return rows(series_heads(wh.stored("fact_observation")))

    # Late rows, corrections, ties that only the run or the value decides, and an older row that a named run puts back.
    wh.merge_facts(facts((1, 1, 10, 1, "a", "x"), (1, 2, 20, 2, "a", "x"), (2, 5, 50, 5, "a", "x")), newest_wins=True)
    wh.merge_facts(facts((1, 2, 21, 2, "b", "x"), (1, 0, 5, 9, "b", "x"), (2, 4, 40, 5, "b", "x")), newest_wins=True)
    assert rows(wh.heads(), *key, "value_num") == newest()
    wh.merge_facts(facts((1, 2, 19, 2, "a", "y"), (2, 5, 51, 5, "a", "x"), (3, 1, 1, 1, "c", "x")), newest_wins=True)
    assert rows(wh.heads(), *key, "value_num") == newest()
    assert {(r.station_id, int(r.value_num)) for r in wh.heads().collect()} == {(1, 10), (1, 21), (2, 40), (2, 51), (3, 1)}
    wh.merge_facts(facts((1, 2, 18, 0, "a", "x")))
    assert rows(wh.heads(), *key, "value_num") == newest() and wh.heads().where("value_num = 18").count() == 1
    before = rows(wh.heads())
    wh.rebuild_heads()
    assert rows(wh.heads()) == before


def test_the_order_of_batches_does_not_matter(spark, tmp_path):
    same = [(1, 1, START, Decimal(v), src, START, False, run) for v, src, run in ((1, "x", "a"), (2, "x", "a"), (1, "y", "a"), (9, "w", "a"), (0, "x", "b"))]
    results = []
    for k, order in enumerate(([0, 1, 2, 3, 4], [4, 3, 2, 1, 0], [2, 4, 0, 3, 1])):
        wh = Warehouse(spark, str(tmp_path / str(k)))
        for i in order:
            wh.merge_facts(spark.createDataFrame([same[i]], SCHEMAS["fact_observation"]), newest_wins=True)
        results.append((rows(wh.read("fact_observation"), "value_num", "source"), rows(wh.heads(), "value_num", "source")))
    assert results == [([(Decimal(0), "x")], [(Decimal(0), "x")])] * 3


def test_quiet_detectors_and_views_leave_the_facts_unread(spark, warehouse):
    wh = warehouse
    full = [(1, 1, START + timedelta(hours=h), Decimal(h), "x", START, False, "r") for h in range(5)]
    wh.merge_facts(spark.createDataFrame(full, SCHEMAS["fact_observation"]))
    observed = detectors.Observed(wh.stored("fact_observation"), wh.read("dim_station"), wh.read("dim_metric"), wh.heads())
    found = detectors.detect_all(observed, CONFIG, START, [d for d in detectors.BUILT_IN if d.name != "flatline"])
    for df in (found, views.station_freshness(wh.heads(), wh.read("dim_station"), START), quality.freshness_minutes(wh.heads(), START)):
        files = df.inputFiles()
        assert any("/series_head/" in f for f in files) and not any("/fact_observation/" in f for f in files)
