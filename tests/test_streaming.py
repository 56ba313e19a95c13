import json
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from acceptance.given import METRIC_ROWS, event_stream
from conftest import at, rows
from tidewarden.functions.lookup import constant_frame
from tidewarden.operators import detectors
from tidewarden.operators.quality import contract_violations
from tidewarden.operators.series import series_heads
from tidewarden.operators.transform import latest_facts
from tidewarden.plans import jobs
from tidewarden.schemas import SCHEMAS
from tidewarden.session import shared_folder
from tidewarden.sources import dictionary
from tidewarden.sources.payloads import stream_payloads
from tidewarden.sources.warehouse import Warehouse
from tidewarden.streaming.heads import HeadStore, jumps_on_arrival, observed_heads, quiet_detectors, update_heads
from tidewarden.streaming.ingest import start_ingest
from tidewarden.streaming.transform import start_transform

NOW = at("2024-03-01 00:00:00")
RAW = SCHEMAS["raw_observations"]


@pytest.fixture(scope="module")
def metric(spark):
    return constant_frame(spark, [(r[0], r[1]) for r in METRIC_ROWS], "metric_id bigint, metric_code string")


@pytest.fixture(scope="module")
def station(spark):
    return constant_frame(spark, [(i, str(i), True, False) for i in range(8)],
                          "station_id bigint, station_external_id string, is_current boolean, is_smoketest boolean")


def deliver(spark, folder, part, data):
    full = [("x", s, t, m, Decimal(v), None, "u", None, "{}", i, "r") for s, m, t, v, i in data]
    spark.createDataFrame(full, RAW).coalesce(1).write.parquet(f"{folder}/part={part}")


def stream(spark, folder):
    return (spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder))


def hour(n):
    return NOW + timedelta(hours=n)


def test_many_batches_equal_one_transform(spark, station, metric):
    folder = shared_folder(spark, "raw")
    # Corrections arrive before and after what they correct; one is four days late.
    deliver(spark, folder, 0, [("1", "click", hour(0), 1, hour(5)), ("2", "view", hour(0), 2, hour(1))])
    deliver(spark, folder, 1, [("1", "click", hour(0), 9, hour(2)), ("1", "click", hour(1), 3, hour(100))])
    deliver(spark, folder, 2, [("2", "view", hour(0), 5, hour(6)), ("nobody", "view", hour(0), 5, hour(6))])
    wh, base = Warehouse(spark, shared_folder(spark, "tables")), shared_folder(spark, "stream")
    store = HeadStore(spark, f"{base}/heads")
    epochs = []

    def advance(facts, epoch):
        epochs.append(epoch)
        store.advance(facts, epoch)

    for _ in range(2):  # The second start finds nothing new.
        start_transform(stream(spark, folder), wh, station, metric, f"{base}/checkpoint", and_then=advance).awaitTermination()
    assert epochs == [0, 1, 2]
    batch = latest_facts(spark.read.schema(RAW).option("recursiveFileLookup", "true").parquet(folder), station, metric)
    assert rows(wh.read("fact_observation")) == rows(batch.select(*SCHEMAS["fact_observation"].fieldNames()))
    assert rows(wh.read("fact_observation").where("is_late"), "observed_at") == [(hour(1),)]
    columns = ["station_id", "metric_id", "observed_at", "value_num"]
    assert rows(store.latest(), *columns) == rows(series_heads(batch), *columns)
    # A replay of the last batch gives the same heads and facts.
    before = rows(store.latest())
    again = latest_facts(spark.read.schema(RAW).parquet(f"{folder}/part=2"), station, metric)
    store.advance(again, 2)
    wh.merge_facts(again, newest_wins=True)
    assert rows(store.latest()) == before and wh.read("fact_observation").count() == batch.count()


def test_jumps_on_arrival(spark, station, metric):
    folder = shared_folder(spark, "raw")
    deliver(spark, folder, 0, [("1", "click", hour(0), 10, hour(0)), ("2", "click", hour(0), 90, hour(0))])
    deliver(spark, folder, 1, [("1", "click", hour(1), 80, hour(1)), ("2", "click", hour(1), 90, hour(1))])
    deliver(spark, folder, 2, [("2", "click", hour(2), 10, hour(2))])
    wh, base = Warehouse(spark, shared_folder(spark, "tables")), shared_folder(spark, "stream")
    store = HeadStore(spark, f"{base}/heads")
    config = detectors.DetectorConfig(spike={"click": 50}, drop={"click": 50})
    ticks = iter(range(10))
    step = jumps_on_arrival(wh, store, station, metric, config, lambda: hour(next(ticks)))
    start_transform(stream(spark, folder), wh, station, metric, f"{base}/checkpoint", and_then=step).awaitTermination()
    assert rows(wh.read("ops_anomaly"), "anomaly_type", "station_id", "detected_at") == [
        ("drop", 2, hour(2)), ("spike", 1, hour(1))]
    assert wh.read("ops_incident").count() == 2 and wh.read("ops_incident_anomaly").count() == 2

    heads = observed_heads(store.latest(), station, metric)
    quiet = detectors.detect_all(heads, config, hour(6), quiet_detectors())
    facts = detectors.Observed(wh.read("fact_observation"), station, metric)
    assert rows(quiet) == rows(detectors.detect_all(facts, config, hour(6), quiet_detectors()))
    assert quiet.where(F.col("anomaly_type") == "stale_data").count() == 2


def test_heads_take_corrections_before_choosing(spark):
    shape = "station_id bigint, metric_id bigint, observed_at timestamp, value_num decimal(18,6), ingested_at timestamp"

    def frame(*data):
        return spark.createDataFrame([(1, 1, o, Decimal(v), i) for o, v, i in data], shape)

    heads = frame((hour(1), 1, hour(1)), (hour(2), 2, hour(2)))
    facts = frame((hour(2), 7, hour(9)), (hour(1), 8, hour(0)), (hour(0), 5, hour(9)), (hour(3), 4, hour(9)))
    assert rows(update_heads(heads, facts), "observed_at", "value_num") == [(hour(2), Decimal(7)), (hour(3), Decimal(4))]


def test_landed_documents_as_a_stream(spark, station, tmp_path):
    metrics = dictionary.default_metrics(spark)
    wh = Warehouse(spark, shared_folder(spark, "tables"))
    wh.overwrite("dim_station", station.withColumns({"lat": F.lit(1), "lon": F.lit(2), **{
        c: F.lit(None) for c in ("source", "station_name", "state", "region", "valid_from", "valid_to")}}))
    wh.overwrite("dim_metric", metrics)
    for n, value in enumerate((10.0, 18.5)):
        (tmp_path / f"{n}.json").write_text(json.dumps({
            "station_external_id": "1", "hourly": {"time": [f"2024-03-01T0{n}:00"], "temperature_2m": [value], "weather_code": [3]}}))
    with (tmp_path / "1.json").open("a") as landed:
        landed.write('\n{"station_external_id": "1", "hourly": {"time"')
    documents = stream_payloads(spark, str(tmp_path), files_per_trigger=1)
    start_ingest(documents, wh, shared_folder(spark, "checkpoint"), lambda: hour(2)).awaitTermination()
    runs = wh.read("ops_job_run")
    assert rows(runs, "status", "rows_inserted", "rows_rejected") == [("succeeded", 2, 0), ("succeeded", 2, 1)]
    assert rows(wh.read("ops_rejected_document"), "record") == [('{"station_external_id": "1", "hourly": {"time"',)]
    jobs.transform_runs(wh, hour(3), unit_factors=dictionary.default_unit_factors(spark))
    facts = wh.read("fact_observation")
    assert [float(v) for (v,) in rows(facts, "value_num")] == [10.0, 18.5]
    # The code without a metric is reported, and the detector limit is found by its alias.
    assert rows(contract_violations(wh.read("raw_observations"), metrics), "metric_code", "problem") == [
        ("temperature_2m", "unit_mismatch"), ("weather_code", "unknown_metric")]
    found = detectors.detect_all(detectors.Observed(facts, wh.read("dim_station"), metrics), as_of=hour(2))
    assert rows(found.where("anomaly_type = 'spike'"), "station_id", "metric_id") == [(1, 1)]


def test_an_event_folder_streams_like_an_event_file(spark, tmp_path):
    """The given table may be one file or a folder of many."""
    small = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))

    def streamed(folder):
        seen = []
        query = event_stream(spark, folder).writeStream.foreachBatch(lambda batch, epoch: seen.append(batch.count()))
        query.option("checkpointLocation", shared_folder(spark, "c")).trigger(availableNow=True).start().awaitTermination()
        return sum(seen)

    assert streamed(small) == streamed(str(tmp_path)) == events.count()
