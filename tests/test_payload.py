import json
from datetime import datetime, timezone

from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from conftest import at, rows
from tidewarden.operators import payload
from tidewarden.settings import PAYLOAD_METRICS, PayloadMetric
from tidewarden.sources.payloads import CORRUPT, SOURCE_FILE, read_payloads

NOW = at("2024-01-30 12:00:00")
HOURS = ["2024-01-30T10:00", "2024-01-30T12:00", "2024-01-30T13:00"]


def document(station="s1", hours=HOURS, units=None, **series):
    return {
        "station_external_id": station, "latitude": 1.5, "longitude": None,
        "hourly": {"time": hours, **series}, "hourly_units": units,
    }


def landed(spark, tmp_path, *documents, metrics=PAYLOAD_METRICS):
    (tmp_path / "docs.json").write_text("\n".join(json.dumps(d) for d in documents))
    return read_payloads(spark, str(tmp_path), metrics)


def test_skip_rules_and_columns(spark, tmp_path):
    docs = landed(
        spark, tmp_path,
        document(temperature_2m=[1, 2.25, 3], precipitation=[0.5], surface_pressure=[900, None, 901],
                 weather_code=[], wind_speed_10m=None, units={"temperature_2m": "°C", "precipitation": "inch"}),
        document("empty", hours=[], temperature_2m=[1]),
        document("none", hours=None, temperature_2m=[1]),
        document("past", hours=HOURS[:1], precipitation=[7], units={"precipitation": ""}),
    )
    got = rows(payload.payload_rows(docs, NOW), "station_external_id", "metric_code", "value_num", "unit", "observed_at")
    assert [(r[0], r[1], float(r[2]), r[3], r[4]) for r in got] == [
        ("past", "precipitation", 7.0, "millimetres", at("2024-01-30 10:00")),
        ("s1", "temperature_2m", 2.25, "degrees Celsius", at("2024-01-30 12:00")),
    ]


def test_slice_holds_what_the_row_was_made_from(spark, tmp_path):
    docs = landed(spark, tmp_path, document(temperature_2m=[1, 2.25, 3], units={"temperature_2m": "°C"}),
                  document("past", hours=HOURS[:1], precipitation=[7], units={"precipitation": ""}))
    slices = {r[0]: json.loads(r[1]) for r in rows(payload.payload_rows(docs, NOW), "station_external_id", "source_payload")}
    assert slices["s1"] == {
        "provider": "OpenMeteo", "station_external_id": "s1", "latitude": 1.5, "longitude": None,
        "observed_at": "2024-01-30T12:00", "field": "temperature_2m", "metric_code": "temperature_2m",
        "unit": "°C", "value": 2.25,
    }
    assert slices["past"]["unit"] == "millimetres"


def test_text_metrics_go_to_the_text_column(spark, tmp_path):
    metrics = (PayloadMetric("sky", "sky_state", "word", "text"), PayloadMetric("t", "t", "°C"))
    docs = landed(spark, tmp_path, document(sky_state=["a", "clear", "c"], t=[1, 2, 3]), metrics=metrics)
    got = rows(payload.payload_rows(docs, NOW, metrics, "p"), "metric_code", "value_num", "value_text", "source")
    assert [(c, v and float(v), t, s) for c, v, t, s in got] == [("sky", None, "clear", "p"), ("t", 2.0, None, "p")]


hours = st.lists(st.integers(0, 47), max_size=8)


@hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(hours, min_size=1, max_size=20), st.integers(0, 47))
def test_pick_hour_equals_a_scan(spark, arrays, now_hour):
    """Arrays need not be sorted: the first position in array order counts."""
    def text(h):
        return f"2024-01-{1 + h // 24:02d}T{h % 24:02d}:00"

    now = datetime.fromisoformat(text(now_hour)).replace(tzinfo=timezone.utc)
    data = [(i, [text(h) for h in array]) for i, array in enumerate(arrays)]
    expected = []
    for i, array in enumerate(arrays):
        hit = next((p for p, h in enumerate(array) if h >= now_hour), len(array) - 1)
        expected.append((i, hit if array else None))
    df = spark.createDataFrame(data, "i int, times array<string>")
    got = df.select("i", payload.pick_hour(F.col("times"), now).alias("p"))
    assert rows(got) == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_an_offset_in_the_time_text_is_ignored(spark):
    df = spark.createDataFrame([("2024-01-30T12:00+05:00",), ("2024-01-30T12:00:30",)], "t string")
    assert rows(df.select(payload.utc_time(F.col("t")).alias("t"))) == [
        (at("2024-01-30 12:00:00"),), (at("2024-01-30 12:00:30"),)
    ]


def test_a_malformed_document_is_told_apart(spark, tmp_path):
    lines = ['{"station_external_id": "s1"', '{"station_external_id": "s2", "latitude": "north"}', '{"station_external_id": "s3", "latitude": 1.5}']
    (tmp_path / "docs.json").write_text("\n".join(lines))
    documents = read_payloads(spark, str(tmp_path)).select("station_external_id", "latitude", CORRUPT, SOURCE_FILE).collect()
    assert sorted(r[CORRUPT] for r in documents if r[CORRUPT]) == sorted(lines[:2])
    assert [(r.station_external_id, r.latitude) for r in documents if r[CORRUPT] is None] == [("s3", 1.5)]
    assert all(r[SOURCE_FILE].endswith("docs.json") for r in documents)
