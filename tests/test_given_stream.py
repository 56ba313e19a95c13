"""The events as a stream: what a micro-batch holds however many files it is."""

from datetime import timedelta

from pyspark.sql import functions as F

from conftest import at, rows
from acceptance import given
from tidewarden.session import shared_folder

START = at("2024-01-01 00:00:00")


def test_a_span_of_many_events_is_many_files_and_one_micro_batch(spark, monkeypatch):
    monkeypatch.setattr(given, "ROWS_PER_FILE", 10)
    folder = shared_folder(spark, "given")
    data = [(i, START + timedelta(minutes=i), i % 7, "click", float(i), '{"k": 1}') for i in range(401)]
    events = spark.createDataFrame(data, given.SCHEMAS["events"])
    events.write.parquet(f"{folder}/events.parquet")
    seen, files = [], []

    def note(batch, epoch):
        seen.append(rows(batch, "event_id"))
        files.append(batch.select(F.input_file_name()).distinct().count())

    stream = given.ordered_event_stream(given.Given(spark, folder))
    stream.writeStream.foreachBatch(note).option("checkpointLocation", shared_folder(spark, "c")).trigger(
        availableNow=True).start().awaitTermination()
    spans = [[(i,) for i in range(100 * k, 100 * (k + 1) + (k == 3))] for k in range(4)]
    assert [sorted(s) for s in seen] == spans
    assert files == [10] * 4
