"""State of the streams: the processors on their own, and what the stream remembers across micro-batches."""

import itertools
import random
from datetime import timedelta
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import Row, functions as F

from conftest import at, rows
from tidewarden.operators.series import newest_rows
from tidewarden.schemas import SCHEMAS
from tidewarden.session import shared_folder
from tidewarden.sources.warehouse import Warehouse
from tidewarden.streaming import arrivals, ledger, state

NOW = at("2024-03-01 00:00:00")


class Handle:
    """State and timers of one key, as the stream would keep them."""

    def __init__(self):
        self.kept, self.timers = {}, set()

    def getListState(self, name, schema):
        return SimpleNamespace(get=lambda: iter(self.kept.get(name, [])), put=lambda rows: self.kept.__setitem__(name, list(rows)))

    def getValueState(self, name, schema):
        return SimpleNamespace(exists=lambda: name in self.kept, get=lambda: self.kept[name], update=lambda v: self.kept.__setitem__(name, v))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def clock(ms):
    return SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)


def started(processor):
    handle = Handle()
    processor.init(handle)
    return handle


def fact(when, value, ingested=0, run="a", source="x"):
    return Row(at=when, value_num=None if value is None else Decimal(value), ingested=ingested, ingest_run_id=run, source=source)


def test_two_levels_equal_one_reduction_in_any_order():
    rng = random.Random(4)
    facts = [fact(rng.randrange(30), rng.choice([None, 1, 2]), rng.randrange(3), rng.choice("ab"), rng.choice(["x", None])) for _ in range(60)]
    want = state.newest([tuple(f) for f in facts], 2)
    assert want[0][0] == max(f.at for f in facts)
    for seed in range(5):
        random.Random(seed).shuffle(facts)
        firsts = [state.NewestRows(2, ["station_id", "metric_id"]) for _ in range(3)]
        for p in firsts:
            started(p)
        pair = state.NewestPair()
        started(pair)
        out = []
        for batch in itertools.batched(facts, 7):
            passed = []
            for salt, p in enumerate(firsts):
                mine = [f for f in batch if f.at % 3 == salt]
                passed += p.handleInputRows((1, 2, salt), iter(mine), None) if mine else []
            out += pair.handleInputRows((1, 2), iter(passed), None) if passed else []
            assert len(passed) <= 6
        last = max(out, key=lambda r: r.version)
        assert (last.last_at, last.last_value, last.prev_at, last.prev_value) == (want[0][0], want[0][1], want[1][0], want[1][1])
        assert [r.version for r in out] == list(range(1, len(out) + 1))
        assert not list(pair.handleInputRows((1, 2), iter(facts), None))  # a replay changes nothing


def test_a_key_falls_quiet_and_is_heard_again():
    timer = state.QuietTimer(["station_id"], 10)
    handle = started(timer)
    minute = 60_000_000
    told = lambda it: [(r.at, r.quiet, r.version) for r in it]
    assert told(timer.handleInputRows((1,), iter([fact(5 * minute, 1), fact(2 * minute, 1)]), clock(0))) == []
    assert handle.timers == {15 * 60_000 + 1}  # at the limit it is not quiet yet
    assert told(timer.handleInputRows((1,), iter([fact(5 * minute, 2)]), clock(0))) == []
    assert told(timer.handleInputRows((1,), iter([fact(7 * minute, 1)]), clock(0))) == []
    assert handle.timers == {17 * 60_000 + 1}
    assert told(timer.handleExpiredTimer((1,), clock(20 * 60_000), None)) == [(7 * minute, True, 1)]
    handle.timers.clear()
    # Newer, but still too old; then fresh; then quiet anew.
    assert told(timer.handleInputRows((1,), iter([fact(8 * minute, 1)]), clock(20 * 60_000))) == [(8 * minute, True, 2)]
    assert told(timer.handleInputRows((1,), iter([fact(21 * minute, 1)]), clock(20 * 60_000))) == [(21 * minute, False, 3)]
    assert told(timer.handleInputRows((1,), iter([fact(9 * minute, 1)]), clock(20 * 60_000))) == []
    assert told(timer.handleExpiredTimer((1,), clock(40 * 60_000), None)) == [(21 * minute, True, 4)]


def test_keys_that_never_come_are_quiet_from_the_start():
    timer = state.QuietTimer(["station_id"], 10)
    handle = started(timer)
    timer.handleInitialState((1,), Row(station_id=1), clock(0))
    assert handle.timers == {1}
    assert [(r.at, r.quiet) for r in timer.handleExpiredTimer((1,), clock(5), None)] == [(None, True)]
    timer = state.QuietTimer(["station_id"], 10)
    started(timer)
    timer.handleInitialState((2,), Row(station_id=2), clock(0))
    list(timer.handleInputRows((2,), iter([fact(60_000_000, 1)]), clock(0)))
    assert list(timer.handleExpiredTimer((2,), clock(5), None)) == []


FACT = SCHEMAS["fact_observation"]


def deliver(spark, folder, *facts):
    full = [(s, 1, NOW + timedelta(hours=h), Decimal(v), "x", NOW + timedelta(hours=i), False, "r") for s, h, v, i in facts]
    spark.createDataFrame(full, FACT).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(FACT).option("maxFilesPerTrigger", 1).parquet(folder)


def test_pairs_of_a_stream_that_is_stopped_and_started(spark):
    folder, out, checkpoint = (shared_folder(spark, x) for x in ("facts", "out", "checkpoint"))

    def run():
        pairs = state.newest_pairs(stream(spark, folder))
        pairs.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start().awaitTermination()
        return rows(state.current_pairs(spark.read.parquet(out)), "station_id", "last_observed_at", "last_value", "prev_value")

    deliver(spark, folder, (1, 1, 10, 1), (2, 5, 50, 5))
    deliver(spark, folder, (1, 2, 20, 2), (2, 4, 40, 6))
    hour = lambda n: NOW + timedelta(hours=n)
    assert run() == [(1, hour(2), Decimal(20), Decimal(10)), (2, hour(5), Decimal(50), Decimal(40))]
    # The state outlives the stream: a correction of an old row and a late row in between.
    deliver(spark, folder, (1, 1, 11, 9), (2, 5, 49, 4), (2, 3, 30, 9))
    assert run() == [(1, hour(2), Decimal(20), Decimal(11)), (2, hour(5), Decimal(50), Decimal(40))]
    heads = newest_rows(spark.createDataFrame([], FACT))
    assert heads.columns == SCHEMAS["series_head"].fieldNames()


def test_first_arrivals_and_closed_hours_with_late_rows(spark):
    folder = shared_folder(spark, "anomalies")
    shape = "anomaly_type string, station_id long, metric_id_dedup long, detected_hour timestamp, detected_at timestamp"

    def found(*minutes):
        data = [("spike", 1, -1, NOW + timedelta(hours=m // 60), NOW + timedelta(minutes=m)) for m in minutes]
        spark.createDataFrame(data, shape).coalesce(1).write.mode("append").parquet(folder)

    found(5, 10, 70)
    found(20, 65, 130)  # twenty past comes an hour late and still counts
    found(400)
    source = lambda: spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(folder)

    def given_out(df):
        out, checkpoint = shared_folder(spark, "out"), shared_folder(spark, "checkpoint")
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start().awaitTermination()
        return spark.read.schema(df.schema).parquet(out)

    keys = ["anomaly_type", "station_id", "metric_id_dedup", "detected_hour"]
    first = given_out(arrivals.first_arrivals(source(), keys, "detected_at", "2 hours").select(*keys))
    assert [h for *_, h in rows(first)] == [NOW, NOW + timedelta(hours=1), NOW + timedelta(hours=2), NOW + timedelta(hours=6)]
    hours = given_out(arrivals.hourly_anomalies(source(), "2 hours"))
    assert rows(hours, "detected_hour", "n_anomalies") == [(NOW, 3), (NOW + timedelta(hours=1), 2), (NOW + timedelta(hours=2), 1)]


def test_a_failing_ledger_write_is_raised_where_the_stream_is_awaited(spark):
    folder = shared_folder(spark, "facts")
    deliver(spark, folder, (1, 1, 10, 1))
    wh = Warehouse(spark, shared_folder(spark, "tables"))

    def lost(name, df):
        raise OSError("lost")

    wh.append = lost
    listener = ledger.LedgerListener(wh, "watched", "job", lambda: NOW)
    run = lambda: ledger.observed(stream(spark, folder)).writeStream.queryName("watched").foreachBatch(
        lambda batch, epoch: batch.count()).option("checkpointLocation", shared_folder(spark, "c")).trigger(availableNow=True).start()
    with pytest.raises(OSError, match="lost"):
        ledger.awaited_with_ledger(run, listener)
