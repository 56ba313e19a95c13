"""Rules for one key, run over buckets of keys."""

import random
from types import SimpleNamespace

from pyspark.sql import Row

from tidewarden.streaming import state

SHAPE = ["station_id", "at", "value_num", "ingested", "ingest_run_id", "source"]
MINUTE = 60_000_000


class Stream:
    """The store of one bucket and the stream's timers, with the calls counted."""

    def __init__(self, processor):
        self.processor, self.kept, self.timers, self.calls = processor, None, set(), 0
        processor.init(self)

    def getValueState(self, name, schema):
        def called(result):
            self.calls += 1
            return result

        return SimpleNamespace(exists=lambda: self.kept is not None, get=lambda: called(self.kept),
                               update=lambda value: called(setattr(self, "kept", value)))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)

    def batch(self, rows, watermark):
        """One micro-batch: its rows, then the timers that ran out."""
        clock, out = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark), []
        if rows:
            out += self.processor.handleInputRows((7,), iter(rows), clock)
        while ran_out := [t for t in sorted(self.timers) if t < watermark]:
            out += self.processor.handleExpiredTimer((7,), clock, None)
            self.timers.discard(ran_out[0])
        return [tuple(r) for r in out]


def fact(station, at):
    return Row(*SHAPE)(station, at, None, 0, "a", "x")


def one_by_one(rows_of_batches, watermarks, stations, known):
    """The same rule with a store for every key."""
    out = {}
    for station in stations:
        rule, handle = state.QuietTimer(["station_id"], 10), state.BucketHandle()
        handle.choose((station,))
        rule.init(handle)
        if station in known:
            rule.handleInitialState((station,), None, SimpleNamespace(getCurrentWatermarkInMs=lambda: 0))
        for n, (rows, watermark) in enumerate(zip(rows_of_batches, watermarks)):
            clock = SimpleNamespace(getCurrentWatermarkInMs=lambda w=watermark: w)
            mine, told = [r for r in rows if r.station_id == station], []
            if mine:
                told += rule.handleInputRows((station,), iter(mine), clock)
            timers = handle.at_hand[1]
            for due in sorted(t for t in timers if t < watermark):
                timers.discard(due)
                told += rule.handleExpiredTimer((station,), clock, None)
            out.setdefault(n, []).extend(tuple(r) for r in told)
    return [sorted(out[n], key=str) for n in range(len(rows_of_batches))]


def test_timers_of_a_bucket_are_those_of_its_keys():
    rng = random.Random(3)
    stations, known = range(12), {0, 1, 2}
    batches, watermarks = [], []
    for n in range(12):
        batches.append([fact(rng.choice(stations[1:]), (5 * n + rng.randrange(-12, 6)) * MINUTE) for _ in range(rng.randrange(6))])
        watermarks.append(5 * n * 60_000)
    stream = Stream(state.Bucketed(state.QuietTimer(["station_id"], 10), ["station_id"]))
    members = Row(bucket=7, members=[Row(station_id=s) for s in known])
    stream.processor.handleInitialState((7,), members, SimpleNamespace(getCurrentWatermarkInMs=lambda: 0))
    assert stream.timers == {1}
    told = [sorted(stream.batch(rows, watermark), key=str) for rows, watermark in zip(batches, watermarks)]
    assert told == one_by_one(batches, watermarks, stations, known)
    assert sum(map(len, told)) > 20


def test_the_store_is_asked_per_bucket_and_not_per_key():
    stream = Stream(state.Bucketed(state.NewestRows(2, ["station_id"]), ["station_id"]))
    first = stream.batch([fact(s, at) for s in range(1000) for at in (1, 2, 3)], 0)
    again = stream.batch([fact(s, 2) for s in range(1000)] + [fact(5, 9)], 0)
    assert len(first) == 2000 and again == [(5, 9, None, 0, "a", "x")]
    assert stream.calls == 3  # nothing to read at first, then one read and one write
