"""Detection on arrival with the stream's own keyed state and timers.

Every operator here has two levels. The first is keyed by the series and a salt, so a series that carries a third
of all rows is spread over ``SALTS`` tasks; it passes on the newest rows of its share, and only when they changed.
The second is keyed by the series alone and sees a few rows per salt and micro-batch, however hot the series is.

The rules are written for one key. The streams run them over buckets of keys (:class:`Bucketed`): the state of a bucket is
read and written once a micro-batch, because a call to the state store for every key costs milliseconds.

Times are microseconds inside the state. State lives in RocksDB beside the executors and in the checkpoint.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewarden.functions.clock import Instant, elapsed_minutes, instant
from tidewarden.operators.detectors import DetectorConfig, as_anomalies, jumps_of_pairs, monitored
from tidewarden.operators.incidents import stamp_anomalies
from tidewarden.operators.merge import latest_wins
from tidewarden.operators.series import SERIES
from tidewarden.plans.jobs import store_anomalies
from tidewarden.schemas import DECIMAL
from tidewarden.sources.warehouse import Warehouse, staged

SALTS = 16
# Keys are dealt over so many buckets, which a checkpoint keeps; a task holds the keys of one bucket at a time.
BUCKETS = 512
STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)
ROW = f"at bigint, value_num {DECIMAL}, ingested bigint, ingest_run_id string, source string"
PAIR = f"last_at bigint, last_value {DECIMAL}, prev_at bigint, prev_value {DECIMAL}, version bigint"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state with timers needs this store; it is chosen when a stream starts."""
    spark.conf.set(*STATE_STORE)


# --- keys in buckets -------------------------------------------------------------


class _OfKey:
    """One named state of the key at hand: a list, or a value as one item."""

    def __init__(self, bucket: BucketHandle, name: str):
        self.bucket, self.name = bucket, name

    def exists(self) -> bool:
        return self.name in self.bucket.at_hand[0]

    def put(self, value) -> None:
        self.bucket.at_hand[0][self.name] = value


class _ListOfKey(_OfKey):
    def get(self) -> Iterator[tuple]:
        return iter(self.bucket.at_hand[0].get(self.name, ()))


class _ValueOfKey(_OfKey):
    def get(self) -> tuple:
        return self.bucket.at_hand[0][self.name]

    update = _OfKey.put


class BucketHandle:
    """States and timers of the keys of one bucket, as a rule for one key sees them."""

    def __init__(self):
        self.keys: dict[tuple, tuple[dict, set]] = {}

    def choose(self, key: tuple) -> None:
        self.at_hand = self.keys.setdefault(key, ({}, set()))

    def getListState(self, name: str, schema: str) -> _ListOfKey:
        return _ListOfKey(self, name)

    def getValueState(self, name: str, schema: str) -> _ValueOfKey:
        return _ValueOfKey(self, name)

    def registerTimer(self, at: int) -> None:
        self.at_hand[1].add(at)

    def deleteTimer(self, at: int) -> None:
        self.at_hand[1].discard(at)

    def next_timer(self) -> int | None:
        return min((min(timers) for _, timers in self.keys.values() if timers), default=None)


class Bucketed(StatefulProcessor):
    """Runs a rule for one key over all keys of a bucket.

    The store holds one value per bucket: the states and timers of its keys, and the earliest of these timers, which is
    the one that the stream keeps.
    """

    def __init__(self, rule: StatefulProcessor, keys: Sequence[str]):
        self.rule = rule
        self.keys = tuple(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stored = handle.getValueState("bucket", "kept binary, timer bigint")
        self.bucket = BucketHandle()
        self.rule.init(self.bucket)

    def _load(self) -> int | None:
        kept, timer = self.stored.get() if self.stored.exists() else (None, None)
        self.bucket.keys = pickle.loads(kept) if kept else {}
        return timer

    def _store(self, timer: int | None, fired: bool = False) -> None:
        upcoming = self.bucket.next_timer()
        if upcoming != timer or fired:
            # The stream deletes a timer that ran out by itself.
            if timer is not None and not fired:
                self.handle.deleteTimer(timer)
            if upcoming is not None:
                self.handle.registerTimer(upcoming)
        self.stored.update((pickle.dumps(self.bucket.keys, pickle.HIGHEST_PROTOCOL), upcoming))
        self.bucket.keys = {}

    def handleInputRows(self, key, rows, timerValues):
        arrived: dict[tuple, list] = {}
        for r in rows:
            arrived.setdefault(tuple(r[k] for k in self.keys), []).append(r)
        timer = self._load()
        for one, mine in arrived.items():
            self.bucket.choose(one)
            yield from self.rule.handleInputRows(one, iter(mine), timerValues)
        self._store(timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        timer = self._load()
        now = timerValues.getCurrentWatermarkInMs()
        for one, (_, timers) in self.bucket.keys.items():
            for due in sorted(t for t in timers if t < now):
                timers.discard(due)
                self.bucket.choose(one)
                yield from self.rule.handleExpiredTimer(one, timerValues, expiredTimerInfo)
        self._store(timer, fired=True)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        timer = self._load()
        for one in initialState.members:
            member = tuple(one[k] for k in self.keys)
            self.bucket.choose(member)
            self.rule.handleInitialState(member, one, timerValues)
        self._store(timer)

    def close(self) -> None:
        self.rule.close()


def bucket_of(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket")


def _by_bucket(rows: DataFrame, *keys: str):
    return rows.select("*", bucket_of(*keys)).groupBy("bucket")


# --- newest rows of a series -----------------------------------------------------


def _stored_later(row: tuple) -> tuple:
    """Order of rows of one series and time: that of the stored facts, nulls first."""
    _, value, ingested, run, source = row
    return tuple((x is not None, x) for x in (ingested, run, source, value))


def newest(rows: Iterable[tuple], n: int) -> list[tuple]:
    """The ``n`` newest of (at, value, ingested, run, source), one per time: the one stored last."""
    best: dict[int, tuple] = {}
    for row in rows:
        held = best.get(row[0])
        if held is None or _stored_later(row) > _stored_later(held):
            best[row[0]] = row
    return [best[at] for at in sorted(best, reverse=True)[:n]]


class NewestRows(StatefulProcessor):
    """First level: the newest rows of a key. A row is passed on when it enters them."""

    def __init__(self, n: int, passed: Sequence[str]):
        self.n = n
        self.passed = tuple(passed)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", ROW)

    def handleInputRows(self, key, rows, timerValues):
        held = [tuple(r) for r in self.rows.get()]
        now = newest(held + [(r.at, r.value_num, r.ingested, r.ingest_run_id, r.source) for r in rows], self.n)
        fresh = [r for r in now if r not in held]
        if fresh:
            self.rows.put(now)
        for at, value, ingested, run, source in fresh:
            yield Row(**dict(zip(self.passed, key)), at=at, value_num=value, ingested=ingested, ingest_run_id=run, source=source)

    def close(self) -> None:
        pass


class NewestPair(StatefulProcessor):
    """Second level: the newest row beside the one before it, given out when either changed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", ROW)
        self.version = handle.getValueState("version", "version bigint")

    def handleInputRows(self, key, rows, timerValues):
        held = [tuple(r) for r in self.rows.get()]
        now = newest(held + [(r.at, r.value_num, r.ingested, r.ingest_run_id, r.source) for r in rows], 2)
        if now == held:
            return
        version = (self.version.get()[0] if self.version.exists() else 0) + 1
        self.rows.put(now)
        self.version.update((version,))
        last, before = now[0], now[1] if len(now) > 1 else (None, None)
        yield Row(station_id=key[0], metric_id=key[1], last_at=last[0], last_value=last[1],
                  prev_at=before[0], prev_value=before[1], version=version)

    def close(self) -> None:
        pass


def _salt() -> Column:
    return F.pmod(F.xxhash64("observed_at"), F.lit(SALTS)).alias("salt")


def _dealt(facts: DataFrame) -> DataFrame:
    """Arriving facts with times as numbers and a salt; rows of one series and time share a salt, so that
    corrections meet what they correct."""
    return facts.select(
        *SERIES, F.unix_micros("observed_at").alias("at"), F.col("value_num").cast(DECIMAL).alias("value_num"),
        F.unix_micros("ingested_at").alias("ingested"), "ingest_run_id", "source", _salt(),
    )


def newest_pairs(facts: DataFrame) -> DataFrame:
    """A stream of facts to a stream of ``station_id, metric_id, last_at, last_value, prev_at, prev_value, version``.

    A series has a row for every micro-batch that changed its newest two observations; the highest version is
    what a batch reduction of all facts so far gives. Rows may arrive in any order and corrected.
    """
    use_state_store(facts.sparkSession)
    share = [*SERIES, "salt"]
    shares = _by_bucket(_dealt(facts), *share).transformWithState(
        Bucketed(NewestRows(2, SERIES), share), f"station_id bigint, metric_id bigint, {ROW}", "Append", "None")
    return _by_bucket(shares, *SERIES).transformWithState(
        Bucketed(NewestPair(), SERIES), f"station_id bigint, metric_id bigint, {PAIR}", "Append", "None")


def current_pairs(versions: DataFrame) -> DataFrame:
    """The last version per series, in the shape that :func:`jumps_of_pairs` reads."""
    pairs = latest_wins(versions, SERIES, ["version"])
    return pairs.where("prev_value IS NOT NULL AND last_value IS NOT NULL").select(
        *SERIES,
        F.timestamp_micros("last_at").alias("last_observed_at"), "last_value",
        F.timestamp_micros("prev_at").alias("prev_observed_at"), "prev_value",
    )


def jumps(pairs: DataFrame, station: DataFrame, metric: DataFrame, config: DetectorConfig) -> DataFrame:
    """Spikes and drops of the given pairs, tagged with the detector."""
    parts = [
        as_anomalies(
            jumps_of_pairs(pairs, station, metric, limits, rising, config.jump_lookback, config.circular), name, "medium"
        ).withColumn("detector", F.lit(name))
        for name, limits, rising in (("spike", config.spike, True), ("drop", config.drop, False))
    ]
    return parts[0].unionByName(parts[1])


def start_jumps(
    facts: DataFrame,
    warehouse: Warehouse,
    station: DataFrame,
    metric: DataFrame,
    config: DetectorConfig,
    clock: Callable[[], datetime],
    checkpoint: str,
) -> StreamingQuery:
    """Store jumps and their incidents as facts arrive; the pairs are logged in ``series_pair``.

    A replayed micro-batch logs the same versions again and finds the same anomalies.
    """

    def step(versions: DataFrame, epoch: int) -> None:
        fresh = staged(versions, "pairs")
        as_of = clock()
        found = stamp_anomalies(jumps(current_pairs(fresh), station, metric, config), as_of)
        store_anomalies(warehouse, staged(found, "arrivals"), as_of)
        warehouse.append("series_pair", fresh)

    return (
        newest_pairs(facts).writeStream.foreachBatch(step).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


# --- silence by timer --------------------------------------------------------------


class NewestTime(StatefulProcessor):
    """First level: the newest time of a key, passed on with the newest arrival beside it when it moves."""

    def __init__(self, passed: Sequence[str]):
        self.passed = tuple(passed)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "at bigint")

    def handleInputRows(self, key, rows, timerValues):
        seen = [(r.at, r.arrived_at) for r in rows]
        at = max(at for at, _ in seen)
        if self.newest.exists() and at <= self.newest.get()[0]:
            return
        self.newest.update((at,))
        yield Row(**dict(zip(self.passed, key)), at=at, arrived_at=max(arrived for _, arrived in seen))

    def close(self) -> None:
        pass


class QuietTimer(StatefulProcessor):
    """Second level: a timer per key that runs out when nothing newer came for long enough.

    Gives out a row when a key falls quiet, is heard again, or is quiet with a newer last time. The stream's
    watermark is its clock. Keys of the initial state that never send anything are quiet from the start.
    """

    def __init__(self, keys: Sequence[str], after_minutes: int):
        self.keys = tuple(keys)
        self.after_ms = after_minutes * 60_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at bigint, quiet boolean, version bigint")

    def _due(self, at: int) -> int:
        """First whole millisecond at which the key is quiet: later than the limit, not at it."""
        return at // 1000 + self.after_ms + 1

    def _told(self, key, at, quiet: bool, version: int) -> Row:
        self.seen.update((at, quiet, version))
        return Row(**dict(zip(self.keys, key)), at=at, quiet=quiet, version=version)

    def handleInputRows(self, key, rows, timerValues):
        at, quiet, version = self.seen.get() if self.seen.exists() else (None, False, 0)
        newer = max((r.at for r in rows), default=None)
        if newer is None or (at is not None and newer <= at):
            return
        if at is not None and not quiet:
            self.handle.deleteTimer(self._due(at))
        late = self._due(newer) <= timerValues.getCurrentWatermarkInMs()
        if not late:
            self.handle.registerTimer(self._due(newer))
        if quiet or late:
            yield self._told(key, newer, late, version + 1)
        else:
            self.seen.update((newer, False, version))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        at, quiet, version = self.seen.get()
        # The timer of the initial state may run out after the key was heard.
        if not quiet and (at is None or self._due(at) <= timerValues.getCurrentWatermarkInMs()):
            yield self._told(key, at, True, version + 1)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((None, False, 0))
        self.handle.registerTimer(max(1, timerValues.getCurrentWatermarkInMs()))

    def close(self) -> None:
        pass


def quiet_keys(
    facts: DataFrame, keys: Sequence[str], after_minutes: int, known: DataFrame | None = None,
    arrival: str = "ingested_at", lateness: str = "0 seconds",
) -> DataFrame:
    """A stream of facts to a stream of ``keys, at, quiet, version``: which keys are quiet by the stream's clock.

    The clock is the largest ``arrival`` of the rows given in, less ``lateness``. A row that arrives with an ``arrival`` before the clock is
    not looked at, so ``lateness`` has to cover the disorder of the source. ``known`` lists keys to expect.
    """
    spark = facts.sparkSession
    use_state_store(spark)
    timed = facts.withColumn("arrived_at", F.col(arrival)).withWatermark("arrived_at", lateness)
    ddl = ", ".join(f"{k} bigint" for k in keys)
    share = [*keys, "salt"]
    narrow = timed.select(*keys, F.unix_micros("observed_at").alias("at"), _salt(), "arrived_at")
    shares = _by_bucket(narrow, *share).transformWithState(
        Bucketed(NewestTime(keys), share), f"{ddl}, at bigint, arrived_at timestamp",
        "Append", "EventTime", eventTimeColumnName="arrived_at")
    expected = None
    if known is not None:
        members = known.select(*keys).distinct().groupBy(bucket_of(*keys)).agg(F.collect_list(F.struct(*keys)).alias("members"))
        expected = members.groupBy("bucket")
    return _by_bucket(shares, *keys).transformWithState(
        Bucketed(QuietTimer(keys, after_minutes), keys), f"{ddl}, at bigint, quiet boolean, version bigint", "Append", "EventTime", expected)


def start_quiet(
    facts: DataFrame, warehouse: Warehouse, table: str, checkpoint: str, keys: Sequence[str], after_minutes: int,
    known: DataFrame | None = None, arrival: str = "ingested_at", lateness: str = "0 seconds",
) -> StreamingQuery:
    """Log the changes of :func:`quiet_keys` in ``table`` (``station_quiet`` or ``series_quiet``)."""
    changes = quiet_keys(facts, keys, after_minutes, known, arrival, lateness)
    return (
        changes.writeStream.foreachBatch(lambda batch, epoch: warehouse.append(table, batch)).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def quiet_findings(changes: DataFrame, keys: Sequence[str], station: DataFrame, as_of: Instant, age: str) -> DataFrame:
    """Monitored keys that are quiet by their last change, with the minutes since they were seen.

    A small read: keys that never fell quiet have no row, and the facts are not looked at.
    """
    last = latest_wins(changes, keys, ["version"]).where("quiet").withColumn("last_observed_at", F.timestamp_micros("at"))
    return last.join(monitored(station).select("station_id"), "station_id", "left_semi").select(
        *keys, "last_observed_at", F.round(elapsed_minutes(instant(as_of), F.col("last_observed_at")), 2).alias(age))
