"""Merges: brute force, replays, duplicates, hot keys."""

from collections import defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from conftest import at, rows
from tidewarden.operators import incidents
from tidewarden.operators.merge import history, insert_or_ignore, latest_wins, upsert, upsert_counts

relaxed = hypothesis_settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
SHAPE = "k int, seq int, v string"


def frame(spark, data, shape=SHAPE):
    return spark.createDataFrame(data, shape)


batches = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 50), st.text("ab", max_size=2)),
    max_size=12, unique_by=lambda r: r[1],
)


@relaxed
@given(batches, batches)
def test_upsert_equals_row_by_row(spark, stored, batch):
    """Row by row: each source row inserts its key or overwrites it, in order of ``seq``."""
    target = {r[0]: r for r in sorted(stored, key=lambda r: r[1])}
    state, inserted, updated = dict(target), defaultdict(int), defaultdict(int)
    for row in sorted(batch, key=lambda r: r[1]):
        (updated if row[0] in state else inserted)[row[0]] += 1
        state[row[0]] = row
    merged = upsert(frame(spark, list(target.values())), frame(spark, batch), ["k"], ["seq"])
    assert rows(merged, "k", "seq", "v") == sorted(state.values(), key=lambda r: tuple((v is None, str(v)) for v in r))
    expected = (sum(inserted.values()), sum(updated.values()), 0)
    assert rows(upsert_counts(merged)) == [expected]
    assert sum(expected) == len(batch)


def test_upsert_replay_changes_nothing(spark):
    target = frame(spark, [(1, 1, "a"), (2, 1, "b")])
    batch = frame(spark, [(2, 5, "c"), (2, 6, "d"), (3, 7, "e")])
    once = upsert(target, batch, ["k"], ["seq"])
    twice = upsert(once.select("k", "seq", "v"), batch, ["k"], ["seq"])
    assert rows(once, "k", "seq", "v") == rows(twice, "k", "seq", "v") == [(1, 1, "a"), (2, 6, "d"), (3, 7, "e")]
    assert rows(once, "k", "action") == [(1, "kept"), (2, "updated"), (3, "inserted")]
    assert rows(upsert_counts(twice)) == [(0, 3, 0)]


def test_newest_wins_ignores_the_order_of_arrival(spark):
    newer, older = frame(spark, [(1, 9, "new")]), frame(spark, [(1, 2, "old")])
    for target, source in ((newer, older), (older, newer)):
        assert rows(upsert(target, source, ["k"], ["seq"], newest_wins=True), "v") == [("new",)]
    assert rows(upsert(newer, older, ["k"], ["seq"]), "v") == [("old",)]


@relaxed
@given(batches, batches)
def test_insert_or_ignore_equals_row_by_row(spark, stored, batch):
    known = {r[0] for r in stored}
    expected = {}
    for row in sorted(batch, key=lambda r: r[1]):
        if row[0] not in known:
            expected.setdefault(row[0], row)
    new = insert_or_ignore(frame(spark, stored), frame(spark, batch), ["k"], [F.asc("seq")])
    assert rows(new, "k", "seq", "v") == sorted(expected.values(), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_insert_or_ignore_shuffles_each_side_once(spark):
    shape = "k int, seq int, v string"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = insert_or_ignore(frame(spark, [(1, 1, "a")], shape), frame(spark, [(1, 2, "b"), (2, 3, "c")], shape), ["k"], [F.asc("seq")])
        assert new._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        assert rows(new, "v") == [("c",)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_anomaly_dedup_by_hour_and_metric(spark):
    base = at("2024-01-01 10:59:59.999999")
    found = spark.createDataFrame([("spike", 1, 7), ("spike", 1, None), ("spike", 1, 7)],
                                  "anomaly_type string, station_id long, metric_id long")
    first = incidents.stamp_anomalies(found, base)
    none = first.limit(0)
    new = incidents.new_anomalies(none, first)
    assert rows(new, "metric_id", "detected_hour") == [(7, at("2024-01-01 10:00")), (None, at("2024-01-01 10:00"))]
    same_hour = incidents.stamp_anomalies(found, base - timedelta(minutes=50))
    assert new.count() == 2 and incidents.new_anomalies(new, same_hour).count() == 0
    next_hour = incidents.stamp_anomalies(found, base + timedelta(microseconds=1))
    assert incidents.new_anomalies(new, next_hour).count() == 2


changes = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40), st.sampled_from("abc")),
                   min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1]))


@relaxed
@given(changes)
def test_history_equals_a_walk_through_the_changes(spark, feed):
    start = datetime(2024, 1, 1)
    data = [(k, start + timedelta(hours=9 * h), v) for k, h, v in feed]
    expected = []
    for key in {k for k, _, _ in data}:
        versions = []
        for _, when, value in sorted(r for r in data if r[0] == key):
            if not versions or versions[-1][1] != value:
                versions.append((when, value))
        ends = [w for w, _ in versions[1:]] + [None]
        expected += [(key, v, w, e, e is None) for (w, v), e in zip(versions, ends)]
    got = history(spark.createDataFrame(data, "k int, at timestamp, v string"), "k", ["v"], "at")
    assert rows(got) == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_latest_wins_nulls_are_oldest(spark):
    data = [(1, None, "null"), (1, 0, "zero"), (2, None, "only")]
    assert rows(latest_wins(frame(spark, data), ["k"], ["seq"]), "k", "v") == [(1, "zero"), (2, "only")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(0, 30000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq"), F.lit("x").alias("v")
    )
    newest = latest_wins(hot, ["k"], ["seq"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert rows(newest.where("k = 0"), "k", "seq") == [(0, 29997)]
    assert newest.count() == 20001
