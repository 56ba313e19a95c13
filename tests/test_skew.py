"""A key that holds a third of all rows: joins are split at runtime, results stay whole."""

import contextlib

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewarden.operators import incidents, security, transform

# Thresholds small enough for test data; dimensions too large to broadcast.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.shuffle.partitions": "8",
}
N = 60_000


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def big(spark):
    with settings(spark, SMALL):
        yield spark


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, modulo=500):
    """Ids with a key that a third of the rows share."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % modulo)
    return spark.range(0, N, 1, 6).withColumn("key", key)


def stations(spark, n=500):
    return spark.range(0, n, 1, 4).select(
        F.col("id").alias("station_id"), F.col("id").cast("string").alias("station_external_id"),
        F.lit(True).alias("is_current"), F.lit(False).alias("is_smoketest"),
        F.when(F.col("id") % 2 == 0, "N").otherwise("S").alias("region"),
    )


def test_a_hot_station_is_split_in_the_transform(big):
    raw = hot(big).select(
        F.col("key").cast("string").alias("station_external_id"), F.lit("t").alias("metric_code"),
        F.col("id").cast("decimal(18,6)").alias("value_num"), F.timestamp_seconds("id").alias("observed_at"),
        F.timestamp_seconds("id").alias("ingested_at"), F.lit("x").alias("source"), F.lit("r").alias("ingest_run_id"),
    )
    keyed = transform.to_facts(raw, stations(big), big.range(1).select(F.col("id").alias("metric_id"), F.lit("t").alias("metric_code")))
    assert "SortMergeJoin(skew=true)" in final_plan(keyed)
    facts = transform.latest_facts(raw, stations(big), big.range(1).select(F.col("id").alias("metric_id"), F.lit("t").alias("metric_code")))
    assert facts.count() == N
    assert facts.where("station_id = 0").count() == hot(big).where("key = 0").count()


def test_a_hot_incident_key_is_split_when_linking(big):
    found = hot(big).select(
        F.col("id").cast("string").alias("anomaly_id"), F.lit("spike").alias("anomaly_type"),
        F.col("key").alias("station_id"), F.lit(1).cast("bigint").alias("metric_id"),
        F.timestamp_seconds("id").alias("detected_at"), F.lit("high").alias("severity"), F.lit("{}").alias("details"),
    )
    stored = found.where("station_id < 100").select(
        F.concat(F.lit("i"), F.col("station_id")).alias("incident_id"), F.lit("open").alias("status"),
        "anomaly_type", "station_id", "metric_id", F.col("detected_at").alias("created_at"),
    ).dropDuplicates(["incident_id"])
    resolved = incidents.resolve_incidents(stored, found)
    links = incidents.link_incidents(
        big.sql("SELECT '' AS incident_id, '' AS anomaly_id WHERE false"), resolved, found, "2024-01-01"
    )
    plan = final_plan(links)
    assert "SortMergeJoin(skew=true)" in plan
    assert links.count() == N
    assert links.where("incident_id = 'i0'").count() == hot(big).where("key = 0").count()


def test_a_hot_station_is_split_in_the_visibility_join(big):
    facts = hot(big).select(F.col("key").alias("station_id"), F.col("id").alias("v"))
    grants = big.sql("SELECT 'u' AS user_id, 'analyst' AS role, 'N' AS region, CAST(NULL AS BIGINT) AS station_id")
    seen = security.visible_facts(facts, stations(big), grants, "u")
    assert "skew=true" in final_plan(seen)
    assert seen.count() == hot(big).where("key % 2 = 0").count()


def test_counts_of_a_hot_parent_are_reduced_first(big):
    from tidewarden.operators import ledger

    children = hot(big).select(
        F.concat(F.lit("t"), "id").alias("run_id"), F.lit("transform_raw_to_fact").alias("job_name"),
        F.lit("succeeded").alias("status"), F.col("key").cast("string").alias("parent_run_id"),
    )
    parents = big.range(0, 600).select(
        F.col("id").cast("string").alias("run_id"), F.lit("ingest_openmeteo_all_stations").alias("job_name"),
        F.lit("succeeded").alias("status"), F.lit(None).cast("string").alias("parent_run_id"),
    )
    pending = ledger.pending_runs(parents.unionByName(children))
    assert len(rows(pending, "run_id")) == 100
