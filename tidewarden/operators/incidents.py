"""Anomaly deduplication and incident grouping, set-wise."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewarden.functions.clock import Instant, instant
from tidewarden.functions.text import digest, incident_title
from tidewarden.operators.merge import first_per_key, insert_or_ignore
from tidewarden.schemas import KEYS, SCHEMAS
from tidewarden.settings import LIVE_INCIDENT_STATUSES

INCIDENT_KEY = ["anomaly_type", "station_id", "metric_id"]
MATCH_KEY = ["anomaly_type", "station_id", "_metric_key"]


def stamp_anomalies(found: DataFrame, as_of: Instant) -> DataFrame:
    """Detected rows as rows of the anomaly table: time, hour bucket, dedup key, id."""
    stamped = found.withColumns(
        {
            "detected_at": instant(as_of),
            "detected_hour": F.date_trunc("hour", instant(as_of)),
            "metric_id_dedup": F.coalesce("metric_id", F.lit(-1)),
        }
    )
    return stamped.withColumn("anomaly_id", digest(*[F.col(k) for k in KEYS["ops_anomaly"]]))


def new_anomalies(anomalies: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch rows to insert: first per type, station, metric and hour, unless stored already."""
    order = [F.asc(c) for c in ("detected_at", "anomaly_id", "details") if c in batch.columns]
    return insert_or_ignore(anomalies, batch, KEYS["ops_anomaly"], order)


def _keyed(df: DataFrame) -> DataFrame:
    """With a never-null metric key, so that plain equality matches missing metrics too
    and a side reduced per key is joined without another exchange."""
    return df.withColumn("_metric_key", F.coalesce("metric_id", F.lit(-1)))


def live_incidents(incidents: DataFrame) -> DataFrame:
    """Latest open or acknowledged incident per key: ``live_id`` and the match key."""
    live = incidents.where(F.col("status").isin(*LIVE_INCIDENT_STATUSES))
    newest = first_per_key(
        _keyed(live).select("incident_id", *MATCH_KEY, "created_at"),
        MATCH_KEY,
        [F.desc_nulls_first("created_at"), F.desc("incident_id")],
    )
    return newest.select(*MATCH_KEY, F.col("incident_id").cast("string").alias("live_id"))


def resolve_incidents(incidents: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Get-or-create: one row per key of the new anomalies, with its incident.

    A live incident of the key is reused. Otherwise the key opens a new one that takes
    severity and details from the key's first anomaly. Both sides of the join hold one
    row per key, so a hot key is no wider than any other.
    """
    if "details" not in anomalies.columns:
        anomalies = anomalies.withColumn("details", F.lit(None).cast("string"))
    founder = first_per_key(_keyed(anomalies), MATCH_KEY, [F.asc("detected_at"), F.asc("anomaly_id")])
    joined = founder.join(live_incidents(incidents), MATCH_KEY, "left")
    new_id = digest(*[F.col(k) for k in INCIDENT_KEY], F.col("anomaly_id"))
    return joined.select(
        *INCIDENT_KEY,
        F.coalesce("live_id", new_id).alias("incident_id"),
        F.col("live_id").isNull().alias("is_new"),
        F.col("anomaly_id").cast("string").alias("founder_id"),
        "severity",
        "details",
        incident_title(*[F.col(k) for k in INCIDENT_KEY]).alias("title"),
    )


def opened_incidents(resolved: DataFrame, as_of: Instant) -> DataFrame:
    """Rows of the incident table for the keys that open a new incident."""
    now = instant(as_of)
    given = {
        "status": F.lit("open"), "opened_at": now, "created_at": now, "last_seen_at": now,
        "anomaly_id": F.col("founder_id"),
        **{c: F.col(c) for c in ("incident_id", *INCIDENT_KEY, "severity", "title", "details")},
    }
    fields = SCHEMAS["ops_incident"].fields
    return resolved.where("is_new").select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def touch_incidents(incidents: DataFrame, resolved: DataFrame, as_of: Instant) -> DataFrame:
    """Incidents with ``last_seen_at`` moved for the matched ones."""
    matched = resolved.select(F.col("incident_id").alias("_touched")).distinct()
    joined = incidents.join(matched, incidents["incident_id"] == F.col("_touched"), "left")
    seen = F.when(F.col("_touched").isNotNull(), instant(as_of)).otherwise(F.col("last_seen_at"))
    return joined.withColumn("last_seen_at", seen).drop("_touched")


def link_incidents(links: DataFrame, resolved: DataFrame, anomalies: DataFrame, as_of: Instant) -> DataFrame:
    """New rows of the incident-anomaly link table.

    ``resolved`` is unique by key; where many anomalies share a key, the runtime skew
    split divides their side and copies the single matching row. The split needs an
    exchange right below the join on both sides, so the small side is spread by
    another column first instead of keeping the partitioning it was built with.
    """
    resolved = _keyed(resolved).select(*MATCH_KEY, "incident_id").repartition("incident_id")
    members = _keyed(anomalies).select(*MATCH_KEY, F.col("anomaly_id").cast("string").alias("anomaly_id"))
    pairs = members.join(resolved, MATCH_KEY).select(
        "incident_id", "anomaly_id", instant(as_of).alias("linked_at")
    )
    return insert_or_ignore(links, pairs, KEYS["ops_incident_anomaly"], [F.asc("linked_at")])
