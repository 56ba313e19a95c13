"""Semantic views for dashboards. Each is a function of the tables and ``as_of``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidewarden import settings
from tidewarden.functions.clock import Instant, elapsed_seconds, hours, instant, whole_minutes
from tidewarden.functions.text import utc_text, words
from tidewarden.operators.detectors import monitored
from tidewarden.operators.merge import first_per_key
from tidewarden.operators.series import SERIES, last_seen_by_series, newest_observation, since


def _freshness(last: Column, now: Column) -> Column:
    return (
        F.when(last.isNull(), "MISSING").when(now - last > hours(2), "STALE").otherwise("FRESH")
    )


def _with_freshness(seen: DataFrame, as_of: Instant, *columns: str) -> DataFrame:
    now, last = F.col("_now"), F.col("last_observed_at")
    return seen.withColumn("_now", instant(as_of)).select(
        *columns,
        last,
        (now - last).alias("staleness"),
        elapsed_seconds(now, last).alias("staleness_seconds"),
        _freshness(last, now).alias("freshness"),
        last.alias("last_seen"),
    )


def station_freshness(fact: DataFrame, station: DataFrame, as_of: Instant = None) -> DataFrame:
    """Last observation of every monitored station and its freshness label.

    Facts are reduced to one row per station before the join, so the join is as
    large as the dimension.
    """
    seen = fact.groupBy("station_id").agg(F.max("observed_at").alias("last_observed_at"))
    stations = monitored(station).select("station_id", "station_name")
    return _with_freshness(stations.join(seen, "station_id", "left"), as_of, "station_id", "station_name")


def station_metric_freshness(fact: DataFrame, station: DataFrame, as_of: Instant = None) -> DataFrame:
    """The same per station and metric; stations without facts keep one row without a metric."""
    stations = monitored(station).select("station_id", "station_name")
    seen = stations.join(last_seen_by_series(fact), "station_id", "left")
    return _with_freshness(seen, as_of, *SERIES, "station_name")


def worst_station_freshness(freshness: DataFrame) -> DataFrame:
    """The station that has been quiet the longest, which the platform status does not
    show: there the newest fact of all counts. One row, with the number never seen."""
    return freshness.agg(
        F.max("staleness_seconds").alias("worst_staleness_seconds"),
        F.count_if(F.col("freshness") == "MISSING").alias("n_missing"),
        F.count_if(F.col("freshness") == "STALE").alias("n_stale"),
    )


def station_health(freshness: DataFrame) -> DataFrame:
    """Dashboard label of :func:`station_freshness`; its limits differ from the view's."""
    age = F.col("staleness_seconds")
    exact = F.col("staleness")
    label = (
        F.when(age.isNull(), "UNKNOWN")
        .when(exact <= hours(1), "OK")
        .when(exact <= hours(6), "WARN")
        .otherwise("STALE")
    )
    return freshness.select(
        "station_id",
        F.col("station_name").alias("name"),
        label.alias("freshness"),
        utc_text(F.col("last_seen"), "HH:mm").alias("last_seen"),
    ).orderBy("station_id")


def platform_status(
    fact: DataFrame,
    incidents: DataFrame,
    check_results: DataFrame,
    runs: DataFrame,
    as_of: Instant = None,
    ingest_job: str = settings.INGEST_JOB,
) -> DataFrame:
    """Traffic light of the platform, always one row.

    Four global aggregates as scalar subqueries over a one-row frame: they run as
    independent jobs and nothing is paired.
    """
    now = instant(as_of)
    unresolved = incidents.where(F.col("status") != "resolved").agg(F.count("*").cast("int")).scalar()
    newest = newest_observation(fact)
    bad = check_results.where(
        F.col("status").isin("warn", "fail") & (F.col("evaluated_at") >= now - hours(settings.RECENT_HOURS))
    )
    last_ingest = runs.where((F.col("job_name") == ingest_job) & (F.col("status") == "succeeded"))
    facts = fact.sparkSession.range(1).select(
        now.alias("evaluated_at"),
        unresolved.alias("open_incidents"),
        newest.alias("newest"),
        bad.agg(F.count("*").cast("int")).scalar().alias("bad_checks"),
        last_ingest.agg(F.max("started_at")).scalar().alias("last_ingest"),
    )
    aged = facts.withColumn(
        "worst_freshness_minutes", F.greatest(F.lit(0), whole_minutes(F.col("evaluated_at"), F.col("newest")))
    )
    amber = (F.col("worst_freshness_minutes") > settings.FRESHNESS_OBJECTIVE_MINUTES) | (F.col("bad_checks") > 0)
    return aged.select(
        F.when(F.col("open_incidents") > 0, "RED").when(amber, "AMBER").otherwise("GREEN").alias("status"),
        "worst_freshness_minutes",
        "bad_checks",
        "open_incidents",
        "last_ingest",
        "evaluated_at",
    )


def pipeline_health(runs: DataFrame, tiebreak: str = "run_id") -> DataFrame:
    """Last run of every job, newest first."""
    last = first_per_key(
        runs.select("job_name", "status", "started_at", tiebreak),
        ["job_name"],
        [F.desc_nulls_first("started_at"), F.desc(tiebreak)],
    )
    return last.select(
        "job_name", F.col("started_at").alias("last_run_at"), F.col("status").alias("last_status")
    ).orderBy(F.desc_nulls_first("last_run_at"), "job_name")


def dq_summary(check_results: DataFrame, tiebreak: tuple[str, ...] = ("dq_run_id",)) -> DataFrame:
    """Last result of every check; a missing time is the latest. All but pass is failed."""
    last = first_per_key(
        check_results.select(*dict.fromkeys(("check_name", "status", "evaluated_at", *tiebreak))),
        ["check_name"],
        [F.desc_nulls_first("evaluated_at"), *[F.desc(c) for c in tiebreak]],
    )
    return last.select(
        "check_name",
        F.when(F.col("status") == "pass", "succeeded").otherwise("failed").alias("status"),
        F.col("evaluated_at").alias("last_run_at"),
    ).orderBy(F.desc_nulls_last("last_run_at"), F.asc("check_name"))


def dq_pass_rate(check_results: DataFrame, as_of: Instant = None) -> DataFrame:
    """Pass rate of every check over the last day."""
    recent = check_results.where(F.col("evaluated_at") >= instant(as_of) - hours(settings.RECENT_HOURS))
    counted = recent.groupBy("check_name").agg(
        F.count_if(F.col("status") == "pass").alias("n_pass"), F.count("*").alias("n_results")
    )
    rate = F.round(F.lit(100) * F.col("n_pass").cast("double") / F.col("n_results").cast("double"), 6)
    return counted.withColumn("pass_pct", rate)


def anomaly_summary(anomalies: DataFrame, anomaly_types: DataFrame, as_of: Instant = None) -> DataFrame:
    """Anomalies of the last day per known type, zero-filled.

    The recent anomalies are counted per type before the join.
    """
    recent = since(anomalies, "detected_at", instant(as_of) - hours(settings.RECENT_HOURS), "detected_date")
    counts = recent.groupBy("anomaly_type").agg(F.count("anomaly_id").alias("_n"))
    types = anomaly_types.select("anomaly_type").distinct()
    return types.join(counts, "anomaly_type", "left").select(
        "anomaly_type", F.coalesce("_n", F.lit(0)).alias("anomalies_24h")
    ).orderBy("anomaly_type")


def anomaly_severity(anomalies: DataFrame, as_of: Instant = None) -> DataFrame:
    """Severity breakdown of the last day's anomalies."""
    recent = since(anomalies, "detected_at", instant(as_of) - hours(settings.RECENT_HOURS), "detected_date")
    return recent.groupBy("anomaly_type", "severity").agg(F.count("*").alias("n_anomalies"))


def incident_kpis(incidents: DataFrame, as_of: Instant = None) -> DataFrame:
    """Incident counters, one row.

    ``resolved_count_24h`` counts by opening time and ``oldest_active_minutes`` looks at
    all incidents, as the dashboards expect. The corrected variants stand beside them.
    """
    now = instant(as_of)
    since = now - hours(settings.RECENT_HOURS)
    status = F.col("status")
    return incidents.agg(
        F.count_if(status == "open").alias("open_count"),
        F.count_if(status == "acknowledged").alias("acknowledged_count"),
        F.count_if(status == "resolved").alias("resolved_count_total"),
        F.count_if((status == "resolved") & (F.col("opened_at") >= since)).alias("resolved_count_24h"),
        whole_minutes(now, F.min("opened_at")).alias("oldest_active_minutes"),
        F.count_if((status == "resolved") & (F.col("resolved_at") >= since)).alias("resolved_in_24h"),
        whole_minutes(now, F.min(F.when(status != "resolved", F.col("opened_at")))).alias(
            "oldest_unresolved_minutes"
        ),
    )


def lifecycle_status() -> Column:
    """Status read from the lifecycle times, not from the status column."""
    return (
        F.when(F.col("resolved_at").isNotNull(), "resolved")
        .when(F.col("acknowledged_at").isNotNull(), "acknowledged")
        .otherwise("open")
    )


def incident_summary(incidents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Incident list for display; ``keep`` names further columns to carry."""
    return incidents.select(
        lifecycle_status().alias("status"),
        F.coalesce("opened_at", "created_at").alias("opened_at"),
        F.coalesce("severity", F.lit("unknown")).alias("severity"),
        F.concat(
            words(F.col("anomaly_type")), F.lit(" incident #"), F.col("incident_id").cast("string")
        ).alias("title"),
        "station_id",
        "metric_id",
        *keep,
    )


def recent_incidents(incidents: DataFrame, limit: int = settings.RECENT_INCIDENT_LIMIT) -> DataFrame:
    """Newest incidents with their opening time as text. A top-k report: the limit is the feature."""
    summary = incident_summary(incidents, keep=("incident_id",))
    newest = summary.orderBy(F.desc_nulls_last("opened_at"), F.desc("incident_id")).limit(limit)
    return newest.withColumn("opened_at", utc_text(F.col("opened_at"))).drop("incident_id")


def status_conflicts(incidents: DataFrame) -> DataFrame:
    """Counts of incidents whose status column and lifecycle times disagree."""
    derived = incidents.select("status", lifecycle_status().alias("lifecycle_status"))
    return (
        derived.where(~F.col("status").eqNullSafe(F.col("lifecycle_status")))
        .groupBy("status", "lifecycle_status")
        .agg(F.count("*").alias("n_incidents"))
    )


def semantic_views(tables: Mapping[str, DataFrame], as_of: Instant = None) -> dict[str, DataFrame]:
    """The seven named views."""
    incidents, checks, runs = tables["ops_incident"], tables["ops_dq_check_run"], tables["ops_job_run"]
    fact, station = tables["fact_observation"], tables["dim_station"]
    return {
        "vw_platform_status": platform_status(fact, incidents, checks, runs, as_of),
        "vw_pipeline_health": pipeline_health(runs),
        "vw_dq_summary": dq_summary(checks),
        "vw_anomaly_summary": anomaly_summary(tables["ops_anomaly"], tables["ops_anomaly_type"], as_of),
        "vw_incident_kpis": incident_kpis(incidents, as_of),
        "vw_incident_summary": incident_summary(incidents),
        "public_station_freshness": station_freshness(fact, station, as_of),
    }


def register_views(tables: Mapping[str, DataFrame], as_of: Instant = None) -> None:
    """Make the views available to SQL under their names."""
    for name, view in semantic_views(tables, as_of).items():
        view.createOrReplaceTempView(name)


def control_tower(tables: Mapping[str, DataFrame], as_of: Instant = None) -> dict[str, DataFrame]:
    """The five reads of the control-tower page, in display order and with times as UTC text."""
    views = semantic_views(tables, as_of)
    status = views["vw_platform_status"]
    health = views["vw_pipeline_health"].orderBy(F.desc_nulls_first("last_run_at"), "job_name")
    return {
        "status": status.select(
            "status",
            utc_text(F.col("last_ingest"), "HH:mm").alias("last_ingest"),
            F.lit("24h").alias("window"),
            F.lit("v1").alias("contracts"),
        ),
        "pipeline": health.withColumn("last_run_at", utc_text(F.col("last_run_at"))),
        "dq": views["vw_dq_summary"].orderBy("check_name").withColumn(
            "last_run_at", utc_text(F.col("last_run_at"))
        ),
        "anomalies": views["vw_anomaly_summary"].orderBy(F.desc_nulls_last("anomalies_24h"), "anomaly_type"),
        "incidents": views["vw_incident_kpis"].select(
            "open_count", "acknowledged_count", "resolved_count_total", "resolved_count_24h"
        ),
    }
