"""Run ledger: append-only events, state fold, and the incremental work lists.

Semi and anti joins reduce their right side to distinct keys first. That step
combines before the shuffle and leaves the side partitioned by the join key, so a
parent with very many children costs one row per map task.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewarden.functions.clock import Instant, instant
from tidewarden.functions.lookup import constant_frame
from tidewarden.functions.text import clip
from tidewarden.schemas import SCHEMAS
from tidewarden.settings import INGEST_JOB, TRANSFORM_JOB

_EVENT = SCHEMAS["ops_job_event"]


def ledger_start(
    spark: SparkSession, run_id: str, job_name: str, as_of: Instant, parent_run_id: str | None = None
) -> DataFrame:
    """Event row that opens a run."""
    return _event(spark, as_of, run_id=run_id, job_name=job_name, status="started", parent_run_id=parent_run_id)


def ledger_finish(
    spark: SparkSession,
    run_id: str,
    job_name: str,
    status: str,
    as_of: Instant,
    counts: dict | None = None,
    error_message: str | None = None,
    parent_run_id: str | None = None,
) -> DataFrame:
    """Event row that closes a run with its counters or its (clipped) error text."""
    event = _event(
        spark, as_of, run_id=run_id, job_name=job_name, status=status,
        error_message=error_message, parent_run_id=parent_run_id, **(counts or {}),
    )
    return event.withColumn("error_message", clip(F.col("error_message")))


def _event(spark: SparkSession, as_of: Instant, **values) -> DataFrame:
    row = tuple(values.get(f.name) for f in _EVENT.fields)
    return constant_frame(spark, [row], _EVENT).withColumns(
        {"event_at": instant(as_of), "recorded_at": F.lit(datetime.now(timezone.utc))}
    )


def events_for(runs: DataFrame, job_name: str, status: str, as_of: Instant) -> DataFrame:
    """Event rows for many runs at once; columns missing from ``runs`` are null."""
    given = {
        "job_name": F.lit(job_name), "status": F.lit(status), "event_at": instant(as_of),
        "recorded_at": F.lit(datetime.now(timezone.utc)),
        **{c: F.col(c) for c in runs.columns},
    }
    return runs.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in _EVENT.fields]
    )


def ledger_state(events: DataFrame) -> DataFrame:
    """Current state per run: what row-by-row updates of a ledger table would show.

    ``started_at`` comes from the opening event; status, counters and message from
    the last event. Events are ordered by the clock when they were written, which tells
    the attempts of a rerun apart, then by their time; on equal times the closing event
    is the later one, and of two closing ones the success.
    """
    recorded = F.col("recorded_at") if "recorded_at" in events.columns else F.lit(None).cast("timestamp")
    later = F.struct(recorded, F.col("event_at"), F.col("status") != "started", F.col("status"))
    last = ["status", "rows_inserted", "rows_updated", "rows_deduped", "error_message"]
    if "rows_rejected" not in events.columns:
        events = events.withColumn("rows_rejected", F.lit(None).cast("bigint"))
    last.append("rows_rejected")
    folded = events.groupBy("run_id").agg(
        F.max_by(F.struct(*last), later).alias("last"),
        F.max("job_name").alias("job_name"),
        F.max("parent_run_id").alias("parent_run_id"),
        F.min("event_at").alias("started_at"),
        F.max(F.when(F.col("status") != "started", F.col("event_at"))).alias("ended_at"),
        F.min("watermark_from").alias("watermark_from"),
        F.max("watermark_to").alias("watermark_to"),
    )
    flat = folded.select("*", "last.*").drop("last")
    return flat.select(*SCHEMAS["ops_job_run"].fieldNames())


def _parents(runs: DataFrame, job: str, status: str | None = None) -> DataFrame:
    children = runs.where((F.col("job_name") == job) & F.col("parent_run_id").isNotNull())
    if status:
        children = children.where(F.col("status") == status)
    return children.select(F.col("parent_run_id").alias("run_id")).distinct()


def _succeeded(runs: DataFrame, job: str) -> DataFrame:
    return runs.where((F.col("job_name") == job) & (F.col("status") == "succeeded"))


def pending_runs(
    runs: DataFrame,
    ingest_job: str = INGEST_JOB,
    transform_job: str = TRANSFORM_JOB,
    retry_failed: bool = False,
) -> DataFrame:
    """Succeeded ingest runs without a transform child, whatever the child's status.

    With ``retry_failed`` a run whose transforms all failed is pending again.
    """
    done = _parents(runs, transform_job, "succeeded" if retry_failed else None)
    return _succeeded(runs, ingest_job).join(done, "run_id", "left_anti")


def work_queue(runs: DataFrame) -> DataFrame:
    """Runs in the order a worker would take them, oldest first."""
    return runs.orderBy(F.asc_nulls_last("started_at"), F.asc("run_id"))


def eligible_check_runs(
    runs: DataFrame,
    check_results: DataFrame,
    ingest_job: str = INGEST_JOB,
    transform_job: str = TRANSFORM_JOB,
    retry_job: str | None = None,
) -> DataFrame:
    """Succeeded ingest runs with a succeeded transform and no check result yet.

    With ``retry_job`` a run whose last child of that job failed is eligible again, so that
    what failed is done; results that it has stay as they are.
    """
    transformed = _parents(runs, transform_job, "succeeded")
    checked = check_results.select("run_id").where(F.col("run_id").isNotNull()).distinct()
    if retry_job:
        children = runs.where((F.col("job_name") == retry_job) & F.col("parent_run_id").isNotNull())
        last = children.groupBy(F.col("parent_run_id").alias("run_id")).agg(
            F.max_by("status", F.struct("started_at", "run_id")).alias("_last"))
        checked = checked.join(last.where("_last = 'failed'").select("run_id"), "run_id", "left_anti")
    return (
        _succeeded(runs, ingest_job)
        .join(transformed, "run_id", "left_semi")
        .join(checked, "run_id", "left_anti")
    )


def run_watermarks(rows: DataFrame, run: str = "ingest_run_id") -> DataFrame:
    """Range of observation times each run handled."""
    return rows.groupBy(F.col(run).alias("run_id")).agg(
        F.min("observed_at").alias("watermark_from"),
        F.max("observed_at").alias("watermark_to"),
        F.count("*").alias("n_rows"),
    )
