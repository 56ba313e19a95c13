"""Whole jobs: ingest, transform, checks, detection. Each is a few set-wise plans."""

from __future__ import annotations

import hashlib
import time
import traceback
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from tidewarden import settings
from tidewarden.functions.clock import Instant, instant
from tidewarden.functions.lookup import constant_frame
from tidewarden.functions.text import digest
from tidewarden.operators import detectors, incidents, ledger, payload, quality, transform
from tidewarden.operators.merge import upsert, upsert_counts
from tidewarden.schemas import KEYS, SCHEMAS
from tidewarden.sources.payloads import CORRUPT, SOURCE_FILE, read_payloads
from tidewarden.sources.warehouse import DAYS, Warehouse, staged, staged_counted, touched_days

RAW, FACT = "raw_observations", "fact_observation"
JOBS_AT_ONCE = 8


def run_identity(job: str, name: str) -> str:
    """Run id of a job; the same name (by default the time it stands for) is the same run."""
    return hashlib.sha256(f"{len(job)}:{job}{name}".encode()).hexdigest()[:32]


def _since(as_of: datetime, begun: datetime) -> datetime:
    """The time a run ends that stands for ``as_of``: later by what it has taken."""
    return as_of + (datetime.now(timezone.utc) - begun)


def _with_ledger(
    wh: Warehouse, job: str, as_of: datetime, body: Callable[[str], dict], run_name: str = ""
) -> str:
    """Run ``body(run_id)`` between a start and a finish row; a failure is recorded and raised."""
    run_id = run_identity(job, run_name or as_of.isoformat())
    begun = datetime.now(timezone.utc)
    wh.append("ops_job_event", ledger.ledger_start(wh.spark, run_id, job, as_of))
    try:
        counts = body(run_id)
    except Exception as error:
        text = f"{type(error).__name__}: {error}\n{traceback.format_exc(limit=5)}"
        wh.append(
            "ops_job_event",
            ledger.ledger_finish(wh.spark, run_id, job, "failed", _since(as_of, begun), error_message=text),
        )
        raise
    wh.append("ops_job_event", ledger.ledger_finish(wh.spark, run_id, job, "succeeded", _since(as_of, begun), counts))
    return run_id


def ingest_documents(
    wh: Warehouse,
    documents: DataFrame,
    as_of: datetime,
    run_id: str,
    metrics: Sequence[settings.PayloadMetric] = settings.PAYLOAD_METRICS,
    provider: str = settings.PROVIDER,
) -> dict:
    """Reshape documents of active stations and append them to raw; returns the run's counters.

    Lines that the reader could not parse are set aside in ``ops_rejected_document``. The lines are parsed once,
    and the same pass counts the ones to set aside.
    """
    rejected = 0
    if CORRUPT in documents.columns:
        is_bad = F.col(CORRUPT).isNotNull()
        landed, seen = staged_counted(documents, "landed", bad=F.count_if(is_bad))
        rejected = seen["bad"]
        if rejected:
            wh.append("ops_rejected_document", _rejected(landed.where(is_bad), run_id, as_of))
        documents = landed.where(~is_bad).drop(CORRUPT, SOURCE_FILE)
    wanted = detectors.active_stations(wh.read("dim_station")).select("station_external_id").distinct()
    rows = payload.payload_rows(
        documents.join(wanted, "station_external_id", "left_semi"), as_of, metrics, provider
    )
    written, span = staged_counted(
        rows.withColumns({"ingested_at": instant(as_of), "ingest_run_id": F.lit(run_id)}), "ingest",
        watermark_from=F.min("observed_at"), watermark_to=F.max("observed_at"),
    )
    batch = written.select(*SCHEMAS[RAW].fieldNames())
    partition, time = DAYS[RAW]
    # A rerun finds its own rows; they do not count as a target to update.
    earlier = wh.stored(RAW).where(touched_days(batch, F.to_date(time), partition)).where(
        F.col("ingest_run_id") != run_id
    )
    keys = KEYS[RAW]
    known = earlier.select(*keys).distinct()
    counted = upsert_counts(
        upsert(known.withColumn("ingested_at", F.lit(None).cast("timestamp")), batch, keys, ["ingested_at"])
    )
    counts = {**counted.first().asDict(), **span, "rows_rejected": rejected}
    # The days come first: a run that is found in raw has them noted.
    wh.append("ops_run_day", run_days(batch))
    wh.append(RAW, batch)
    return counts


def run_days(raw: DataFrame) -> DataFrame:
    """Days on which each run wrote raw rows: what a transform of the run has to read."""
    return raw.groupBy(F.col("ingest_run_id").alias("run_id"), F.to_date(DAYS[RAW][1]).alias("observed_date")).agg(
        F.count("*").alias("n_rows"))


def _rejected(lines: DataFrame, run_id: str, as_of: Instant) -> DataFrame:
    parsed = [c for c in lines.columns if c not in (CORRUPT, SOURCE_FILE)]
    return lines.select(
        F.lit(run_id).alias("run_id"), F.col(SOURCE_FILE).alias("source_file"), F.col(CORRUPT).alias("record"),
        F.to_json(F.struct(*parsed)).alias("parsed"), instant(as_of).alias("rejected_at"),
    )


def ingest_frame(
    wh: Warehouse,
    documents: DataFrame,
    as_of: datetime,
    metrics: Sequence[settings.PayloadMetric] = settings.PAYLOAD_METRICS,
    provider: str = settings.PROVIDER,
    run_name: str = "",
) -> str:
    """Documents to raw observations as one run; ``run_name`` tells apart runs of one time."""
    job = settings.INGEST_JOB
    return _with_ledger(
        wh, job, as_of, lambda run: ingest_documents(wh, documents, as_of, run, metrics, provider), run_name
    )


def ingest(
    wh: Warehouse,
    payload_path: str,
    as_of: datetime,
    metrics: Sequence[settings.PayloadMetric] = settings.PAYLOAD_METRICS,
    provider: str = settings.PROVIDER,
) -> str:
    """Landed documents to raw observations. Returns the run id."""
    return ingest_frame(wh, read_payloads(wh.spark, payload_path, metrics), as_of, metrics, provider)


def transform_pending(
    raw: DataFrame,
    station: DataFrame,
    metric: DataFrame,
    runs: DataFrame,
    tie_order: Sequence[str] = ("source", "value_num"),
) -> DataFrame:
    """Facts of the given runs in one plan.

    A loop over the runs would let the later run win a shared key, so the run's start
    decides first, then the time of storing. The list of runs is stored first, so that
    its size is known when the join is planned.
    """
    work = staged(runs.select("run_id", F.col("started_at").alias("run_started_at")), "runs")
    return newest_of_runs(transform.to_facts(transform.of_runs(raw, work), station, metric), tie_order)


def newest_of_runs(rows: DataFrame, tie_order: Sequence[str] = ("source", "value_num")) -> DataFrame:
    """One row per fact key of the rows of several runs, as if they were transformed in their order."""
    order = ["run_started_at", "ingest_run_id", "ingested_at", *tie_order]
    return transform.latest_wins(rows, KEYS[FACT], order).select(*SCHEMAS[FACT].fieldNames())


def select_runs(runs: DataFrame, run_ids: Sequence[str] | None, retry_failed: bool = False) -> DataFrame:
    """The pending runs, or exactly the runs named by hand."""
    if run_ids is None:
        return ledger.pending_runs(runs, retry_failed=retry_failed)
    if not run_ids:
        raise ValueError("run_ids is empty: name at least one run or pass None")
    return runs.where(F.col("run_id").isin(list(run_ids)))


def transform_runs(
    wh: Warehouse,
    as_of: datetime,
    run_ids: Sequence[str] | None = None,
    retry_failed: bool = False,
    unit_factors: DataFrame | None = None,
) -> int:
    """All pending (or named) ingest runs to facts. Returns the number of runs handled."""
    work = staged(
        select_runs(wh.read("ops_job_run"), run_ids, retry_failed).select(
            "run_id", "started_at", "watermark_from", "watermark_to",
            F.coalesce(F.col("rows_inserted") + F.col("rows_updated") > 0, F.lit(True)).alias("has_rows"),
        ),
        "transform-runs",
    )
    found, low, high, unbounded = work.agg(
        F.count("*"),
        F.to_date(F.min("watermark_from")),
        F.to_date(F.max("watermark_to")),
        F.count_if(F.col("watermark_from").isNull() & F.col("has_rows")),
    ).first()
    if not found:
        return 0
    begun = datetime.now(timezone.utc)
    child = work.select(
        digest(F.lit(settings.TRANSFORM_JOB), F.col("run_id"), instant(as_of)).alias("run_id"),
        F.col("run_id").alias("parent_run_id"),
    )
    wh.append("ops_job_event", ledger.events_for(child, settings.TRANSFORM_JOB, "started", as_of))
    try:
        # The noted days of the runs are read. Runs from before days were noted are bounded by
        # their watermarks; one that may have stored rows without either makes it all days.
        partition = DAYS[RAW][0]
        noted = wh.read("ops_run_day").join(work.select("run_id"), "run_id", "left_semi")
        days = touched_days(noted, F.col("observed_date"), partition)
        if not work.where("has_rows").join(noted.select("run_id").distinct(), "run_id", "left_anti").isEmpty():
            days = F.lit(True) if unbounded else days | F.col(partition).between(low, high)
        started = work.select("run_id", F.col("started_at").alias("run_started_at"))
        raw = transform.of_runs(wh.current_raw(days, work), started)
        if unit_factors is not None:
            raw = transform.normalize_units(raw, unit_factors, metric=wh.read("dim_metric"))
        facts = staged(transform.to_facts(raw, wh.read("dim_station"), wh.read("dim_metric")), "transform-facts")
        wh.merge_facts(newest_of_runs(facts))
        stats = ledger.run_watermarks(facts.select("ingest_run_id", "observed_at"))
    except Exception as error:
        text = f"{type(error).__name__}: {error}\n{traceback.format_exc(limit=8)}"
        failed = child.withColumn("error_message", F.lit(text[: settings.MESSAGE_LIMIT]))
        wh.append("ops_job_event", ledger.events_for(failed, settings.TRANSFORM_JOB, "failed", _since(as_of, begun)))
        raise
    done = child.join(stats.withColumnRenamed("run_id", "parent_run_id"), "parent_run_id", "left").select(
        "run_id", "parent_run_id", "watermark_from", "watermark_to",
        F.coalesce("n_rows", F.lit(0)).alias("rows_inserted"),
    )
    wh.append("ops_job_event", ledger.events_for(done, settings.TRANSFORM_JOB, "succeeded", _since(as_of, begun)))
    return found


def check_runs(
    wh: Warehouse, as_of: datetime, definitions: Sequence[quality.CheckDefinition] | None = None
) -> int:
    """Quality checks for every eligible ingest run. Returns the number of results stored.

    Each check is a job of its own, several at a time, each in a scheduler pool of its name, with a row in
    ``ops_dq_check_outcome``. One that cannot be computed leaves the results of the others as they are; the
    runs' check runs then end as failed with its error, and the next call computes what is missing. If no
    check can be computed the first error is raised.
    """
    if definitions is None:
        definitions = quality.active_definitions(wh.read("ops_dq_check_definition"))
    active = [d for d in definitions if d.is_active]
    stored = wh.read("ops_dq_check_run")
    eligible, seen = staged_counted(
        ledger.eligible_check_runs(wh.read("ops_job_run"), stored, retry_job=settings.CHECKS_JOB).select("run_id"), "check-runs"
    )
    if not seen["n"]:
        return 0
    begun = datetime.now(timezone.utc)
    child = eligible.select(
        digest(F.lit(settings.CHECKS_JOB), F.col("run_id"), instant(as_of)).alias("run_id"),
        F.col("run_id").alias("parent_run_id"),
    )
    wh.append("ops_job_event", ledger.events_for(child, settings.CHECKS_JOB, "started", as_of))
    if any(d.sql_template and not d.built_in for d in active):
        for name in (RAW, FACT, "dim_station", "dim_metric", "ops_job_run"):
            wh.read(name).createOrReplaceTempView(name)
        eligible.createOrReplaceTempView("eligible_runs")
    # Duplicates are those of the current raw rows: the stored log repeats re-delivered keys.
    tables = quality.Checked(wh.read(RAW), wh.stored(FACT), wh.read("dim_station"), wh.read("dim_metric"), wh.heads())
    outcomes = _computed_apart(wh, eligible, active, tables, as_of)
    rows = [(d.name, as_of, "failed" if o.error else "succeeded", seen["n"], o.n_results, o.duration_ms,
             str(o.error)[: settings.MESSAGE_LIMIT] if o.error else None) for d, o in zip(active, outcomes)]
    wh.append("ops_dq_check_outcome", constant_frame(wh.spark, rows, SCHEMAS["ops_dq_check_outcome"]))
    errors = [f"{d.name}: {type(o.error).__name__}: {o.error}" for d, o in zip(active, outcomes) if o.error]
    results = [o.results for o in outcomes if o.results is not None]
    n_stored, counted = 0, child.withColumn("rows_inserted", F.lit(0))
    if results:
        new = quality.new_check_results(stored, reduce(DataFrame.unionByName, results))
        fresh, found = staged_counted(new, "check-results")
        wh.append("ops_dq_check_run", fresh)
        n_stored = found["n"]
        total = fresh.groupBy(F.col("run_id").alias("parent_run_id")).agg(F.count("*").alias("rows_inserted"))
        counted = child.join(total, "parent_run_id", "left")
    status = "failed" if errors else "succeeded"
    if errors:
        counted = counted.withColumn("error_message", F.lit("\n".join(errors)[: settings.MESSAGE_LIMIT]))
    wh.append("ops_job_event", ledger.events_for(counted, settings.CHECKS_JOB, status, _since(as_of, begun)))
    if errors and not results:
        raise next(o.error for o in outcomes if o.error)
    return n_stored


@dataclass(frozen=True)
class CheckOutcome:
    """What became of one check: its results, or the error."""

    results: DataFrame | None
    n_results: int
    duration_ms: int
    error: Exception | None = None


def _computed_apart(
    wh: Warehouse, runs: DataFrame, definitions: Sequence[quality.CheckDefinition], tables: quality.Checked, as_of: Instant
) -> list[CheckOutcome]:
    """Every check's results, written by a job of its own; jobs are submitted side by side."""
    def computed(definition: quality.CheckDefinition) -> CheckOutcome:
        begun = datetime.now(timezone.utc)
        try:
            results, seen = staged_counted(quality.check_results(runs, definition, tables, as_of), "check")
            error, n = None, seen["n"]
        except Exception as failure:
            results, n, error = None, 0, failure
        took = (datetime.now(timezone.utc) - begun).total_seconds()
        return CheckOutcome(results, n, int(took * 1000), error)

    return _side_by_side(wh, computed, definitions, lambda d: d.name)


def detect_and_open_incidents(
    wh: Warehouse,
    as_of: datetime,
    config: detectors.DetectorConfig = detectors.DetectorConfig(),
    registry: Sequence[detectors.Detector] = detectors.BUILT_IN,
    respect_switches: bool = False,
) -> str:
    """Detect, open or touch incidents, link, store new anomalies. Returns the run id.

    The summary of the series is what all detectors but the flatline one read, and that one
    reads the days of its window. Detectors run side by side, each a run of its own with a start,
    a final row and its own duration; what they found is stored together. One that fails is recorded
    and does not stop the others; the run fails after the last. With ``respect_switches`` types that the type table disables are left out.
    """

    def body(run_id: str) -> dict:
        observed = detectors.Observed(wh.stored(FACT), wh.read("dim_station"), wh.read("dim_metric"), wh.heads())
        begun = datetime.now(timezone.utc)
        _store_detector_runs(wh, run_id, begun, {d.name: None for d in registry})

        took: dict[str, float] = {}

        def detected(detector: detectors.Detector) -> DataFrame | Exception:
            own = time.perf_counter()
            try:
                found = detectors.detect_all(observed, config, as_of, [detector])
                if respect_switches:
                    found = detectors.enabled_only(found, wh.read("ops_anomaly_type"))
                return staged(incidents.stamp_anomalies(found, as_of), "detected")
            except Exception as error:
                return error
            finally:
                took[detector.name] = time.perf_counter() - own

        outcomes = dict(zip([d.name for d in registry], _side_by_side(wh, detected, registry, lambda d: d.name)))
        failed = {name: o for name, o in outcomes.items() if isinstance(o, Exception)}
        frames = [o for o in outcomes.values() if not isinstance(o, Exception)]
        counts, inserted = {}, 0
        storing = time.perf_counter()
        if frames:
            try:
                found = reduce(DataFrame.unionByName, frames)
                stored = store_anomalies(wh, found, as_of)
                linked = stored.links.join(stored.anomalies.select("anomaly_id", "detector"), "anomaly_id")
                rows = detectors.detector_counts(found, stored.anomalies, linked).collect()  # a row per detector
                counts = {r.detector: (r.rows_detected, r.rows_inserted, r.rows_linked) for r in rows}
                inserted = stored.n_new
            except Exception as error:
                failed |= {name: error for name in outcomes if name not in failed}
        ended = {name: failed.get(name) or counts.get(name, (0, 0, 0)) for name in outcomes}
        shared = time.perf_counter() - storing
        _store_detector_runs(wh, run_id, begun, ended, {name: took[name] + shared for name in ended})
        if failed:
            raise next(iter(failed.values()))
        return {"rows_inserted": inserted}

    return _with_ledger(wh, settings.DETECTION_JOB, as_of, body)


def _side_by_side(wh: Warehouse, work: Callable, items: Sequence, pool_name: Callable) -> list:
    """``work(item)`` for every item, several at a time, each submitting its jobs to a scheduler pool of its name."""
    context = wh.spark.sparkContext

    @inheritable_thread_target(wh.spark)
    def run(item):
        context.setLocalProperty("spark.scheduler.pool", pool_name(item))
        return work(item)

    with ThreadPoolExecutor(max_workers=JOBS_AT_ONCE) as pool:
        return list(pool.map(run, items))


class Stored(NamedTuple):
    """New anomalies and new links, and how many there are."""

    anomalies: DataFrame
    links: DataFrame
    n_new: int
    n_linked: int


def store_anomalies(wh: Warehouse, found: DataFrame, as_of: Instant) -> Stored:
    """Group new anomalies into incidents, then insert-or-ignore the stamped anomalies.

    An anomaly is stored last: as long as it
    is not, a rerun finds it new again, meets the incident that it opened and its link,
    whose ids are digests, and completes what is missing.
    """
    partition, time = DAYS["ops_anomaly"]
    known = wh.stored("ops_anomaly").where(touched_days(found, F.to_date(time), partition))
    fresh, seen = staged_counted(incidents.new_anomalies(known, found), "new-anomalies")
    current = wh.read("ops_incident")
    resolved = staged(incidents.resolve_incidents(current, fresh), "incidents")
    opened = incidents.opened_incidents(resolved, as_of)
    reused = current.join(resolved.where("NOT is_new").select("incident_id").distinct(), "incident_id", "left_semi")
    touched = incidents.touch_incidents(reused, resolved, as_of)
    versions = opened.unionByName(touched.select(*opened.columns)).withColumn("version_at", instant(as_of))
    wh.append("ops_incident", staged(versions, "incident-versions"))
    links, linked = staged_counted(
        incidents.link_incidents(wh.read("ops_incident_anomaly"), resolved, fresh, as_of), "links"
    )
    wh.append("ops_incident_anomaly", links)
    wh.append("ops_anomaly", fresh)
    return Stored(fresh, links, seen["n"], linked["n"])


def _store_detector_runs(
    wh: Warehouse, run_id: str, begun: datetime, outcomes: dict[str, tuple[int, ...] | Exception | None],
    seconds: dict[str, float] | None = None,
) -> None:
    """Append the detectors' starts (no outcome yet) or their ends. The last row per run and detector counts."""
    now = datetime.now(timezone.utc)

    def row(name: str, outcome) -> tuple:
        took = int(1000 * seconds[name]) if seconds else None
        if outcome is None:
            return (run_id, name, begun, None, None, 0, 0, 0, "started", None)
        if isinstance(outcome, Exception):
            text = f"{type(outcome).__name__}: {outcome}"[: settings.MESSAGE_LIMIT]
            return (run_id, name, begun, now, took, 0, 0, 0, "failed", text)
        return (run_id, name, begun, now, took, *outcome, "succeeded", None)

    rows = [row(name, outcome) for name, outcome in outcomes.items()]
    wh.append("ops_anomaly_detector_run", constant_frame(wh.spark, rows, SCHEMAS["ops_anomaly_detector_run"]))
