"""One registered query per operator, each beside the SQL it must agree with.

Every query runs over the whole given tables. Results leave as naive UTC times and
doubles (:func:`acceptance.given.plain`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from acceptance.ctes import floor_minutes, floor_seconds, minutes_2, percent, with_ctes
from acceptance.given import (
    CHECKS, DETECTION, DOCUMENT_METRICS, DOCUMENT_TIME, EPSILONS, JUMPS, Given, event_stream, ordered_event_stream, plain, raw_from_events,
)
from tidewarden.functions.lookup import constant_frame
from tidewarden.operators import detectors, incidents, ledger, payload, quality, security, transform
from tidewarden.operators.merge import history, latest_wins, upsert, upsert_counts
from tidewarden.operators.series import series_heads
from tidewarden.plans import jobs, views
from tidewarden.schemas import KEYS
from tidewarden.session import shared_folder
from tidewarden.sources.warehouse import Warehouse, staged
from tidewarden.streaming.heads import HeadStore, jumps_on_arrival
from tidewarden.streaming.transform import start_transform

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, local: str = ""):
    """Register a function of :class:`Given` under its name, with its SQL."""

    def register(build: Callable[[Given], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Given(spark, sf_dir)))

        run.__module__ = build.__module__
        QUERIES[build.__name__] = run
        ORACLES[build.__name__] = with_ctes(sql, local)
        return build

    return register


NOW = "(SELECT now FROM t_now)"

# --- stations and payloads -----------------------------------------------------


@query("""SELECT station_external_id, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon
          FROM t_watch WHERE lat IS NOT NULL""")
def active_stations(g: Given) -> DataFrame:
    return detectors.active_stations(g.station_core)


@query("""SELECT CAST(user_id AS VARCHAR) AS station_external_id, CAST(day AS VARCHAR) AS day,
                 CAST(hour_index AS INTEGER) AS hour_index, hour AS observed_at FROM t_picked""")
def payload_pick_hour(g: Given) -> DataFrame:
    picked = payload.pick_hours(g.documents, DOCUMENT_TIME)
    return picked.select("station_external_id", F.col("day").cast("string").alias("day"), "hour_index", "observed_at")


@query("""SELECT 'events' AS source, station_external_id, observed_at, metric_code,
                 CASE WHEN metric_code <> 'error' THEN value END AS value_num,
                 CASE WHEN metric_code = 'error' THEN CAST(value AS VARCHAR) END AS value_text, unit
          FROM t_payload_rows""")
def payload_rows(g: Given) -> DataFrame:
    rows = payload.payload_rows(g.documents, DOCUMENT_TIME, DOCUMENT_METRICS, "events")
    return rows.drop("quality_flag", "source_payload")


@query("""SELECT 'events' AS provider, station_external_id, CAST(-90 + user_id % 180 AS DOUBLE) AS latitude,
                 CAST(-180 + user_id % 360 AS DOUBLE) AS longitude,
                 strftime(observed_at, '%Y-%m-%dT%H:%M') AS observed_at, metric_code || '_series' AS field,
                 metric_code, source_unit AS unit, value FROM t_payload_rows""")
def payload_json_slice(g: Given) -> DataFrame:
    rows = payload.payload_rows(g.documents, DOCUMENT_TIME, DOCUMENT_METRICS, "events")
    return payload.parsed_slice(rows).withColumn("value", F.col("value").cast("double"))


@query("""SELECT * FROM (
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'quantity' AS metric_code, l_quantity AS value_num FROM w
            UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'extendedprice', l_extendedprice FROM w
            UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'discount', l_discount FROM w
            UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'tax', l_tax FROM w)
          WHERE value_num IS NOT NULL""",
       local="""w AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                             nullif(l_discount, 0) AS l_discount, l_tax FROM lineitem)""")
def payload_unpivot(g: Given) -> DataFrame:
    codes = {f"l_{c}": c for c in ("quantity", "extendedprice", "discount", "tax")}
    return payload.unpivot_metrics(g.wide, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], codes)


@query("""SELECT id, metric_code, CASE WHEN unit = 'cents' THEN CAST(value_num * 0.01 AS DOUBLE)
                 ELSE CAST(value_num AS DOUBLE) END AS value_num, 'USD' AS unit, unit AS source_unit
          FROM t_raw WHERE value_num IS NOT NULL""")
def unit_normalize(g: Given) -> DataFrame:
    converted = transform.normalize_units(g.raw.where("value_num IS NOT NULL"), g.unit_factors)
    return converted.select("id", "metric_code", "value_num", "unit", "source_unit")


# --- merges --------------------------------------------------------------------

RAW_MERGE = """
    tagged AS (SELECT *, false AS is_source FROM t_raw WHERE observed_at < TIMESTAMP '2024-01-21'
               QUALIFY row_number() OVER (PARTITION BY source, station_external_id, observed_at, metric_code
                                          ORDER BY ingested_at DESC, id DESC) = 1
               UNION ALL SELECT *, true FROM t_raw WHERE observed_at >= TIMESTAMP '2024-01-16'),
    merged AS (SELECT *, count(*) FILTER (is_source) OVER k AS n_source, count(*) FILTER (NOT is_source) OVER k AS n_target,
                      row_number() OVER (PARTITION BY source, station_external_id, observed_at, metric_code
                                         ORDER BY is_source DESC, ingested_at DESC, id DESC) AS rn
               FROM tagged WINDOW k AS (PARTITION BY source, station_external_id, observed_at, metric_code))"""


def _raw_merge(g: Given) -> DataFrame:
    keys, order = KEYS["raw_observations"], ["ingested_at", "id"]
    target = latest_wins(g.raw.where(F.col("observed_at") < F.lit("2024-01-21").cast("timestamp")), keys, order)
    source = g.raw.where(F.col("observed_at") >= F.lit("2024-01-16").cast("timestamp"))
    return upsert(target, source, keys, order)


@query("""SELECT source, station_external_id, observed_at, metric_code, id, CAST(value_num AS DOUBLE) AS value_num, unit,
                 ingested_at, ingest_run_id,
                 CASE WHEN n_source = 0 THEN 'kept' WHEN n_target = 0 THEN 'inserted' ELSE 'updated' END AS action,
                 CAST(n_target = 0 AS BIGINT) AS n_inserted, n_source - CAST(n_target = 0 AS BIGINT) AS n_updated
          FROM merged WHERE rn = 1""", local=RAW_MERGE)
def raw_upsert(g: Given) -> DataFrame:
    return _raw_merge(g).select(
        *KEYS["raw_observations"], "id", "value_num", "unit", "ingested_at", "ingest_run_id",
        "action", "n_inserted", "n_updated",
    )


@query("""SELECT CAST(sum(CAST(n_target = 0 AS BIGINT)) AS BIGINT) AS rows_inserted,
                 CAST(sum(n_source - CAST(n_target = 0 AS BIGINT)) AS BIGINT) AS rows_updated,
                 CAST(0 AS BIGINT) AS rows_deduped
          FROM merged WHERE rn = 1 AND n_source > 0""", local=RAW_MERGE)
def raw_upsert_counts(g: Given) -> DataFrame:
    return upsert_counts(_raw_merge(g))


FACT_COLUMNS = """station_id, metric_id, observed_at, CAST(value_num AS DOUBLE) AS value_num, source, ingested_at,
                  is_late, ingest_run_id"""


@query(f"SELECT {FACT_COLUMNS} FROM t_fact")
def fact_upsert(g: Given) -> DataFrame:
    return g.fact


@query("""SELECT station_id, metric_id, observed_at, CAST(value_num AS DOUBLE) AS value_num, ingest_run_id,
                 CASE WHEN NOT bool_or(src) OVER k THEN 'kept' WHEN bool_and(src) OVER k THEN 'inserted'
                      ELSE 'updated' END AS action
          FROM (SELECT *, ingested_at >= TIMESTAMP '2024-01-16' AS src FROM t_fact_rows
                QUALIFY row_number() OVER (PARTITION BY station_id, metric_id, observed_at,
                            ingested_at >= TIMESTAMP '2024-01-16' ORDER BY ingested_at DESC, id DESC) = 1)
          WINDOW k AS (PARTITION BY station_id, metric_id, observed_at)
          QUALIFY row_number() OVER (PARTITION BY station_id, metric_id, observed_at ORDER BY src DESC) = 1""")
def fact_merge(g: Given) -> DataFrame:
    """Facts of two deliveries, the second merged over the first."""
    cut = F.lit("2024-01-16").cast("timestamp")
    order = ["ingested_at", "id"]
    early = transform.latest_facts(g.raw.where(F.col("ingested_at") < cut), g.station_core, g.metric, order)
    later = transform.latest_facts(g.raw.where(F.col("ingested_at") >= cut), g.station_core, g.metric, order)
    merged = upsert(early, later, KEYS["fact_observation"], ["ingested_at"])
    return merged.select(*KEYS["fact_observation"], "value_num", "ingest_run_id", "action")


@query("""SELECT anomaly_id, anomaly_type, station_id, metric_id_dedup, detected_hour FROM t_anomaly
          WHERE detected_at >= TIMESTAMP '2024-01-16'
          QUALIFY row_number() OVER (PARTITION BY anomaly_type, station_id, metric_id_dedup, detected_hour
                                     ORDER BY detected_at, anomaly_id) = 1""")
def anomaly_dedup_insert(g: Given) -> DataFrame:
    """All anomalies offered to a table that holds those before a date."""
    stored = latest_wins(
        g.anomaly.where(F.col("detected_at") < F.lit("2024-01-16").cast("timestamp")),
        KEYS["ops_anomaly"], ["detected_at", "anomaly_id"],
    )
    return incidents.new_anomalies(stored, g.anomaly).select("anomaly_id", *KEYS["ops_anomaly"])


@query("""SELECT run_id, check_name, status, l_partkey FROM t_dq
          QUALIFY row_number() OVER (PARTITION BY run_id, check_name
                                     ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, status) = 1""")
def dq_insert_ignore(g: Given) -> DataFrame:
    order = [F.asc(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "status")]
    stored = quality.empty_results(g.spark)
    return quality.new_check_results(stored, g.check_results, order).select(
        "run_id", "check_name", "status", "l_partkey"
    )


@query("""SELECT station_id, station_name, region, valid_from, lead(valid_from) OVER w AS valid_to,
                 lead(valid_from) OVER w IS NULL AS is_current
          FROM moved WINDOW w AS (PARTITION BY station_id ORDER BY valid_from)""",
       local="""moved AS (
            SELECT station_id, station_name, region, TIMESTAMP '2024-01-01' AS valid_from FROM t_station
            UNION ALL SELECT station_id, station_name, 'NEW ' || region, TIMESTAMP '2024-01-15' FROM t_station
                      WHERE station_id % 5 = 0)""")
def scd2_stations(g: Given) -> DataFrame:
    return history(g.station_changes, "station_id", ["station_name", "region"], "valid_from")


# --- transform and ledger ------------------------------------------------------

TRANSFORM_SQL = """
    SELECT station_id, metric_id, observed_at, CAST(value_num AS DOUBLE) AS value_num, is_late, ingest_run_id
    FROM t_fact_rows f JOIN t_day_runs r ON r.run_id = f.ingest_run_id
    WHERE {condition}
    QUALIFY row_number() OVER (PARTITION BY station_id, metric_id, observed_at
                               ORDER BY r.started_at DESC, r.run_id DESC, ingested_at DESC, id DESC) = 1"""
PICKED_RUNS = ("ev-2024-01-03", "ev-2024-01-04", "ev-2024-01-14")
TRANSFORM_COLUMNS = (*KEYS["fact_observation"], "value_num", "is_late", "ingest_run_id")


@query(TRANSFORM_SQL.format(condition="r.status = 'succeeded'"))
def transform_pending(g: Given) -> DataFrame:
    runs = jobs.select_runs(g.day_runs, None)
    return jobs.transform_pending(g.raw, g.station_core, g.metric, runs, ["id"]).select(*TRANSFORM_COLUMNS)


@query(TRANSFORM_SQL.format(condition=f"r.run_id IN {PICKED_RUNS}"))
def transform_selected_runs(g: Given) -> DataFrame:
    runs = jobs.select_runs(g.day_runs, PICKED_RUNS)
    return jobs.transform_pending(g.raw, g.station_core, g.metric, runs, ["id"]).select(*TRANSFORM_COLUMNS)


@query("""SELECT i.run_id, i.started_at FROM t_runs i
          LEFT JOIN (SELECT DISTINCT parent_run_id AS done FROM t_runs WHERE job = 'transform') t ON t.done = i.run_id
          WHERE i.job = 'ingest' AND i.status = 'succeeded' AND t.done IS NULL""")
def pending_runs(g: Given) -> DataFrame:
    return ledger.pending_runs(g.runs).select("run_id", "started_at")


@query("""SELECT i.run_id, i.started_at FROM t_runs i
          JOIN (SELECT DISTINCT parent_run_id AS done FROM t_runs
                WHERE job = 'transform' AND status = 'succeeded') t ON t.done = i.run_id
          LEFT JOIN (SELECT DISTINCT run_id AS checked FROM t_dq) d ON d.checked = i.run_id
          WHERE i.job = 'ingest' AND i.status = 'succeeded' AND d.checked IS NULL""")
def eligible_dq_runs(g: Given) -> DataFrame:
    return ledger.eligible_check_runs(g.runs, g.check_results).select("run_id", "started_at")


@query("""SELECT run_id, job, CASE WHEN digit <> 0 THEN status ELSE 'started' END AS status, started_at,
                 CASE WHEN digit <> 0 THEN started_at + INTERVAL 1 HOUR END AS ended_at, parent_run_id
          FROM t_runs""")
def ledger_state(g: Given) -> DataFrame:
    state = ledger.ledger_state(g.run_events)
    job = F.when(F.col("job_name").startswith("ingest"), "ingest").otherwise("transform")
    return state.select("run_id", job.alias("job"), "status", "started_at", "ended_at", "parent_run_id")


@query("""SELECT ingest_run_id AS run_id, min(observed_at) AS watermark_from, max(observed_at) AS watermark_to,
                 count(*) AS n_rows FROM t_fact GROUP BY ingest_run_id""")
def run_watermarks(g: Given) -> DataFrame:
    return ledger.run_watermarks(g.fact)


# --- detectors -----------------------------------------------------------------


@query(f"""SELECT station_id, last_observed_at, {minutes_2(NOW, 'last_observed_at')} AS minutes_silent FROM t_silent""")
def detect_silent_station(g: Given) -> DataFrame:
    return detectors.silent_findings(g.fact, g.station_core, g.as_of, DETECTION.silent_after)


@query(f"""SELECT station_id, metric_id, last_observed_at, {minutes_2(NOW, 'last_observed_at')} AS minutes_stale
           FROM t_stale""")
def detect_stale_data(g: Given) -> DataFrame:
    found = detectors.stale_findings(g.fact, g.station_core, g.as_of, DETECTION.stale_after)
    return found.drop("stale_threshold_minutes")


JUMP_SQL = """SELECT station_id, metric_id, metric_code, last_observed_at, prev_observed_at,
                     CAST(last_value AS DOUBLE) AS last_value, CAST(prev_value AS DOUBLE) AS prev_value,
                     CAST(last_value - prev_value AS DOUBLE) AS delta, CAST(50 AS DOUBLE) AS threshold
              FROM t_pairs WHERE {} > 50"""


def _jumps(g: Given, rising: bool) -> DataFrame:
    found = detectors.jump_findings(
        series_heads(g.fact), g.station_core, g.metric, JUMPS, rising, DETECTION.jump_lookback
    )
    return found.drop("lookback_minutes")


@query(JUMP_SQL.format("last_value - prev_value"))
def detect_spike(g: Given) -> DataFrame:
    return _jumps(g, rising=True)


@query(JUMP_SQL.format("prev_value - last_value"))
def detect_drop(g: Given) -> DataFrame:
    return _jumps(g, rising=False)


@query("""SELECT station_id, metric_id, metric_code, points, window_start_at, window_end_at,
                 CAST(min_value AS DOUBLE) AS min_value, CAST(max_value AS DOUBLE) AS max_value,
                 CAST(max_value - min_value AS DOUBLE) AS range, CAST(100 AS DOUBLE) AS epsilon FROM t_flat""")
def detect_flatline(g: Given) -> DataFrame:
    found = detectors.flatline_findings(
        g.fact, g.station_core, g.metric, EPSILONS, g.as_of, DETECTION.flatline_window, DETECTION.flatline_points
    )
    return found.drop("window_minutes", "min_points")


def _all_found(g: Given) -> DataFrame:
    observed = detectors.Observed(g.stored_fact, g.station_core, g.metric)
    return incidents.stamp_anomalies(detectors.detect_all(observed, DETECTION, g.as_of), g.as_of)


@query("SELECT anomaly_type, station_id, metric_id_dedup, severity FROM t_detected")
def all_anomalies(g: Given) -> DataFrame:
    return _all_found(g).select("anomaly_type", "station_id", "metric_id_dedup", "severity")


@query("""SELECT d.anomaly_type AS detector, count(*) AS rows_detected,
                 count(*) FILTER (a.anomaly_type IS NULL) AS rows_inserted,
                 count(*) FILTER (a.anomaly_type IS NULL) AS rows_linked
          FROM t_detected d
          LEFT JOIN (SELECT DISTINCT anomaly_type, station_id, metric_id_dedup FROM t_anomaly
                     WHERE detected_hour = date_trunc('hour', (SELECT now FROM t_now))) a
            USING (anomaly_type, station_id, metric_id_dedup)
          GROUP BY d.anomaly_type""")
def detector_run_counts(g: Given) -> DataFrame:
    """Counters of a run whose new anomalies are all linked.

    As in the job, the detected rows are written once and then used three times.
    """
    found = staged(_all_found(g), "detected")
    hour = F.date_trunc("hour", g.as_of)
    fresh = incidents.new_anomalies(g.anomaly.where(F.col("detected_hour") == hour), found)
    return detectors.detector_counts(found, fresh, fresh)


# --- incidents -----------------------------------------------------------------


def _recent(g: Given) -> DataFrame:
    return g.anomaly


def _resolved(g: Given) -> DataFrame:
    return incidents.resolve_incidents(g.incident, _recent(g))


@query("""SELECT anomaly_type, station_id, coalesce(metric_id, -1) AS metric_id_dedup, incident_id, is_new, severity,
                 anomaly_type || ' @ station ' || station_id || ' metric ' ||
                     coalesce(CAST(metric_id AS VARCHAR), 'None') AS title
          FROM t_resolved""")
def incident_get_or_create(g: Given) -> DataFrame:
    return _resolved(g).select(
        "anomaly_type", "station_id", F.coalesce("metric_id", F.lit(-1)).alias("metric_id_dedup"),
        "incident_id", "is_new", "severity", "title",
    )


@query("""SELECT incident_id, status,
                 CASE WHEN incident_id IN (SELECT incident_id FROM t_resolved)
                      THEN (SELECT now FROM t_now) ELSE last_seen_at END AS last_seen_at
          FROM t_incident""")
def incident_touch(g: Given) -> DataFrame:
    return incidents.touch_incidents(g.incident, _resolved(g), g.as_of).select("incident_id", "status", "last_seen_at")


@query("""SELECT r.incident_id, CAST(a.anomaly_id AS VARCHAR) AS anomaly_id
          FROM t_recent a JOIN t_resolved r ON r.anomaly_type = a.anomaly_type AND r.station_id = a.station_id
                                           AND r.metric_id IS NOT DISTINCT FROM a.metric_id
          WHERE a.anomaly_id % 3 <> 0""")
def incident_links(g: Given) -> DataFrame:
    """Links to add where every third anomaly is linked already."""
    anomalies, resolved = _recent(g), _resolved(g)
    none = constant_frame(g.spark, [], "incident_id string, anomaly_id string")
    third = anomalies.where("anomaly_id % 3 = 0")
    stored = incidents.link_incidents(none, resolved, third, g.as_of)
    return incidents.link_incidents(stored, resolved, anomalies, g.as_of).select("incident_id", "anomaly_id")


# --- data quality --------------------------------------------------------------


@query(f"""SELECT {minutes_2(NOW, 'min(last)')} AS metric_value
           FROM (SELECT max(observed_at) AS last FROM t_fact GROUP BY station_id, metric_id)""")
def dq_freshness(g: Given) -> DataFrame:
    return quality.freshness_minutes(g.fact, g.as_of)


@query(f"""SELECT {percent('sum(n)', 'count(*) * (SELECT count(*) FROM t_metric WHERE is_active)')} AS metric_value
           FROM (SELECT count(DISTINCT metric_id) FILTER (is_active) AS n
                 FROM t_fact f JOIN t_metric m USING (metric_id)
                 JOIN (SELECT station_id, max(observed_at) AS observed_at FROM t_fact GROUP BY station_id) l
                   USING (station_id, observed_at)
                 GROUP BY station_id)""")
def dq_completeness(g: Given) -> DataFrame:
    return quality.completeness_pct(g.fact, g.metric)


@query(f"""SELECT ingest_run_id AS run_id, {percent('count(*) FILTER (is_late)', 'count(*)')} AS metric_value
           FROM t_fact GROUP BY ingest_run_id
           UNION ALL SELECT 'all', {percent('count(*) FILTER (is_late)', 'count(*)')} FROM t_fact""")
def late_rate(g: Given) -> DataFrame:
    overall = quality.late_rate_pct(g.fact).select(F.lit("all").alias("run_id"), "metric_value")
    return quality.late_rate_by_run(g.fact).unionByName(overall)


@query("""SELECT count(*) AS metric_value FROM (
            SELECT 1 FROM t_raw GROUP BY source, station_external_id, observed_at, metric_code HAVING count(*) > 1)""")
def dq_raw_dups(g: Given) -> DataFrame:
    return quality.duplicate_keys(g.raw, KEYS["raw_observations"])


@query("""SELECT 'merged' AS facts, count(*) AS metric_value FROM (
            SELECT 1 FROM t_fact GROUP BY station_id, metric_id, observed_at HAVING count(*) > 1)
          UNION ALL SELECT 'unmerged', count(*) FROM (
            SELECT 1 FROM t_fact_rows GROUP BY station_id, metric_id, observed_at HAVING count(*) > 1)""")
def dq_fact_dups(g: Given) -> DataFrame:
    keys = KEYS["fact_observation"]
    merged = quality.duplicate_keys(g.fact, keys).select(F.lit("merged").alias("facts"), "metric_value")
    before = quality.duplicate_keys(g.fact_rows, keys).select(F.lit("unmerged").alias("facts"), "metric_value")
    return merged.unionByName(before)


@query("""SELECT count(*) AS metric_value FROM t_watch s LEFT JOIN (
            SELECT station_id, count(DISTINCT metric_id) AS n FROM t_fact JOIN t_metric USING (metric_id)
            WHERE is_active AND date_trunc('hour', observed_at) =
                  (SELECT date_trunc('hour', max(observed_at)) FROM t_fact) GROUP BY station_id) seen USING (station_id)
          WHERE coalesce(n, 0) < (SELECT count(*) FROM t_metric WHERE is_active)""")
def dq_missing_latest_hour(g: Given) -> DataFrame:
    return quality.stations_missing_metric(g.fact, g.station_core, g.metric)


@query("""SELECT count(*) AS metric_value FROM t_fact JOIN t_metric USING (metric_id)
          WHERE value_num < min_expected OR value_num > max_expected""")
def dq_out_of_range(g: Given) -> DataFrame:
    return quality.out_of_range(g.fact, g.metric)


@query("""SELECT count(*) AS metric_value FROM t_raw WHERE (value_num IS NOT NULL) = (value_text IS NOT NULL)""")
def dq_value_xor(g: Given) -> DataFrame:
    return quality.value_xor_violations(g.raw)


NULL_COLUMNS = ("station_external_id", "metric_code", "value_num", "value_text", "unit")


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(*) AS n_rows,
               {percent(f'(count(*) - count({c}))', 'count(*)')} AS null_pct FROM t_raw""" for c in NULL_COLUMNS))
def dq_null_rates(g: Given) -> DataFrame:
    return quality.null_rates(g.raw, NULL_COLUMNS)


@query("""SELECT metric_code, problem, count(*) AS n_rows FROM (
            SELECT r.metric_code, CASE WHEN m.metric_code IS NULL THEN 'unknown_metric'
                                       WHEN unit <> unit_canonical THEN 'unit_mismatch' END AS problem
            FROM t_raw r LEFT JOIN t_metric m ON m.metric_code = r.metric_code)
          WHERE problem IS NOT NULL GROUP BY ALL""")
def dq_unknown_metric(g: Given) -> DataFrame:
    return quality.contract_violations(g.raw, g.metric)


@query("""SELECT 'station' AS reference, count(DISTINCT station_id) AS n_keys, count(*) AS n_rows FROM t_fact
            WHERE station_id NOT IN (SELECT station_id FROM t_watch)
          UNION ALL SELECT 'metric', count(DISTINCT metric_id), count(*) FROM t_fact
            WHERE metric_id NOT IN (SELECT metric_id FROM t_metric WHERE is_active)
          UNION ALL SELECT 'run', count(DISTINCT ingest_run_id), count(*) FROM t_fact
            WHERE ingest_run_id NOT IN (SELECT run_id FROM t_day_runs WHERE status = 'succeeded')""")
def dq_orphans(g: Given) -> DataFrame:
    """Against dimensions that lack smoke-test stations, inactive metrics and failed runs."""
    return quality.orphans(
        g.stored_fact, detectors.monitored(g.station_core), g.metric.where("is_active"), g.day_runs.where("status = 'succeeded'")
    )


STATUS_SQL = """CASE WHEN coalesce(CASE operator WHEN '<=' THEN metric_value <= threshold
                                     WHEN '>=' THEN metric_value >= threshold
                                     WHEN '=' THEN metric_value = threshold ELSE false END, false) THEN 'pass'
                     WHEN severity = 'critical' THEN 'fail' ELSE 'warn' END"""


@query(f"""SELECT operator, severity, is_null, {STATUS_SQL} AS status, count(*) AS n_results
           FROM (SELECT ['<=', '>=', '=', '<>'][l_partkey % 4 + 1] AS operator,
                        CASE WHEN l_orderkey % 2 = 0 THEN 'critical' ELSE 'warning' END AS severity,
                        l_partkey % 400 = 0 AS is_null,
                        CASE WHEN l_partkey % 400 <> 0 THEN metric_value END AS metric_value,
                        CASE WHEN l_suppkey % 5 = 0 THEN metric_value ELSE 30000 END AS threshold FROM t_dq)
           GROUP BY ALL""")
def dq_status_eval(g: Given) -> DataFrame:
    """Every operator, severity and a missing metric, counted by outcome."""
    part, value = F.col("l_partkey"), F.col("metric_value")
    cases = g.check_results.select(
        F.element_at(F.array(*[F.lit(o) for o in ("<=", ">=", "=", "<>")]), (part % 4 + 1).cast("int")).alias("operator"),
        F.when(F.col("l_orderkey") % 2 == 0, "critical").otherwise("warning").alias("severity"),
        (part % 400 == 0).alias("is_null"),
        F.when(part % 400 != 0, value).alias("metric_value"),
        F.when(F.col("l_suppkey") % 5 == 0, value).otherwise(F.lit(30000)).alias("threshold"),
    )
    status = quality.check_status(F.col("metric_value"), F.col("threshold"), F.col("operator"), F.col("severity"))
    return cases.groupBy("operator", "severity", "is_null", status.alias("status")).agg(
        F.count("*").alias("n_results")
    )


CHECK_VALUES = {
    "fact_freshness_minutes": f"""(SELECT {minutes_2(NOW, 'min(last)')} FROM
        (SELECT max(observed_at) AS last FROM t_fact GROUP BY station_id, metric_id))""",
    "metric_completeness_pct": f"""(SELECT {percent('sum(n)',
        'count(*) * (SELECT count(*) FROM t_metric WHERE is_active)')} FROM (
            SELECT count(DISTINCT metric_id) FILTER (is_active) AS n FROM t_fact f JOIN t_metric m USING (metric_id)
            JOIN (SELECT station_id, max(observed_at) AS observed_at FROM t_fact GROUP BY station_id) l
              USING (station_id, observed_at) GROUP BY station_id))""",
    "late_data_rate_pct": f"""(SELECT {percent('count(*) FILTER (is_late)', 'count(*)')} FROM t_fact f
                               WHERE f.ingest_run_id = r.run_id)""",
    "late_data_rate_pct_all_time": f"(SELECT {percent('count(*) FILTER (is_late)', 'count(*)')} FROM t_fact)",
    "raw_duplicate_key_count": """(SELECT count(*) FROM (SELECT 1 FROM t_raw
        GROUP BY source, station_external_id, observed_at, metric_code HAVING count(*) > 1))""",
    "fact_duplicate_key_count": """(SELECT count(*) FROM (SELECT 1 FROM t_fact
        GROUP BY station_id, metric_id, observed_at HAVING count(*) > 1))""",
    "stations_missing_any_metric_count_latest_hour": """(SELECT count(*) FROM t_watch s LEFT JOIN (
        SELECT station_id, count(DISTINCT metric_id) AS n FROM t_fact JOIN t_metric USING (metric_id)
        WHERE is_active AND date_trunc('hour', observed_at) =
              (SELECT date_trunc('hour', max(observed_at)) FROM t_fact) GROUP BY station_id) seen USING (station_id)
        WHERE coalesce(n, 0) < (SELECT count(*) FROM t_metric WHERE is_active))""",
}


@query("SELECT run_id, check_name, metric_value, threshold, " + STATUS_SQL + " AS status FROM ("
       + " UNION ALL ".join(
           f"""SELECT run_id, '{d.name}' AS check_name, CAST({CHECK_VALUES[d.name]} AS DOUBLE) AS metric_value,
                      CAST({d.threshold} AS DOUBLE) AS threshold, '{d.operator}' AS operator, '{d.severity}' AS severity
               FROM t_day_runs r WHERE status = 'succeeded'""" for d in CHECKS if d.is_active) + ")")
def dq_run_all(g: Given) -> DataFrame:
    runs = g.day_runs.where("status = 'succeeded'")
    tables = quality.Checked(g.raw, g.stored_fact, g.station_core, g.metric)
    results = quality.run_checks(runs, CHECKS, tables, g.as_of)
    return results.select("run_id", "check_name", "metric_value", "threshold", "status")


@query("""SELECT CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS day, source, field, drift, count(*) AS n_rows FROM (
            SELECT ingested_at, source, field, CASE WHEN agreed IS NULL THEN 'added' WHEN agreed <> type THEN 'retyped' END AS drift
            FROM seen LEFT JOIN agreed USING (field)
            UNION ALL SELECT ingested_at, source, '<malformed>', 'added' FROM payloads
                      WHERE payload IS NOT NULL AND NOT (json_valid(payload) AND left(payload, 1) = '{')
            UNION ALL SELECT p.ingested_at, p.source, a.field, 'missing' FROM payloads p, agreed a
                      WHERE payload IS NOT NULL AND NOT EXISTS (SELECT 1 FROM seen s WHERE s.id = p.id AND s.field = a.field))
          WHERE drift IS NOT NULL GROUP BY ALL""",
       local="""payloads AS (
            SELECT id, ingested_at, source,
                   CASE WHEN id % 7 = 0 THEN replace(replace(source_payload, ': ', ': "'), '}', '"}') WHEN id % 11 = 0 THEN 'lost ' || id
                        WHEN id % 13 = 0 THEN replace(source_payload, '}', ', "extra": true}') WHEN id % 17 = 0 THEN '[1]'
                        WHEN id % 19 = 0 THEN NULL WHEN id % 23 = 0 THEN '{}' ELSE source_payload END AS payload FROM t_raw),
       objects AS (SELECT *, CAST(payload AS JSON) AS j FROM payloads WHERE json_valid(payload) AND left(payload, 1) = '{'),
       seen AS (SELECT id, ingested_at, source, field, CASE json_type(j, '$.' || field) WHEN 'VARCHAR' THEN 'STRING' WHEN 'BOOLEAN' THEN 'BOOLEAN'
                       ELSE 'BIGINT' END AS type FROM (SELECT *, unnest(json_keys(j)) AS field FROM objects)),
       agreed(field, agreed) AS (VALUES ('k', 'BIGINT'), ('unit', 'STRING'))""")
def schema_drift(g: Given) -> DataFrame:
    """Payloads with a field more, of another type, without any, broken, and none at all; one agreed field never comes."""
    contract = constant_frame(g.spark, [("k", "BIGINT"), ("unit", "STRING")], "field string, type string")
    key, text = F.col("id"), F.col("source_payload")
    quoted = F.replace(F.replace(text, F.lit(": "), F.lit(': "')), F.lit("}"), F.lit('"}'))
    payload = (
        F.when(key % 7 == 0, quoted).when(key % 11 == 0, F.concat(F.lit("lost "), key))
        .when(key % 13 == 0, F.replace(text, F.lit("}"), F.lit(', "extra": true}'))).when(key % 17 == 0, "[1]")
        .when(key % 19 == 0, None).when(key % 23 == 0, "{}").otherwise(text)
    )
    drift = quality.schema_drift(g.raw.withColumn("source_payload", payload), contract)
    return drift.withColumn("day", F.col("day").cast("string"))


# --- views ---------------------------------------------------------------------

FRESH_SQL = f"""last_observed_at, {floor_seconds(NOW, 'last_observed_at')} AS staleness_seconds,
                CASE WHEN last_observed_at IS NULL THEN 'MISSING'
                     WHEN {NOW} - last_observed_at > INTERVAL 2 HOUR THEN 'STALE' ELSE 'FRESH' END AS freshness"""


@query(f"""SELECT station_id, station_name, {FRESH_SQL} FROM (
             SELECT s.station_id, s.station_name, max(observed_at) AS last_observed_at
             FROM t_watch s LEFT JOIN t_fact f ON f.station_id = s.station_id GROUP BY ALL)""")
def station_freshness(g: Given) -> DataFrame:
    return views.station_freshness(g.fact, g.station_core, g.as_of).drop("staleness", "last_seen")


@query(f"""SELECT station_id, coalesce(metric_id, -1) AS metric_id_dedup, station_name, {FRESH_SQL} FROM (
             SELECT s.station_id, f.metric_id, s.station_name, max(observed_at) AS last_observed_at
             FROM t_watch s LEFT JOIN t_fact f ON f.station_id = s.station_id GROUP BY ALL)""")
def station_metric_freshness(g: Given) -> DataFrame:
    fresh = views.station_metric_freshness(g.fact, g.station_core, g.as_of)
    return fresh.withColumn("metric_id_dedup", F.coalesce("metric_id", F.lit(-1))).drop(
        "metric_id", "staleness", "last_seen"
    )


@query(f"""SELECT station_id, station_name AS name,
                  CASE WHEN last IS NULL THEN 'UNKNOWN' WHEN {NOW} - last <= INTERVAL 1 HOUR THEN 'OK'
                       WHEN {NOW} - last <= INTERVAL 6 HOUR THEN 'WARN' ELSE 'STALE' END AS freshness,
                  coalesce(strftime(last, '%H:%M'), '—') AS last_seen
           FROM (SELECT s.station_id, s.station_name, max(observed_at) AS last
                 FROM t_watch s LEFT JOIN t_fact f ON f.station_id = s.station_id GROUP BY ALL)""")
def station_health(g: Given) -> DataFrame:
    return views.station_health(views.station_freshness(g.fact, g.station_core, g.as_of))


@query(f"""SELECT max({floor_seconds(NOW, 'last')}) AS worst_staleness_seconds, count(*) FILTER (last IS NULL) AS n_missing,
                  count(*) FILTER ({NOW} - last > INTERVAL 2 HOUR) AS n_stale
           FROM (SELECT s.station_id, max(observed_at) AS last
                 FROM t_watch s LEFT JOIN t_fact f ON f.station_id = s.station_id GROUP BY ALL)""")
def worst_station_freshness(g: Given) -> DataFrame:
    return views.worst_station_freshness(views.station_freshness(g.fact, g.station_core, g.as_of))


STATUS_NOW = """greatest((SELECT max(ts) FROM events), (SELECT max(created_at) FROM t_incident),
                         (SELECT max(evaluated_at) FROM t_dq), (SELECT max(started_at) FROM t_runs))"""


PLATFORM_SQL = f"""SELECT CASE WHEN open_incidents > 0 THEN 'RED'
                       WHEN worst_freshness_minutes > 120 OR bad_checks > 0 THEN 'AMBER' ELSE 'GREEN' END AS status, *
           FROM (SELECT greatest(0, {floor_minutes('now', '(SELECT max(observed_at) FROM t_fact)')})
                            AS worst_freshness_minutes,
                        (SELECT CAST(count(*) AS INTEGER) FROM t_dq WHERE status IN ('warn', 'fail')
                            AND evaluated_at >= now - INTERVAL 24 HOUR) AS bad_checks,
                        (SELECT CAST(count(*) AS INTEGER) FROM t_incident WHERE status <> 'resolved') AS open_incidents,
                        (SELECT max(started_at) FROM t_runs WHERE job = 'ingest' AND status = 'succeeded') AS last_ingest,
                        now AS evaluated_at
                 FROM (SELECT {STATUS_NOW} AS now))"""


@query(PLATFORM_SQL)
def platform_status(g: Given) -> DataFrame:
    return views.platform_status(g.fact, g.incident, g.check_results, g.runs, _latest_of_all(g))


def _latest_of_all(g: Given):
    return F.greatest(
        g.as_of,
        g.incident.agg(F.max("created_at")).scalar(),
        g.check_results.agg(F.max("evaluated_at")).scalar(),
        g.runs.agg(F.max("started_at")).scalar(),
    )


HEALTH_SQL = """SELECT CASE job WHEN 'ingest' THEN 'ingest_openmeteo_all_stations' ELSE 'transform_raw_to_fact' END
                           AS job_name, started_at AS last_run_at, status AS last_status
                FROM t_runs QUALIFY row_number() OVER (PARTITION BY job
                                        ORDER BY started_at DESC NULLS FIRST, run_id DESC) = 1"""


@query(HEALTH_SQL)
def job_health(g: Given) -> DataFrame:
    return views.pipeline_health(g.runs)


DQ_SUMMARY_SQL = """SELECT check_name, CASE WHEN status = 'pass' THEN 'succeeded' ELSE 'failed' END AS status,
                           evaluated_at AS last_run_at
                    FROM t_dq QUALIFY row_number() OVER (PARTITION BY check_name
                        ORDER BY evaluated_at DESC NULLS FIRST, l_orderkey DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC, status DESC) = 1"""


@query(DQ_SUMMARY_SQL)
def dq_summary(g: Given) -> DataFrame:
    return views.dq_summary(g.check_results, ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "status"))


@query(f"""SELECT check_name, count(*) FILTER (status = 'pass') AS n_pass, count(*) AS n_results,
                  {percent("count(*) FILTER (status = 'pass')", 'count(*)')} AS pass_pct
           FROM t_dq WHERE evaluated_at >= (SELECT max(evaluated_at) FROM t_dq) - INTERVAL 24 HOUR GROUP BY check_name""")
def dq_pass_rate_24h(g: Given) -> DataFrame:
    return views.dq_pass_rate(g.check_results, g.check_results.agg(F.max("evaluated_at")).scalar())


@query(f"""SELECT anomaly_type, severity, count(*) AS n_anomalies FROM t_anomaly
           WHERE detected_at >= {NOW} - INTERVAL 24 HOUR GROUP BY ALL""")
def anomaly_severity(g: Given) -> DataFrame:
    return views.anomaly_severity(g.anomaly, g.as_of)


@query(f"""SELECT t.anomaly_type, count(a.anomaly_id) AS anomalies_24h
           FROM t_types t LEFT JOIN t_anomaly a ON a.anomaly_type = t.anomaly_type
                                               AND a.detected_at >= {NOW} - INTERVAL 24 HOUR
           GROUP BY t.anomaly_type""")
def anomaly_summary(g: Given) -> DataFrame:
    return views.anomaly_summary(g.anomaly, g.anomaly_types, g.as_of)


INCIDENT_NOW = "(SELECT max(created_at) FROM t_incident)"


@query(f"""SELECT count(*) FILTER (status = 'open') AS open_count,
                  count(*) FILTER (status = 'acknowledged') AS acknowledged_count,
                  count(*) FILTER (status = 'resolved') AS resolved_count_total,
                  count(*) FILTER (status = 'resolved' AND opened_at >= {INCIDENT_NOW} - INTERVAL 24 HOUR)
                      AS resolved_count_24h,
                  {floor_minutes(INCIDENT_NOW, 'min(opened_at)')} AS oldest_active_minutes,
                  count(*) FILTER (status = 'resolved' AND resolved_at >= {INCIDENT_NOW} - INTERVAL 24 HOUR)
                      AS resolved_in_24h,
                  {floor_minutes(INCIDENT_NOW, "(min(opened_at) FILTER (status <> 'resolved'))")}
                      AS oldest_unresolved_minutes
           FROM t_incident""")
def incident_kpis(g: Given) -> DataFrame:
    return views.incident_kpis(g.incident, g.incident.agg(F.max("created_at")).scalar())


LIFECYCLE_SQL = """CASE WHEN resolved_at IS NOT NULL THEN 'resolved'
                        WHEN acknowledged_at IS NOT NULL THEN 'acknowledged' ELSE 'open' END"""
TITLE_SQL = """CASE anomaly_type WHEN 'silent_station' THEN 'Silent Station' WHEN 'stale_data' THEN 'Stale Data'
                                 WHEN 'spike' THEN 'Spike' WHEN 'drop' THEN 'Drop' ELSE 'Flatline' END
               || ' incident #' || incident_id"""


@query(f"""SELECT {LIFECYCLE_SQL} AS status, coalesce(opened_at, created_at) AS opened_at,
                  coalesce(severity, 'unknown') AS severity, {TITLE_SQL} AS title, station_id, metric_id
           FROM t_incident""")
def incident_summary(g: Given) -> DataFrame:
    return views.incident_summary(g.incident)


@query(f"""SELECT {LIFECYCLE_SQL} AS status, strftime(coalesce(opened_at, created_at), '%Y-%m-%d %H:%M') AS opened_at,
                  coalesce(severity, 'unknown') AS severity, {TITLE_SQL} AS title, station_id, metric_id
           FROM t_incident ORDER BY coalesce(t_incident.opened_at, created_at) DESC NULLS LAST, incident_id DESC LIMIT 50""")
def recent_incidents(g: Given) -> DataFrame:
    return views.recent_incidents(g.incident)


@query(f"""SELECT status, {LIFECYCLE_SQL} AS lifecycle_status, count(*) AS n_incidents FROM t_incident
           WHERE status <> {LIFECYCLE_SQL} GROUP BY ALL""")
def status_conflicts(g: Given) -> DataFrame:
    return views.status_conflicts(g.incident)


@query(f"""SELECT 'pipeline' AS section, job_name AS item, last_status AS status,
                  strftime(last_run_at, '%Y-%m-%d %H:%M') AS value FROM ({HEALTH_SQL})
           UNION ALL SELECT 'dq', check_name, status, coalesce(strftime(last_run_at, '%Y-%m-%d %H:%M'), '—')
                     FROM ({DQ_SUMMARY_SQL})
           UNION ALL SELECT 'anomalies', t.anomaly_type, '24h', CAST(count(a.anomaly_id) AS VARCHAR)
                     FROM t_types t LEFT JOIN t_anomaly a ON a.anomaly_type = t.anomaly_type
                          AND a.detected_at >= {STATUS_NOW} - INTERVAL 24 HOUR GROUP BY t.anomaly_type
           UNION ALL SELECT 'incidents', status, 'total', CAST(count(*) AS VARCHAR) FROM t_incident GROUP BY status
           UNION ALL SELECT 'status', 'platform', status, strftime(last_ingest, '%H:%M') FROM ({PLATFORM_SQL})""")
def control_tower(g: Given) -> DataFrame:
    """The five reads of the page as one list of text values."""
    tables = {
        "fact_observation": g.fact, "dim_station": g.station_core, "ops_incident": g.incident,
        "ops_dq_check_run": g.check_results.withColumn(
            "dq_run_id", F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "status")
        ),
        "ops_job_run": g.runs, "ops_anomaly": g.anomaly, "ops_anomaly_type": g.anomaly_types,
    }
    page = views.control_tower(tables, _latest_of_all(g))

    def rows(section: str, item, status, value) -> DataFrame:
        return page[section].select(
            F.lit(section).alias("section"), item.alias("item"), status.alias("status"),
            value.cast("string").alias("value"),
        )

    totals = {"open": "open_count", "acknowledged": "acknowledged_count", "resolved": "resolved_count_total"}
    kpis = page["incidents"].select(*[F.col(c).cast("string").alias(s) for s, c in totals.items()])
    incident_rows = kpis.unpivot([], list(totals), "item", "value").select(
        F.lit("incidents").alias("section"), "item", F.lit("total").alias("status"), "value"
    )
    return (
        rows("pipeline", F.col("job_name"), F.col("last_status"), F.col("last_run_at"))
        .unionByName(rows("dq", F.col("check_name"), F.col("status"), F.col("last_run_at")))
        .unionByName(rows("anomalies", F.col("anomaly_type"), F.lit("24h"), F.col("anomalies_24h")))
        .unionByName(incident_rows)
        .unionByName(rows("status", F.lit("platform"), F.col("status"), F.col("last_ingest")))
    )


# --- security ------------------------------------------------------------------

SCOPE_SQL = """SELECT u.user_id, s.station_id FROM (VALUES ('ana'), ('bob'), ('anon'), ('opsy')) AS u(user_id), t_station s
               WHERE EXISTS (SELECT 1 FROM t_grants g WHERE g.user_id = u.user_id
                             AND (g.role = 'ops' OR g.station_id = s.station_id OR g.region = s.region))"""
USERS = ("ana", "bob", "anon", "opsy")


def _per_user(build: Callable[[str], DataFrame]) -> DataFrame:
    frames = [build(u).withColumn("user_id", F.lit(u)) for u in USERS]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


@query(f"SELECT user_id, station_id FROM ({SCOPE_SQL})")
def visible_stations(g: Given) -> DataFrame:
    return _per_user(lambda u: security.visible_stations(g.station, g.grants, u).select("station_id"))


@query(f"""SELECT v.user_id, f.station_id, f.metric_id, f.observed_at, CAST(f.value_num AS DOUBLE) AS value_num
           FROM t_fact f JOIN ({SCOPE_SQL}) v USING (station_id)""")
def visible_facts(g: Given) -> DataFrame:
    narrow = g.fact.select("station_id", "metric_id", "observed_at", "value_num")
    return _per_user(lambda u: security.visible_facts(narrow, g.station, g.grants, u))


def _secured_tables(g: Given) -> dict[str, DataFrame]:
    return {
        "dim_station": g.station, "dim_metric": g.metric, "fact_observation": g.fact, "raw_observations": g.raw,
        "authz_user_access": g.grants, "ops_incident": g.incident, "ops_job_run": g.runs,
    }


def _audit_sql(anonymous: str, analyst: str, ops: str) -> str:
    """Every access rule decided from the grants and what each user may see."""
    verdicts = {
        "precond_stations": "(SELECT count(DISTINCT station_id) FROM t_station) >= 2",
        "precond_facts": "EXISTS (SELECT 1 FROM t_fact)",
        "anon_no_facts": f"NOT EXISTS (SELECT 1 FROM t_fact f JOIN scope v USING (station_id) WHERE v.user_id = '{anonymous}')",
        "anon_reads_stations": f"EXISTS (SELECT 1 FROM t_station WHERE is_smoketest) OR EXISTS (SELECT 1 FROM scope WHERE user_id = '{anonymous}')",
        "analyst_no_raw": f"NOT EXISTS (SELECT 1 FROM t_raw, t_grants WHERE user_id = '{analyst}' AND role = 'ops')",
        "analyst_station_scope": f"""(SELECT count(*) FROM granted) > 0
            AND (SELECT count(DISTINCT station_id) FROM scope WHERE user_id = '{analyst}') = (SELECT count(*) FROM granted)
            AND NOT EXISTS (SELECT station_id FROM scope WHERE user_id = '{analyst}' EXCEPT SELECT station_id FROM granted)""",
        "analyst_fact_scope": f"""EXISTS (SELECT 1 FROM t_fact f JOIN scope v USING (station_id) WHERE v.user_id = '{analyst}')
            AND NOT EXISTS (SELECT station_id FROM t_fact JOIN scope USING (station_id) WHERE user_id = '{analyst}'
                            EXCEPT SELECT station_id FROM granted)""",
        "ops_reads_facts": f"EXISTS (SELECT 1 FROM t_fact f JOIN scope v USING (station_id) WHERE v.user_id = '{ops}')",
        "ops_reads_raw": f"EXISTS (SELECT 1 FROM t_raw) AND EXISTS (SELECT 1 FROM t_grants WHERE user_id = '{ops}' AND role = 'ops')",
        "grants_isolated": f"(SELECT count(*) FROM t_grants WHERE user_id = '{ops}') >= 1",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, CASE WHEN {rule} THEN 'PASS' ELSE 'FAIL' END AS result" for name, rule in verdicts.items())


def _granted(analyst: str) -> str:
    return f"scope AS ({SCOPE_SQL}), granted AS (SELECT DISTINCT station_id FROM t_grants WHERE user_id = '{analyst}')"


def _audit(g: Given, anonymous: str, analyst: str, ops: str) -> DataFrame:
    tables = _secured_tables(g) | {"fact_observation": g.stored_fact}
    return security.access_audit(tables, anonymous, analyst, ops, F.col("is_smoketest"))


@query(_audit_sql("anon", "bob", "opsy"), _granted("bob"))
def rls_audit(g: Given) -> DataFrame:
    return _audit(g, "anon", "bob", "opsy")


@query(_audit_sql("ana", "opsy", "bob"), _granted("opsy"))
def rls_audit_failures(g: Given) -> DataFrame:
    """The same rules asked of users that break most of them."""
    return _audit(g, "ana", "opsy", "bob")


@query("""SELECT u.user_id, t.table_name,
                 CASE t.policy
                   WHEN 'self' THEN (SELECT count(*) FROM t_grants g WHERE g.user_id = u.user_id)
                   WHEN 'analyst' THEN CASE WHEN EXISTS (SELECT 1 FROM t_grants g WHERE g.user_id = u.user_id
                                                         AND role IN ('ops', 'analyst')) THEN t.n ELSE 0 END
                   ELSE CASE WHEN EXISTS (SELECT 1 FROM t_grants g WHERE g.user_id = u.user_id AND role = 'ops')
                             THEN t.n ELSE 0 END END AS n_rows
          FROM (VALUES ('ana'), ('bob'), ('anon'), ('opsy')) AS u(user_id),
               (SELECT 'dim_metric' AS table_name, 'analyst' AS policy, (SELECT count(*) FROM t_metric) AS n
                UNION ALL SELECT 'raw_observations', 'ops', (SELECT count(*) FROM t_raw)
                UNION ALL SELECT 'ops_incident', 'ops', (SELECT count(*) FROM t_incident)
                UNION ALL SELECT 'ops_job_run', 'ops', (SELECT count(*) FROM t_runs)
                UNION ALL SELECT 'authz_user_access', 'self', 0) t""")
def secured_counts(g: Given) -> DataFrame:
    """Rows each user reads from role-gated tables."""
    tables = _secured_tables(g)
    gated = ("dim_metric", "raw_observations", "ops_incident", "ops_job_run", "authz_user_access")

    def counts(user: str) -> DataFrame:
        sizes = g.spark.range(1).select(
            *[security.secure(t, tables, user).agg(F.count("*")).scalar().alias(t) for t in gated]
        )
        return sizes.unpivot([], list(gated), "table_name", "n_rows")

    return _per_user(counts)


# --- streaming -----------------------------------------------------------------


def _streamed(g: Given, detect: bool = False) -> tuple[Warehouse, HeadStore]:
    folder = shared_folder(g.spark, "stream")
    warehouse, store = Warehouse(g.spark, f"{folder}/tables"), HeadStore(g.spark, f"{folder}/heads")
    raw = raw_from_events(event_stream(g.spark, g.sf_dir) if detect else ordered_event_stream(g, late=True))
    if detect:
        newest = g.load("events").agg(F.max("ts")).first()[0]
        step = jumps_on_arrival(warehouse, store, g.station_core, g.metric, DETECTION, lambda: newest)
    else:
        step = store.advance
    running = start_transform(
        raw, warehouse, g.station_core, g.metric, f"{folder}/checkpoint", ["id"], and_then=step
    )
    running.awaitTermination()
    return warehouse, store


@query(f"SELECT {FACT_COLUMNS} FROM t_fact")
def stream_transform(g: Given) -> DataFrame:
    """The events in the order in which they were stored, hours late, merged batch by batch; equals the batch transform."""
    warehouse, _ = _streamed(g)
    return warehouse.read("fact_observation")


@query("""SELECT station_id, metric_id, observed_at, CAST(value_num AS DOUBLE) AS value_num FROM t_fact
          QUALIFY row_number() OVER (PARTITION BY station_id, metric_id ORDER BY observed_at DESC) <= 2""")
def stream_heads(g: Given) -> DataFrame:
    """State of the on-arrival detectors after the stream: two rows per series."""
    _, store = _streamed(g)
    return store.latest().select("station_id", "metric_id", "observed_at", "value_num")


@query("""SELECT anomaly_type, station_id, metric_id_dedup, severity FROM t_detected
          WHERE anomaly_type IN ('spike', 'drop')""")
def stream_jumps(g: Given) -> DataFrame:
    """Jumps found while the stream came in."""
    warehouse, _ = _streamed(g, detect=True)
    return warehouse.read("ops_anomaly").select("anomaly_type", "station_id", "metric_id_dedup", "severity")


# Registers the queries over stored tables, which use the helpers above.
from acceptance import stored  # noqa: E402, F401
