"""Registered queries that go through stored tables: the jobs, the kept summaries and the streams.

Each builds its tables in a new shared folder from the given ones, runs the job or the stream, and reads the result.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from acceptance.ctes import floor_seconds, minutes_2, percent
from acceptance.given import (
    CHECKS, DETECTION, DOCUMENT_METRICS, DOCUMENT_TIME, JUMPS, Given, anomalies_from_events, ordered_event_stream,
    raw_from_events,
)
from acceptance.queries import CHECK_VALUES, FACT_COLUMNS, FRESH_SQL, JUMP_SQL, NOW, STATUS_SQL, USERS, query
from tidewarden.functions import access
from tidewarden.functions.lookup import constant_frame
from tidewarden.operators import detectors, ledger, quality
from tidewarden.operators.transform import to_facts
from tidewarden.plans import jobs, views
from tidewarden.schemas import DECIMAL, SCHEMAS
from tidewarden.session import shared_folder
from tidewarden.settings import INGEST_JOB, TRANSFORM_JOB
from tidewarden.sources.warehouse import Warehouse
from tidewarden.streaming import arrivals, state
from tidewarden.streaming import ledger as stream_ledgers
from tidewarden.streaming.transform import start_transform

# --- building the tables -------------------------------------------------------------


def _filled(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the columns of a stored table, those that it lacks as nulls."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[table].fields
    ])


def _now(g: Given) -> datetime:
    """The newest event's time, as the clock of the jobs."""
    naive = g.load("events").agg(F.max("ts").cast("timestamp_ntz")).first()[0]
    return naive.replace(tzinfo=timezone.utc)


def _warehouse(g: Given) -> Warehouse:
    wh = Warehouse(g.spark, shared_folder(g.spark, "warehouse"))
    wh.overwrite("dim_station", _filled(g.station_core, "dim_station"))
    wh.overwrite("dim_metric", _filled(g.metric, "dim_metric"))
    return wh


def _summarised(g: Given) -> Warehouse:
    """Facts that came in two deliveries of mixed times, each merged into the table and the summary."""
    wh = _warehouse(g)
    facts = g.stored_fact
    part = F.pmod(F.xxhash64("ingest_run_id", "station_id"), F.lit(2))
    for k in range(2):
        wh.merge_facts(facts.where(part == k), newest_wins=True)
    return wh


def _with_runs(g: Given) -> Warehouse:
    """Raw rows of one ingest run per day and the ledger that lists the runs."""
    wh = _warehouse(g)
    wh.append("raw_observations", _filled(g.raw, "raw_observations"))
    wh.append("ops_run_day", jobs.run_days(g.raw))
    runs = g.day_runs.select("run_id", "status", F.col("started_at").alias("event_at"))
    opened = ledger.events_for(runs.drop("status"), INGEST_JOB, "started", None)
    closed = ledger.events_for(runs, INGEST_JOB, "succeeded", None)
    wh.append("ops_job_event", opened.unionByName(closed))
    return wh


# --- jobs ------------------------------------------------------------------------------


@query("""SELECT 'events' AS source, station_external_id, observed_at, metric_code,
                 CASE WHEN metric_code <> 'error' THEN value END AS value_num,
                 CASE WHEN metric_code = 'error' THEN CAST(value AS VARCHAR) END AS value_text, unit
          FROM whole
          UNION ALL
          SELECT 'ledger', NULL, NULL, 'rows_inserted', CAST(count(*) AS DOUBLE), 'succeeded', NULL FROM whole
          UNION ALL
          SELECT 'ledger', NULL, NULL, 'rows_rejected', CAST(count(*) AS DOUBLE), CAST(count(*) AS VARCHAR), NULL
          FROM t_picked WHERE user_id % 13 = 5 OR user_id % 13 = 7""",
       local="""whole AS (SELECT p.* FROM t_payload_rows p
                          JOIN (SELECT station_id FROM t_watch WHERE lat IS NOT NULL) w ON w.station_id = p.user_id
                          WHERE user_id % 13 NOT IN (5, 7))""")
def ingest_job(g: Given) -> DataFrame:
    """Documents as JSON files, some lines cut short and some with a text where a number belongs."""
    folder = shared_folder(g.spark, "landing")
    line = F.to_json(F.struct(*g.documents.columns), {"ignoreNullFields": "false"})
    user = F.col("station_external_id").cast("bigint")
    broken = F.when(user % 13 == 5, F.substring(line, F.lit(1), (F.length(line) / 2).cast("int"))).when(
        user % 13 == 7, F.replace(line, F.lit('"latitude":'), F.lit('"latitude":"north",'))).otherwise(line)
    g.documents.select(broken.alias("value")).write.text(folder)
    wh = _warehouse(g)
    run = jobs.ingest(wh, folder, DOCUMENT_TIME, DOCUMENT_METRICS, "events")
    raw = wh.read("raw_observations").select(
        "source", "station_external_id", "observed_at", "metric_code", "value_num", "value_text", "unit")
    set_aside = wh.read("ops_rejected_document").agg(F.count("*").cast("string")).scalar()
    noted = wh.read("ops_job_run").where(F.col("run_id") == run).select(F.inline(F.array(
        F.struct(F.lit("rows_inserted").alias("metric_code"), F.col("rows_inserted").alias("n"), F.col("status").alias("value_text")),
        F.struct(F.lit("rows_rejected").alias("metric_code"), F.col("rows_rejected").alias("n"), set_aside.alias("value_text")))))
    return raw.unionByName(noted.select(
        F.lit("ledger").alias("source"), F.lit(None).cast("string").alias("station_external_id"),
        F.lit(None).cast("timestamp").alias("observed_at"), "metric_code", F.col("n").cast(DECIMAL).alias("value_num"),
        "value_text", F.lit(None).cast("string").alias("unit")))


# Of the raw rows of one key the one stored last counts; its run has to be transformed.
CURRENT_RAW = """
    current AS (SELECT * FROM t_raw QUALIFY row_number() OVER (
        PARTITION BY source, station_external_id, observed_at, metric_code
        ORDER BY ingested_at DESC, ingest_run_id DESC, value_num DESC NULLS LAST, value_text DESC NULLS LAST) = 1)"""


@query(f"""SELECT {FACT_COLUMNS} FROM t_fact_rows WHERE id IN (SELECT id FROM current)
             AND ingest_run_id IN (SELECT run_id FROM t_day_runs WHERE status = 'succeeded')""", local=CURRENT_RAW)
def transform_job(g: Given) -> DataFrame:
    """Pending runs to stored facts, reading the days that the runs noted."""
    wh = _with_runs(g)
    jobs.transform_runs(wh, _now(g))
    return wh.read("fact_observation")


PICKED_JOB_RUNS = ("ev-2024-01-03", "ev-2024-01-04")


@query(f"""SELECT 'fact' AS kind, station_id, metric_id, observed_at, CAST(value_num AS DOUBLE) AS value_num, NULL AS rows_inserted
           FROM t_fact_rows WHERE id IN (SELECT id FROM current) AND ingest_run_id IN {PICKED_JOB_RUNS}
           UNION ALL
           SELECT 'ledger', NULL, NULL, max(observed_at), NULL, count(*) FROM t_fact_rows
           WHERE id IN (SELECT id FROM current) AND ingest_run_id IN {PICKED_JOB_RUNS} GROUP BY ingest_run_id""", local=CURRENT_RAW)
def transform_job_of_runs(g: Given) -> DataFrame:
    """Runs named by hand, with what their ledger rows say."""
    wh = _with_runs(g)
    jobs.transform_runs(wh, _now(g), PICKED_JOB_RUNS)
    children = wh.read("ops_job_run").where(F.col("job_name") == TRANSFORM_JOB)
    return wh.read("fact_observation").select(
        F.lit("fact").alias("kind"), "station_id", "metric_id", "observed_at", "value_num", F.lit(None).cast("bigint").alias("rows_inserted")
    ).unionByName(children.select(
        F.lit("ledger").alias("kind"), F.lit(None).cast("bigint").alias("station_id"), F.lit(None).cast("bigint").alias("metric_id"),
        F.col("watermark_to").alias("observed_at"), F.lit(None).cast(DECIMAL).alias("value_num"), "rows_inserted"))


JOB_CHECKS = [
    *[c for c in CHECKS if c.is_active and c.name != "raw_duplicate_key_count"],
    quality.CheckDefinition(21, "facts_of_run", "critical", 20, ">=", True,
                            "SELECT count(*) AS metric_value FROM fact_observation WHERE ingest_run_id = :run_id AND source <> ':run_id'"),
    quality.CheckDefinition(22, "late_facts_by_run", "warning", 3, "<=", True,
                            "SELECT ingest_run_id AS run_id, count(*) AS metric_value FROM fact_observation WHERE is_late GROUP BY ingest_run_id"),
    quality.CheckDefinition(23, "broken_template", "critical", 0, "=", True,
                            "SELECT no_such_column AS metric_value FROM fact_observation WHERE ingest_run_id = :run_id"),
    quality.CheckDefinition(24, "broken_on_data", "critical", 0, "=", True,
                            "SELECT CAST(source AS INT) AS metric_value FROM fact_observation WHERE ingest_run_id = :run_id LIMIT 1"),
]
JOB_VALUES = CHECK_VALUES | {
    "facts_of_run": "(SELECT count(*) FROM t_fact f WHERE f.ingest_run_id = r.run_id)",
    "late_facts_by_run": "(SELECT nullif(count(*), 0) FROM t_fact f WHERE f.ingest_run_id = r.run_id AND is_late)",
}


@query("SELECT run_id, check_name, metric_value, " + STATUS_SQL + " AS status FROM ("
       + " UNION ALL ".join(
           f"""SELECT run_id, '{d.name}' AS check_name, CAST({JOB_VALUES[d.name]} AS DOUBLE) AS metric_value,
                      CAST({d.threshold} AS DOUBLE) AS threshold, '{d.operator}' AS operator, '{d.severity}' AS severity
               FROM t_day_runs r WHERE status = 'succeeded'""" for d in JOB_CHECKS if d.name in JOB_VALUES) + ")"
       + """ UNION ALL SELECT NULL, check_name, CAST(CASE WHEN outcome = 'succeeded' THEN n ELSE 0 END AS DOUBLE), outcome
             FROM (SELECT count(*) AS n FROM t_day_runs WHERE status = 'succeeded'), (VALUES """
       + ", ".join(f"('{d.name}', '{'failed' if d.name.startswith('broken') else 'succeeded'}')" for d in JOB_CHECKS)
       + ") AS o(check_name, outcome)")
def checks_job(g: Given) -> DataFrame:
    """All checks of all runs where two checks cannot be computed, and what became of each check."""
    wh = _with_runs(g)
    wh.merge_facts(g.stored_fact)
    done = g.day_runs.where("status = 'succeeded'").select(
        F.concat(F.lit("t-"), F.col("run_id")).alias("run_id"), F.col("run_id").alias("parent_run_id"))
    wh.append("ops_job_event", ledger.events_for(done, TRANSFORM_JOB, "succeeded", g.as_of))
    jobs.check_runs(wh, _now(g), JOB_CHECKS)
    outcomes = wh.read("ops_dq_check_outcome").select(
        F.lit(None).cast("string").alias("run_id"), "check_name", F.col("n_results").cast(DECIMAL).alias("metric_value"), "status")
    return wh.read("ops_dq_check_run").select("run_id", "check_name", "metric_value", "status").unionByName(outcomes)


@query("""SELECT run_id, 'rows' AS check_name, CAST(n AS DOUBLE) AS metric_value FROM (
            SELECT r.run_id, (SELECT count(*) FROM t_fact f WHERE f.ingest_run_id = r.run_id) AS n FROM t_day_runs r)
          UNION ALL
          SELECT r.run_id, 'largest', (SELECT CAST(max(value_num) AS DOUBLE) FROM t_fact f
                                       WHERE f.ingest_run_id = r.run_id AND metric_id = 1) FROM t_day_runs r""")
def dq_template_runs(g: Given) -> DataFrame:
    """Templates with a bound parameter, called for every run; one also has the parameter's name in texts and comments."""
    g.stored_fact.createOrReplaceTempView("template_facts")
    templates = [
        quality.CheckDefinition(1, "rows", "critical", 1, ">=", True, """
            SELECT count(*) AS metric_value -- of :run_id
            FROM template_facts AS `:run_id` /* not :run_id */
            WHERE ingest_run_id = :run_id AND source <> ':run_id' AND "it's :run_id" <> source"""),
        quality.CheckDefinition(2, "largest", "critical", 1, ">=", True,
                                "SELECT max(value_num) AS metric_value FROM template_facts WHERE metric_id = 1 AND :run_id = ingest_run_id"),
    ]
    results = quality.template_checks(g.day_runs.select("run_id"), templates, g.as_of)
    return results.select("run_id", "check_name", "metric_value")


DETAILS_SQL = f"""
    SELECT 'silent_station' AS anomaly_type, station_id, -1 AS metric_id_dedup, 'high' AS severity, last_observed_at AS last_at,
           {minutes_2(NOW, 'last_observed_at')} AS found, NULL AS allowed FROM t_silent
    UNION ALL SELECT 'stale_data', station_id, metric_id, 'medium', last_observed_at, {minutes_2(NOW, 'last_observed_at')},
                     CAST({DETECTION.stale_after} AS DOUBLE) FROM t_stale
    UNION ALL SELECT 'spike', station_id, metric_id, 'medium', last_observed_at, CAST(last_value - prev_value AS DOUBLE), 50
              FROM t_pairs WHERE last_value - prev_value > 50
    UNION ALL SELECT 'drop', station_id, metric_id, 'medium', last_observed_at, CAST(last_value - prev_value AS DOUBLE), 50
              FROM t_pairs WHERE prev_value - last_value > 50
    UNION ALL SELECT 'flatline', station_id, metric_id, 'medium', window_end_at, CAST(max_value - min_value AS DOUBLE), 100 FROM t_flat"""


@query(f"""SELECT a.anomaly_type, station_id, metric_id_dedup, severity, last_at, found, allowed, n AS rows_detected, n AS rows_linked, 'open' AS status
           FROM ({DETAILS_SQL}) a JOIN (SELECT anomaly_type, count(*) AS n FROM t_detected GROUP BY anomaly_type) USING (anomaly_type)""")
def detection_job(g: Given) -> DataFrame:
    """Anomalies of the job with the members of their details, their incident's status and their detector's counters."""
    wh = _summarised(g)
    jobs.detect_and_open_incidents(wh, _now(g), DETECTION)
    found = wh.read("ops_anomaly")
    detail = lambda *names: F.coalesce(*[F.get_json_object("details", f"$.{n}") for n in names])
    linked = wh.read("ops_incident_anomaly").select("anomaly_id", "incident_id")
    incidents = wh.read("ops_incident").select("incident_id", "status")
    counts = wh.read("ops_anomaly_detector_run").select(F.col("detector_name").alias("anomaly_type"), "rows_detected", "rows_linked")
    return found.join(linked, "anomaly_id").join(incidents, "incident_id").join(counts, "anomaly_type").select(
        "anomaly_type", "station_id", F.col("metric_id_dedup").cast("int").alias("metric_id_dedup"), "severity",
        detail("last_observed_at", "window_end_at").cast("timestamp").alias("last_at"),
        detail("minutes_silent", "minutes_stale", "delta", "range").cast("double").alias("found"),
        detail("stale_threshold_minutes", "threshold", "epsilon").cast("double").alias("allowed"),
        "rows_detected", "rows_linked", "status")


# --- the kept summary ------------------------------------------------------------------


@query("SELECT anomaly_type, station_id, metric_id_dedup, severity FROM t_detected WHERE anomaly_type <> 'flatline'")
def summary_detectors(g: Given) -> DataFrame:
    """The four detectors that the summary of the series suffices for, without a look at the facts."""
    wh = _summarised(g)
    observed = detectors.Observed(None, g.station_core, g.metric, wh.heads())
    four = [d for d in detectors.BUILT_IN if d.name != "flatline"]
    found = detectors.detect_all(observed, DETECTION, g.as_of, four)
    return found.select("anomaly_type", "station_id", F.coalesce("metric_id", F.lit(-1)).cast("int").alias("metric_id_dedup"), "severity")


@query(f"""SELECT station_id, CAST(NULL AS BIGINT) AS metric_id, station_name, {FRESH_SQL} FROM (
             SELECT s.station_id, s.station_name, max(observed_at) AS last_observed_at
             FROM t_watch s LEFT JOIN t_fact f ON f.station_id = s.station_id GROUP BY ALL)
           UNION ALL
           SELECT station_id, coalesce(metric_id, -1), station_name, {FRESH_SQL} FROM (
             SELECT s.station_id, f.metric_id, s.station_name, max(observed_at) AS last_observed_at
             FROM t_watch s LEFT JOIN t_fact f ON f.station_id = s.station_id GROUP BY ALL)""")
def summary_freshness(g: Given) -> DataFrame:
    """Freshness per station (no metric) and per series from the summary."""
    heads = _summarised(g).heads()
    per_station = views.station_freshness(heads, g.station_core, g.as_of).withColumn("metric_id", F.lit(None).cast("bigint"))
    per_series = views.station_metric_freshness(heads, g.station_core, g.as_of).withColumn(
        "metric_id", F.coalesce("metric_id", F.lit(-1)))
    return per_station.unionByName(per_series).drop("staleness", "last_seen")


@query(f"""SELECT 'fact_freshness_minutes' AS check_name, CAST({CHECK_VALUES['fact_freshness_minutes']} AS DOUBLE) AS metric_value
           UNION ALL SELECT 'metric_completeness_pct', CAST({CHECK_VALUES['metric_completeness_pct']} AS DOUBLE)
           UNION ALL SELECT 'newest', CAST({floor_seconds("(SELECT max(observed_at) FROM t_fact)", "TIMESTAMP '1970-01-01'")} AS DOUBLE)""")
def summary_checks(g: Given) -> DataFrame:
    """Freshness and completeness checks, and the newest time of all, from the summary."""
    heads = _summarised(g).heads()
    newest = heads.agg(F.unix_seconds(F.max("observed_at")).cast("double").alias("metric_value"))
    parts = {
        "fact_freshness_minutes": quality.freshness_minutes(heads, g.as_of),
        "metric_completeness_pct": quality.completeness_pct(heads, g.metric),
        "newest": newest,
    }
    frames = [df.select(F.lit(n).alias("check_name"), F.col("metric_value").cast("double").alias("metric_value")) for n, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


# --- directions ------------------------------------------------------------------------

DIRECTIONS = ("click", "purchase")
# Values as directions: four times the value, so that a series goes round more than once.
TURN = "(180 - (((180 - ({0})) % 360) + 360) % 360)"


def _directions(g: Given) -> DataFrame:
    return g.fact.withColumn("value_num", (F.col("value_num") * 4).cast(DECIMAL))


@query(f"""SELECT station_id, metric_id, metric_code, CAST(last_value AS DOUBLE) AS last_value, CAST(prev_value AS DOUBLE) AS prev_value,
                  CAST(delta AS DOUBLE) AS delta, delta > 0 AS rising
           FROM (SELECT *, CASE WHEN metric_code IN {DIRECTIONS} THEN {TURN.format('last_value - prev_value')}
                                ELSE last_value - prev_value END AS delta
                 FROM (SELECT station_id, metric_id, metric_code, last_value * 4 AS last_value, prev_value * 4 AS prev_value FROM t_pairs))
           WHERE abs(delta) > 50""")
def circular_jumps(g: Given) -> DataFrame:
    """Spikes and drops where two of the three metrics are directions, which turn the short way round."""
    heads = detectors.series_heads(_directions(g))
    found = [
        detectors.jump_findings(heads, g.station_core, g.metric, JUMPS, rising, DETECTION.jump_lookback, DIRECTIONS)
        .withColumn("rising", F.lit(rising)) for rising in (True, False)
    ]
    return found[0].unionByName(found[1]).select("station_id", "metric_id", "metric_code", "last_value", "prev_value", "delta", "rising")


@query(f"""SELECT station_id, metric_id, metric_code, points, CAST(span AS DOUBLE) AS range FROM (
             SELECT station_id, metric_id, metric_code, any_value(n) AS points,
                    CASE WHEN metric_code IN {DIRECTIONS} THEN 360 - greatest(max(gap), 360 - max(angle) + min(angle))
                         ELSE any_value(high) - any_value(low) END AS span
             FROM (SELECT *, angle - lag(angle) OVER (PARTITION BY station_id, metric_id ORDER BY angle) AS gap,
                          count(*) OVER s AS n, max(value_num) OVER s AS high, min(value_num) OVER s AS low
                   FROM (SELECT f.station_id, f.metric_id, m.metric_code, 4 * value_num AS value_num, (4 * value_num) % 360 AS angle
                         FROM t_fact f JOIN t_metric m USING (metric_id) JOIN t_watch USING (station_id)
                         WHERE observed_at >= {NOW} - INTERVAL 15 DAY AND metric_code IN ('click', 'purchase', 'signup'))
                   WINDOW s AS (PARTITION BY station_id, metric_id))
             GROUP BY station_id, metric_id, metric_code)
           WHERE points >= 3 AND span <= 200""")
def circular_flatline(g: Given) -> DataFrame:
    """Flatlines where a direction's range is the smallest arc that holds its values."""
    limits = {code: 200 for code in JUMPS}
    found = detectors.flatline_findings(
        _directions(g), g.station_core, g.metric, limits, g.as_of, DETECTION.flatline_window, 3, DIRECTIONS)
    return found.select("station_id", "metric_id", "metric_code", "points", "range")


# --- access in SQL ---------------------------------------------------------------------


@query("""SELECT u.user_id, s.station_id, EXISTS (SELECT 1 FROM t_grants g WHERE g.user_id = u.user_id AND g.role = 'ops') AS is_ops
          FROM (VALUES ('ana'), ('bob'), ('anon'), ('opsy')) AS u(user_id), t_station s
          WHERE EXISTS (SELECT 1 FROM t_grants g WHERE g.user_id = u.user_id
                        AND (g.role = 'ops' OR g.station_id = s.station_id OR g.region = s.region))""")
def access_functions(g: Given) -> DataFrame:
    """What each user may see, by the session's SQL functions."""
    access.register_access_functions(g.spark, g.grants)
    g.station.createOrReplaceTempView("access_stations")

    def seen(user: str) -> DataFrame:
        access.as_user(g.spark, user)
        return g.spark.sql(f"""SELECT {access.USER} AS user_id, station_id, is_role('ops') AS is_ops
                               FROM access_stations WHERE can_access_station(station_id, region)""")

    return reduce(DataFrame.unionByName, [seen(user) for user in USERS])


# --- streams with state ------------------------------------------------------------------


def _arriving_facts(g: Given) -> DataFrame:
    """The events as a stream of facts in several micro-batches, in the order of their times."""
    events = ordered_event_stream(g)
    return to_facts(raw_from_events(events, keep=("ts",)), g.station_core, g.metric)


@query(f"""SELECT 'spike' AS detector, * FROM ({JUMP_SQL.format('last_value - prev_value')})
           UNION ALL SELECT 'drop', * FROM ({JUMP_SQL.format('prev_value - last_value')})""")
def stream_jump_state(g: Given) -> DataFrame:
    """Spikes and drops by the state of the stream after its last micro-batch."""
    wh, now = _warehouse(g), _now(g)
    running = state.start_jumps(
        _arriving_facts(g), wh, g.station_core, g.metric, DETECTION, lambda: now, shared_folder(g.spark, "checkpoint"))
    running.awaitTermination()
    pairs = state.current_pairs(wh.stored("series_pair"))
    found = [
        detectors.jumps_of_pairs(pairs, g.station_core, g.metric, JUMPS, rising, DETECTION.jump_lookback)
        .drop("lookback_minutes").withColumn("detector", F.lit(name)) for name, rising in (("spike", True), ("drop", False))
    ]
    return found[0].unionByName(found[1])


CLOCK = "(SELECT now FROM clock)"


@query(f"""SELECT 'silent_station' AS detector, station_id, -1 AS metric_id_dedup, last_observed_at,
                  {minutes_2(CLOCK, 'last_observed_at')} AS minutes
           FROM (SELECT s.station_id, max(f.observed_at) AS last_observed_at FROM t_watch s
                 LEFT JOIN t_fact f ON f.station_id = s.station_id GROUP BY s.station_id)
           WHERE last_observed_at IS NULL OR last_observed_at < {CLOCK} - INTERVAL {DETECTION.silent_after} MINUTE
           UNION ALL
           SELECT 'stale_data', station_id, metric_id, last_observed_at, {minutes_2(CLOCK, 'last_observed_at')}
           FROM (SELECT f.station_id, f.metric_id, max(f.observed_at) AS last_observed_at FROM t_fact f
                 JOIN t_watch s ON s.station_id = f.station_id GROUP BY ALL)
           WHERE last_observed_at < {CLOCK} - INTERVAL {DETECTION.stale_after} MINUTE""",
       local="clock AS (SELECT max(ts) AS now FROM events JOIN t_fact_rows ON id = event_id)")
def stream_silence(g: Given) -> DataFrame:
    """Silent stations and stale series as the stream's timers reported them, without a scan of the facts.

    The stream's clock is the newest arrival of a fact.
    """
    arrived = to_facts(raw_from_events(g.load("events"), keep=("ts",)), g.station_core, g.metric)
    clock = arrived.agg(F.max("ts")).scalar()
    wh = _warehouse(g)
    watched = detectors.monitored(g.station_core).select("station_id")
    keyed = (
        ("silent_station", "station_quiet", ["station_id"], DETECTION.silent_after, watched),
        ("stale_data", "series_quiet", ["station_id", "metric_id"], DETECTION.stale_after, None),
    )
    facts = _arriving_facts(g)
    parts = []
    for name, table, keys, after, known in keyed:
        state.start_quiet(facts, wh, table, shared_folder(g.spark, "checkpoint"), keys, after, known, arrival="ts").awaitTermination()
        quiet = state.quiet_findings(wh.stored(table), keys, g.station_core, clock, "minutes")
        metric_id = F.col("metric_id").cast("int") if "metric_id" in keys else F.lit(-1)
        parts.append(quiet.select(
            F.lit(name).alias("detector"), "station_id", metric_id.alias("metric_id_dedup"), "last_observed_at", "minutes"))
    return parts[0].unionByName(parts[1])


# --- event time ----------------------------------------------------------------------------


def _appended(g: Given, rows: DataFrame) -> DataFrame:
    """All that a stream gives out, as a table."""
    folder = shared_folder(g.spark, "stream")
    running = rows.writeStream.format("parquet").option("path", f"{folder}/rows").option(
        "checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    running.awaitTermination()
    return g.spark.read.schema(rows.schema).parquet(f"{folder}/rows")


@query("SELECT DISTINCT anomaly_type, station_id, metric_id_dedup, detected_hour FROM t_anomaly")
def stream_first_arrivals(g: Given) -> DataFrame:
    """Hourly anomaly keys, each stored when it first arrives; events arrive hours late and out of order."""
    key = ["anomaly_type", "station_id", "metric_id_dedup", "detected_hour"]
    offered = anomalies_from_events(ordered_event_stream(g, late=True))
    return _appended(g, arrivals.first_arrivals(offered, key, "detected_at", "48 hours").select(*key))


@query("""SELECT anomaly_type, station_id, metric_id_dedup, detected_hour, count(*) AS n_anomalies,
                 min(detected_at) AS first_at, max(detected_at) AS last_at FROM t_anomaly
          GROUP BY ALL HAVING detected_hour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 48 HOUR""")
def stream_hourly_windows(g: Given) -> DataFrame:
    """Hours that the watermark has closed, with the late rows that came before."""
    return _appended(g, arrivals.hourly_anomalies(anomalies_from_events(ordered_event_stream(g, late=True)), "48 hours"))


@query("""SELECT 'succeeded' AS status, min(date_trunc('hour', ts)) AS watermark_from, max(date_trunc('hour', ts)) AS watermark_to,
                 count(*) AS rows_inserted
          FROM (SELECT ts, (SELECT count(*) FROM range(1, 4) k WHERE epoch_us(ts) >=
                       low + round_even((high - low) * k.range / 4.0, 0)) AS span
                FROM events, (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events))
          GROUP BY span""")
def stream_ledger(g: Given) -> DataFrame:
    """Range of times and number of rows of every micro-batch, as the stream's listener noted them."""
    wh, now, folder = _warehouse(g), _now(g), shared_folder(g.spark, "stream")
    raw = stream_ledgers.observed(raw_from_events(ordered_event_stream(g)))
    listener = stream_ledgers.LedgerListener(wh, folder, TRANSFORM_JOB, lambda: now)
    stream_ledgers.awaited_with_ledger(
        lambda: start_transform(raw, wh, g.station_core, g.metric, f"{folder}/checkpoint", name=folder), listener)
    return wh.read("ops_job_run").select("status", "watermark_from", "watermark_to", "rows_inserted")
