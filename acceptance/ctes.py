"""The derived tables of ``acceptance/given.py`` in SQL."""

from __future__ import annotations

import re

CTES = {
    "t_station": """
        SELECT c_custkey AS station_id, CAST(c_custkey AS VARCHAR) AS station_external_id, c_name AS station_name,
               n_name AS state, r_name AS region,
               CASE WHEN c_custkey % 29 <> 0 THEN -90 + c_custkey % 180 END AS lat, -180 + c_custkey % 360 AS lon,
               c_custkey % 11 <> 0 AS is_current, c_custkey % 13 = 0 AS is_smoketest
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "t_watch": "SELECT * FROM t_station WHERE is_current AND NOT is_smoketest",
    "t_metric": """
        SELECT * FROM (VALUES (1, 'click', 'USD', 0, 150, true), (2, 'purchase', 'USD', 0, 150, true),
                              (3, 'signup', 'USD', 0, 200, true), (4, 'view', 'USD', 0, 100, false))
        AS m(metric_id, metric_code, unit_canonical, min_expected, max_expected, is_active)""",
    "t_grants": """
        SELECT * FROM (VALUES ('ana', 'analyst', 'ASIA', NULL), ('bob', 'analyst', NULL, 1),
                              ('bob', 'analyst', NULL, 2), ('bob', 'analyst', NULL, 3), ('opsy', 'ops', NULL, NULL))
        AS g(user_id, role, region, station_id)""",
    "t_raw": """
        SELECT event_id AS id, 'events' AS source, CAST(user_id AS VARCHAR) AS station_external_id,
               date_trunc('hour', ts) AS observed_at, event_type AS metric_code,
               CASE WHEN event_id % 50 <> 0 AND event_id % 101 <> 0 THEN CAST(value AS DECIMAL(18,6)) END AS value_num,
               CASE WHEN (event_id % 50 = 0 OR event_id % 97 = 0) AND event_id % 101 <> 0
                    THEN CAST(value AS VARCHAR) END AS value_text,
               CASE WHEN event_id % 10 = 0 THEN 'cents' ELSE 'USD' END AS unit,
               props AS source_payload,
               ts + to_minutes(15 * CAST(json_extract_string(props, '$.k') AS INTEGER)) AS ingested_at,
               'ev-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS ingest_run_id
        FROM events""",
    "t_fact_rows": """
        SELECT s.station_id, m.metric_id, r.observed_at, r.value_num, r.source, r.ingested_at,
               r.ingested_at > r.observed_at + INTERVAL 24 HOUR AS is_late, r.ingest_run_id, r.id, r.unit
        FROM t_raw r JOIN t_station s ON s.station_external_id = r.station_external_id AND s.is_current
                     JOIN t_metric m ON m.metric_code = r.metric_code
        WHERE r.value_num IS NOT NULL""",
    "t_fact": """
        SELECT station_id, metric_id, observed_at, value_num, source, ingested_at, is_late, ingest_run_id
        FROM t_fact_rows
        QUALIFY row_number() OVER (PARTITION BY station_id, metric_id, observed_at
                                   ORDER BY ingested_at DESC, id DESC) = 1""",
    "t_now": "SELECT max(ts) AS now FROM events",
    "t_day_runs": """
        SELECT DISTINCT 'ev-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id,
               CASE WHEN day(ts) % 7 = 0 THEN 'failed' ELSE 'succeeded' END AS status,
               CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS started_at
        FROM events""",
    "t_runs": """
        SELECT 'i-' || o_orderkey AS run_id, 'ingest' AS job,
               CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'succeeded' END AS status,
               o_orderdate AS started_at, NULL AS parent_run_id, o_orderkey % 10 AS digit
        FROM orders
        UNION ALL
        SELECT 't-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' ||
                   CAST(round(l_extendedprice * 100) AS BIGINT), 'transform',
               CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'succeeded' END,
               l_shipdate, 'i-' || l_orderkey, l_orderkey % 10
        FROM lineitem""",
    "t_dq": """
        SELECT 'i-' || l_orderkey AS run_id, 'check_' || (l_suppkey % 8) AS check_name,
               CASE l_returnflag WHEN 'A' THEN 'pass' WHEN 'N' THEN 'warn' ELSE 'fail' END AS status,
               CASE WHEN l_partkey % 400 <> 0 THEN l_shipdate END AS evaluated_at,
               CAST(l_extendedprice AS DECIMAL(18,6)) AS metric_value, l_orderkey, l_partkey, l_suppkey, l_linenumber
        FROM lineitem""",
    "t_anomaly": """
        SELECT event_id AS anomaly_id,
               CASE event_type WHEN 'click' THEN 'spike' WHEN 'view' THEN 'drop' WHEN 'signup' THEN 'flatline'
                               WHEN 'purchase' THEN 'stale_data' WHEN 'error' THEN 'silent_station' END AS anomaly_type,
               ts AS detected_at, user_id AS station_id,
               CASE WHEN event_type <> 'error' THEN event_id % 5 + 1 END AS metric_id,
               coalesce(CASE WHEN event_type <> 'error' THEN event_id % 5 + 1 END, -1) AS metric_id_dedup,
               date_trunc('hour', ts) AS detected_hour,
               CASE WHEN event_type = 'error' THEN 'high' ELSE 'medium' END AS severity
        FROM events""",
    "t_types": """
        SELECT * FROM (VALUES ('silent_station'), ('stale_data'), ('spike'), ('drop'), ('flatline')) AS t(anomaly_type)""",
    "t_incident": """
        SELECT CAST(o_orderkey AS VARCHAR) AS incident_id, o_orderkey,
               CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'resolved' ELSE 'acknowledged' END AS status,
               CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate END AS opened_at, o_orderdate AS created_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 2 DAY END AS resolved_at,
               CASE WHEN o_orderstatus IN ('F', 'P') AND o_orderkey % 3 <> 0
                    THEN o_orderdate + INTERVAL 1 DAY END AS acknowledged_at,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN lower(substr(o_orderpriority, 3)) END AS severity,
               ['silent_station', 'stale_data', 'spike', 'drop', 'flatline'][o_orderkey % 5 + 1] AS anomaly_type,
               o_custkey AS station_id,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 4 + 1 END AS metric_id,
               o_orderdate AS last_seen_at
        FROM orders""",
    # Hourly slots of the documents with their position.
    "t_slots": """
        SELECT user_id, CAST(hour AS DATE) AS day, hour, click, purchase, signup, error,
               row_number() OVER (PARTITION BY user_id, CAST(hour AS DATE) ORDER BY hour) - 1 AS pos,
               count(*) OVER (PARTITION BY user_id, CAST(hour AS DATE)) AS n
        FROM (SELECT user_id, date_trunc('hour', ts) AS hour,
                     max(value) FILTER (event_type = 'click') AS click,
                     max(value) FILTER (event_type = 'purchase') AS purchase,
                     max(value) FILTER (event_type = 'signup') AS signup,
                     max(value) FILTER (event_type = 'error') AS error
              FROM events GROUP BY ALL)""",
    "t_picked": """
        SELECT * FROM (
            SELECT *, coalesce(min(pos) FILTER (hour >= TIMESTAMP '2024-01-30 12:00:00')
                                   OVER (PARTITION BY user_id, day), n - 1) AS hour_index FROM t_slots)
        WHERE pos = hour_index""",
    "t_payload_rows": """
        SELECT CAST(user_id AS VARCHAR) AS station_external_id, user_id, hour AS observed_at, metric_code, value,
               CASE metric_code WHEN 'error' THEN 'code' ELSE 'USD' END AS unit,
               CASE metric_code WHEN 'error' THEN 'text' ELSE 'USD' END AS source_unit
        FROM (SELECT user_id, day, hour, 'click' AS metric_code,
                     CASE WHEN user_id % 7 = 0 AND pos >= 10 THEN NULL ELSE click END AS value FROM t_picked
              UNION ALL SELECT user_id, day, hour, 'purchase', purchase FROM t_picked
              UNION ALL SELECT user_id, day, hour, 'signup', signup FROM t_picked
              UNION ALL SELECT user_id, day, hour, 'error', error FROM t_picked)
        WHERE value IS NOT NULL""",
    "t_pairs": """
        SELECT * FROM (
            SELECT f.station_id, f.metric_id, m.metric_code, observed_at AS last_observed_at, value_num AS last_value,
                   lag(value_num) OVER w AS prev_value, lag(observed_at) OVER w AS prev_observed_at,
                   row_number() OVER (PARTITION BY f.station_id, f.metric_id ORDER BY observed_at DESC) AS rn
            FROM t_fact f JOIN t_metric m ON m.metric_id = f.metric_id
            WINDOW w AS (PARTITION BY f.station_id, f.metric_id ORDER BY observed_at))
        JOIN t_watch USING (station_id)
        WHERE rn = 1 AND prev_value IS NOT NULL AND metric_code IN ('click', 'purchase', 'signup')
          AND prev_observed_at >= last_observed_at - INTERVAL 3 DAY""",
    "t_silent": """
        SELECT s.station_id, max(f.observed_at) AS last_observed_at
        FROM t_watch s LEFT JOIN t_fact f ON f.station_id = s.station_id GROUP BY s.station_id
        HAVING max(f.observed_at) IS NULL
            OR max(f.observed_at) < (SELECT now FROM t_now) - INTERVAL 12 HOUR""",
    "t_stale": """
        SELECT f.station_id, f.metric_id, max(f.observed_at) AS last_observed_at
        FROM t_fact f JOIN t_watch s ON s.station_id = f.station_id GROUP BY ALL
        HAVING max(f.observed_at) < (SELECT now FROM t_now) - INTERVAL 2 DAY""",
    "t_flat": """
        SELECT f.station_id, f.metric_id, m.metric_code, count(*) AS points, min(observed_at) AS window_start_at,
               max(observed_at) AS window_end_at, min(value_num) AS min_value, max(value_num) AS max_value
        FROM t_fact f JOIN t_metric m ON m.metric_id = f.metric_id JOIN t_watch s ON s.station_id = f.station_id
        WHERE observed_at >= (SELECT now FROM t_now) - INTERVAL 15 DAY
          AND metric_code IN ('click', 'purchase', 'signup')
        GROUP BY ALL HAVING count(*) >= 6 AND max(value_num) - min(value_num) <= 100""",
    "t_detected": """
        SELECT 'silent_station' AS anomaly_type, station_id, -1 AS metric_id_dedup, 'high' AS severity FROM t_silent
        UNION ALL SELECT 'stale_data', station_id, metric_id, 'medium' FROM t_stale
        UNION ALL SELECT 'spike', station_id, metric_id, 'medium' FROM t_pairs WHERE last_value - prev_value > 50
        UNION ALL SELECT 'drop', station_id, metric_id, 'medium' FROM t_pairs WHERE prev_value - last_value > 50
        UNION ALL SELECT 'flatline', station_id, metric_id, 'medium' FROM t_flat""",
    "t_recent": "SELECT * FROM t_anomaly",
    "t_live": """
        SELECT * FROM t_incident WHERE status IN ('open', 'acknowledged')
        QUALIFY row_number() OVER (PARTITION BY anomaly_type, station_id, metric_id
                                   ORDER BY created_at DESC, incident_id DESC) = 1""",
    "t_resolved": """
        SELECT a.anomaly_type, a.station_id, a.metric_id, a.severity,
               coalesce(l.incident_id,
                        substr(sha256(length(a.anomaly_type) || ':' || a.anomaly_type ||
                                      length(CAST(a.station_id AS VARCHAR)) || ':' || a.station_id ||
                                      coalesce(length(CAST(a.metric_id AS VARCHAR)) || ':' || a.metric_id, '~') ||
                                      length(CAST(a.anomaly_id AS VARCHAR)) || ':' || a.anomaly_id), 1, 32))
                   AS incident_id,
               l.incident_id IS NULL AS is_new
        FROM (SELECT * FROM t_recent
              QUALIFY row_number() OVER (PARTITION BY anomaly_type, station_id, metric_id
                                         ORDER BY detected_at, anomaly_id) = 1) a
        LEFT JOIN t_live l ON l.anomaly_type = a.anomaly_type AND l.station_id = a.station_id
                          AND l.metric_id IS NOT DISTINCT FROM a.metric_id""",
}


def with_ctes(body: str, local: str = "") -> str:
    """``body`` with the WITH clause it needs, in dependency order.

    ``local`` holds definitions of this query only, ``name AS (...), ...``.
    """
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bt_[a-z_]+\b", text):
            if name in CTES and name not in needed:
                visit(CTES[name])
                needed.append(name)

    visit(local + body)
    definitions = [f"{n} AS ({CTES[n]})" for n in needed] + ([local.strip()] if local else [])
    return f"WITH {', '.join(definitions)} {body.strip()}" if definitions else body.strip()


def minutes_2(later: str, earlier: str) -> str:
    """Minutes between two times, half-up to two places, from whole microseconds."""
    micros = f"(epoch_us({later}) - epoch_us({earlier}))"
    return f"(CAST(sign({micros}) * ((abs({micros}) + 300000) // 600000) AS DOUBLE) / 100.0)"


def floor_minutes(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 60000000.0) AS INTEGER)"


def floor_seconds(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 1000000.0) AS BIGINT)"


def percent(part: str, whole: str) -> str:
    return f"round(100.0 * CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE), 6)"
