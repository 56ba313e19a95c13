"""Explicit schemas of the stored tables; nothing is inferred at read time.

Ids that the engine makes itself (anomalies, incidents, check runs) are digests
of the natural key, hence text: a replay produces the same row, and no central
sequence is needed.
"""

from __future__ import annotations

import re

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DecimalType, IntegerType, LongType, StringType, StructType, TimestampType,
)

DECIMAL = "decimal(18,6)"

_DDL = {
    "dim_station": f"""
        station_id bigint, source string, station_external_id string, station_name string,
        state string, region string, lat {DECIMAL}, lon {DECIMAL},
        valid_from timestamp, valid_to timestamp, is_current boolean, is_smoketest boolean""",
    "dim_metric": f"""
        metric_id bigint, metric_code string, unit_canonical string, value_type string,
        min_expected {DECIMAL}, max_expected {DECIMAL}, is_active boolean, aliases array<string>""",
    "ops_job_event": """
        run_id string, job_name string, status string, event_at timestamp,
        watermark_from timestamp, watermark_to timestamp,
        rows_inserted bigint, rows_updated bigint, rows_deduped bigint,
        error_message string, parent_run_id string, recorded_at timestamp, rows_rejected bigint""",
    "ops_job_run": """
        run_id string, job_name string, status string, started_at timestamp, ended_at timestamp,
        watermark_from timestamp, watermark_to timestamp,
        rows_inserted bigint, rows_updated bigint, rows_deduped bigint,
        error_message string, parent_run_id string, rows_rejected bigint""",
    "ops_run_day": "run_id string, observed_date date, n_rows bigint",
    "ops_rejected_document": """
        run_id string, source_file string, record string, parsed string, rejected_at timestamp""",
    "raw_observations": f"""
        source string, station_external_id string, observed_at timestamp, metric_code string,
        value_num {DECIMAL}, value_text string, unit string, quality_flag string,
        source_payload string, ingested_at timestamp, ingest_run_id string""",
    "fact_observation": f"""
        station_id bigint, metric_id bigint, observed_at timestamp, value_num {DECIMAL},
        source string, ingested_at timestamp, is_late boolean, ingest_run_id string""",
    "series_head": f"""
        station_id bigint, metric_id bigint, observed_at timestamp, value_num {DECIMAL},
        source string, ingested_at timestamp, ingest_run_id string""",
    "series_pair": f"""
        station_id bigint, metric_id bigint, last_at bigint, last_value {DECIMAL}, prev_at bigint,
        prev_value {DECIMAL}, version bigint""",
    "series_quiet": "station_id bigint, metric_id bigint, at bigint, quiet boolean, version bigint",
    "station_quiet": "station_id bigint, at bigint, quiet boolean, version bigint",
    "ops_anomaly_type": """
        anomaly_type_id int, anomaly_type string, description string, default_severity string,
        is_enabled boolean, created_at timestamp""",
    "ops_anomaly": """
        anomaly_id string, anomaly_type string, detected_at timestamp, station_id bigint,
        metric_id bigint, severity string, details string, metric_id_dedup bigint,
        detected_hour timestamp""",
    "ops_anomaly_detector_run": """
        run_id string, detector_name string, started_at timestamp, finished_at timestamp,
        duration_ms bigint, rows_detected bigint, rows_inserted bigint, rows_linked bigint,
        status string, error_message string""",
    "ops_dq_check_definition": f"""
        dq_check_id int, check_name string, severity string, threshold_value {DECIMAL},
        threshold_operator string, check_sql_template string, is_active boolean""",
    "ops_dq_check_run": f"""
        dq_run_id string, run_id string, check_name string, status string, evaluated_at timestamp,
        metric_value {DECIMAL}, threshold {DECIMAL}, reason string, dq_check_id int""",
    "ops_dq_check_outcome": """
        check_name string, evaluated_at timestamp, status string, n_runs bigint, n_results bigint,
        duration_ms bigint, error_message string""",
    "ops_incident": """
        incident_id string, status string, opened_at timestamp, resolved_at timestamp,
        anomaly_id string, owner string, notes string, anomaly_type string, station_id bigint,
        metric_id bigint, severity string, created_at timestamp, acknowledged_at timestamp,
        last_seen_at timestamp, title string, details string""",
    "ops_incident_anomaly": "incident_id string, anomaly_id string, linked_at timestamp",
    "authz_user_access": "user_id string, role string, region string, station_id bigint",
}

_TYPES: dict[str, DataType] = {
    "array<string>": ArrayType(StringType()),
    "bigint": LongType(),
    "boolean": BooleanType(),
    "date": DateType(),
    DECIMAL: DecimalType(18, 6),
    "int": IntegerType(),
    "string": StringType(),
    "timestamp": TimestampType(),
}


def struct(ddl: str) -> StructType:
    """``name type, ...`` as a schema; unlike ``fromDDL`` it needs no running session."""
    schema = StructType()
    for column in re.split(r",\s*(?![^(]*\))", ddl.strip()):
        name, kind = column.split()
        schema = schema.add(name, _TYPES[kind])
    return schema


SCHEMAS = {name: struct(ddl) for name, ddl in _DDL.items()}

# Natural keys, used by the merges and the duplicate checks.
KEYS = {
    "raw_observations": ["source", "station_external_id", "observed_at", "metric_code"],
    "fact_observation": ["station_id", "metric_id", "observed_at"],
    "ops_anomaly": ["anomaly_type", "station_id", "metric_id_dedup", "detected_hour"],
    "ops_dq_check_run": ["run_id", "check_name"],
    "ops_incident_anomaly": ["incident_id", "anomaly_id"],
}
