"""Reshaping of nested forecast payloads into long observation rows.

A document holds ``hourly.time[]`` and one array per metric, aligned by position.
Everything is a per-document expression: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, MapType, StringType, StructField, StructType

from tidewarden.functions.clock import Instant, instant
from tidewarden.functions.text import details_json, first_text
from tidewarden.schemas import DECIMAL
from tidewarden.settings import PAYLOAD_METRICS, PROVIDER, PayloadMetric


def payload_schema(metrics: Sequence[PayloadMetric] = PAYLOAD_METRICS) -> StructType:
    """Schema of one landed document."""
    series = [
        StructField(m.field, ArrayType(DoubleType() if m.kind == "num" else StringType())) for m in metrics
    ]
    return StructType(
        [
            StructField("station_external_id", StringType()),
            StructField("latitude", DoubleType()),
            StructField("longitude", DoubleType()),
            StructField("hourly", StructType([StructField("time", ArrayType(StringType())), *series])),
            StructField("hourly_units", MapType(StringType(), StringType())),
        ]
    )


def utc_time(text: Column) -> Column:
    """ISO time text read as UTC, whatever offset it may carry."""
    local = F.regexp_replace(text, r"(T[0-9:.]+)(Z|[+-][0-9:]+)$", "$1")
    return local.cast("timestamp_ntz").cast("timestamp")


def pick_hour(times: Column, as_of: Instant) -> Column:
    """Zero-based index of the first time not before ``as_of``; the last index if all
    are earlier; null for a missing or empty array."""
    now = instant(as_of)
    first_hit = F.array_position(F.transform(times, lambda t: utc_time(t) >= now), True)
    return (
        F.when(F.coalesce(F.size(times), F.lit(0)) <= 0, F.lit(None))
        .when(first_hit > 0, first_hit - 1)
        .otherwise(F.size(times) - 1)
        .cast("int")
    )


def pick_hours(documents: DataFrame, as_of: Instant) -> DataFrame:
    """Documents with ``hour_index``, the chosen time text and ``observed_at``."""
    picked = documents.withColumn("hour_index", pick_hour(F.col("hourly.time"), as_of))
    picked = picked.withColumn("chosen_time", F.get("hourly.time", "hour_index"))
    return picked.withColumn("observed_at", utc_time(F.col("chosen_time")))


def payload_rows(
    documents: DataFrame,
    as_of: Instant,
    metrics: Sequence[PayloadMetric] = PAYLOAD_METRICS,
    provider: str = PROVIDER,
) -> DataFrame:
    """One row per document and metric with a value at the chosen hour.

    A missing series, an hour beyond the end of a series and a null value give no
    row. ``source_payload`` keeps what the row was made from, nothing more.
    """
    picked = pick_hours(documents, as_of).where(F.col("hour_index").isNotNull())
    entries = F.array(*[_entry(m) for m in metrics])
    kept = F.filter(entries, lambda e: e["number"].isNotNull() | e["text"].isNotNull())
    exploded = picked.select(
        "station_external_id", "observed_at", "latitude", "longitude", "chosen_time", F.inline(kept)
    )
    return exploded.select(
        F.lit(provider).alias("source"),
        "station_external_id",
        "observed_at",
        "metric_code",
        F.col("number").cast(DECIMAL).alias("value_num"),
        F.col("text").alias("value_text"),
        "unit",
        F.lit(None).cast("string").alias("quality_flag"),
        F.when(F.col("text").isNull(), _slice(provider, F.col("number")))
        .otherwise(_slice(provider, F.col("text")))
        .alias("source_payload"),
    )


def _entry(metric: PayloadMetric) -> Column:
    """A metric at the chosen hour, with its value routed by kind."""
    value = F.get(F.col(f"hourly.{metric.field}"), F.col("hour_index"))
    numeric = metric.kind == "num"
    return F.struct(
        F.lit(metric.code).alias("metric_code"),
        F.lit(metric.field).alias("field"),
        F.lit(metric.unit).alias("unit"),
        source_unit(F.col("hourly_units"), metric).alias("source_unit"),
        (value if numeric else F.lit(None)).cast("double").alias("number"),
        (F.lit(None) if numeric else value).cast("string").alias("text"),
    )


def _slice(provider: str, value: Column) -> Column:
    """What a row was made from, as JSON; only built for rows that are kept."""
    return details_json(
        F.lit(provider).alias("provider"),
        F.col("station_external_id"),
        F.col("latitude"),
        F.col("longitude"),
        F.col("chosen_time").alias("observed_at"),
        F.col("field"),
        F.col("metric_code"),
        F.col("source_unit").alias("unit"),
        value.alias("value"),
    )


def source_unit(units: Column, metric: PayloadMetric) -> Column:
    """Unit the source declares for a field, the canonical one if missing or empty."""
    return first_text(F.try_element_at(units, F.lit(metric.field)), F.lit(metric.unit))


def unpivot_metrics(
    df: DataFrame, ids: Sequence[str], metrics: Mapping[str, str], value: str = "value_num"
) -> DataFrame:
    """Wide numeric columns to ``(ids, metric_code, value)``; nulls give no row.

    ``metrics`` maps the source column to its metric code.
    """
    cast = df.select(*ids, *[F.col(c).cast(DECIMAL).alias(code) for c, code in metrics.items()])
    long = cast.unpivot(list(ids), list(metrics.values()), "metric_code", value)
    return long.where(F.col(value).isNotNull())


def parsed_slice(rows: DataFrame) -> DataFrame:
    """The members of ``source_payload`` as columns again."""
    slice_schema = (
        "provider string, station_external_id string, latitude double, longitude double, "
        "observed_at string, field string, metric_code string, unit string, value string"
    )
    return rows.select(F.from_json("source_payload", slice_schema).alias("p")).select("p.*")
