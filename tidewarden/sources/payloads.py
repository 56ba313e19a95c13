"""Landing folder of forecast documents, as a batch or as a stream.

A line that does not fit the contract schema does not fail the read: its text is in :data:`CORRUPT`,
and the ingest job sets it aside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewarden.operators.payload import payload_schema
from tidewarden.settings import PAYLOAD_METRICS, PayloadMetric

CORRUPT, SOURCE_FILE = "_corrupt_line", "_source_file"


def landed_schema(metrics: Sequence[PayloadMetric]) -> StructType:
    return StructType([*payload_schema(metrics).fields, StructField(CORRUPT, StringType())])


def read_payloads(
    spark: SparkSession, path: str, metrics: Sequence[PayloadMetric] = PAYLOAD_METRICS
) -> DataFrame:
    """One document per JSON line, read with the contract schema, and the file it came from."""
    lines = spark.read.schema(landed_schema(metrics)).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    return lines.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def stream_payloads(
    spark: SparkSession,
    path: str,
    metrics: Sequence[PayloadMetric] = PAYLOAD_METRICS,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The landing folder as a stream; options as in :func:`read_payloads`."""
    reader = spark.readStream.schema(landed_schema(metrics)).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
