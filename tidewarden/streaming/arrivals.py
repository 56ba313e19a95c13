"""Event-time operators on a stream, with state that the watermark bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewarden.schemas import KEYS


def first_arrivals(rows: DataFrame, keys: Sequence[str], time: str, lateness: str) -> DataFrame:
    """The first row of every key: insert-or-ignore while the rows come in.

    A key is remembered until the watermark passes its time by ``lateness``; copies that come within that span
    are dropped, in the same micro-batch or a later one. Which of several copies in one micro-batch
    is the first is not defined, so only columns that the key determines should be used.
    """
    return rows.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def hourly_anomalies(anomalies: DataFrame, lateness: str) -> DataFrame:
    """Anomalies per type, station, metric and hour: ``detected_hour, n_anomalies, first_at, last_at``.

    An hour is given out once, when the watermark has passed its end; until then late rows count. Each micro-batch is
    summed on the map side, and the state holds one row per open key and hour.
    """
    key = [k for k in KEYS["ops_anomaly"] if k != "detected_hour"]
    return (
        anomalies.withWatermark("detected_at", lateness)
        .groupBy(*key, F.window("detected_at", "1 hour").alias("hour"))
        .agg(F.count("*").alias("n_anomalies"), F.min("detected_at").alias("first_at"), F.max("detected_at").alias("last_at"))
        .select(*key, F.col("hour.start").alias("detected_hour"), "n_anomalies", "first_at", "last_at")
    )
