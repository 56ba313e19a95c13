"""Per-series reductions shared by detectors, checks and views.

A series is one ``(station_id, metric_id)`` and may hold a large share of all
rows. Everything here reduces it on the map side: plain maxima, or the group limit
of :func:`~tidewarden.operators.merge.first_per_key`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewarden.operators.merge import first_per_key
from tidewarden.schemas import SCHEMAS

SERIES = ["station_id", "metric_id"]


def since(rows: DataFrame, time: str, moment: Column, day: str) -> DataFrame:
    """Rows from ``moment`` on. If the frame has the table's day partition, days before
    it are not read at all."""
    kept = rows.where(F.col(time) >= moment)
    return kept.where(F.col(day) >= F.to_date(moment)) if day in rows.columns else kept


def newest_observation(fact: DataFrame) -> Column:
    """Time of the newest fact as a scalar; null for an empty table.

    With the day partition at hand only the newest day's times are read.
    """
    if "observed_date" in fact.columns:
        fact = fact.where(F.col("observed_date") == fact.agg(F.max("observed_date")).scalar())
    return fact.agg(F.max("observed_at")).scalar()


def last_seen_by_series(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*SERIES).agg(F.max("observed_at").alias("last_observed_at"))


def last_seen_by_station(fact: DataFrame) -> DataFrame:
    """Rolled up from the series maxima, so that a plan using both shares one exchange."""
    by_series = last_seen_by_series(fact)
    return by_series.groupBy("station_id").agg(F.max("last_observed_at").alias("last_observed_at"))


def series_heads(fact: DataFrame, n: int = 2) -> DataFrame:
    """The newest ``n`` rows of every series."""
    narrow = fact.select(*SERIES, "observed_at", "value_num")
    return first_per_key(narrow, SERIES, [F.desc("observed_at")], n)


def newest_rows(fact: DataFrame, n: int = 2) -> DataFrame:
    """The newest ``n`` rows of every series with all columns of the stored summary.

    ``fact`` has one row per series and time. The summary holds every series' newest time
    and the two rows a jump needs, so it stands in for the facts wherever only these
    are looked at: last-seen times, jumps, freshness, completeness.
    """
    narrow = fact.select(*SCHEMAS["series_head"].fieldNames())
    return first_per_key(narrow, SERIES, [F.desc("observed_at")], n)


def latest_pairs(heads: DataFrame) -> DataFrame:
    """Newest row of every series next to the one before it, given the series heads.

    A jump detector takes the newest row that has a previous *value*. If the second
    newest row is null, that is a row whose own value is null, which never
    alerts; so two rows per series decide, and no window sees a whole series.
    """
    newest_first = Window.partitionBy(*SERIES).orderBy(F.desc("observed_at"))
    paired = heads.select(
        *SERIES,
        F.col("observed_at").alias("last_observed_at"),
        F.col("value_num").alias("last_value"),
        F.lead("observed_at").over(newest_first).alias("prev_observed_at"),
        F.lead("value_num").over(newest_first).alias("prev_value"),
        F.row_number().over(newest_first).alias("_n"),
    )
    pair = paired.where((F.col("_n") == 1) & F.col("prev_value").isNotNull() & F.col("last_value").isNotNull())
    return pair.drop("_n")
