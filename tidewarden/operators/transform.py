"""Raw observations to facts: dimension lookup, late flag, unit conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewarden.functions.clock import hours
from tidewarden.functions.lookup import metric_names
from tidewarden.operators.merge import first_per_key, latest_wins
from tidewarden.schemas import DECIMAL, KEYS
from tidewarden.settings import ALLOWED_LATENESS_HOURS

FACT_KEY = KEYS["fact_observation"]
# Decide between rows of one key that were stored at the same time.
TIES = ("ingest_run_id", "source", "value_num")


def late(ingested_at: Column, observed_at: Column, allowed_hours: int = ALLOWED_LATENESS_HOURS) -> Column:
    """Stored later than allowed; exactly at the limit is still in time."""
    return ingested_at > observed_at + hours(allowed_hours)


def station_lookup(station: DataFrame) -> DataFrame:
    """External id to surrogate key of current stations, one row per external id.

    The constant flag is a grouping column on purpose. Grouped by the id alone, the
    side would enter a shuffled join with the aggregate's partitioning and without an
    exchange of its own, and the runtime split of hot stations needs one on both sides.
    """
    current = station.where("is_current")
    keys = current.groupBy("station_external_id", "is_current").agg(F.min("station_id").alias("station_id"))
    return keys.drop("is_current")


def metric_lookup(metric: DataFrame) -> DataFrame:
    """Metric code to key; further names in an ``aliases`` array count as codes too."""
    return metric.select("metric_id", F.explode(metric_names(metric)).alias("metric_code"))


def ambiguous_stations(station: DataFrame) -> DataFrame:
    """External ids with more than one current station (the lookup takes the smallest key)."""
    current = station.where("is_current").groupBy("station_external_id").agg(F.count("*").alias("n_stations"))
    return current.where("n_stations > 1")


def to_facts(
    raw: DataFrame, station: DataFrame, metric: DataFrame, allowed_hours: int = ALLOWED_LATENESS_HOURS
) -> DataFrame:
    """Numeric raw rows of known current stations and metrics, with keys and ``is_late``.

    Both dimensions are joined without a hint: a small one is broadcast by the size
    threshold, a large one is shuffled and split at runtime if a station is hot.
    """
    numeric = raw.where(F.col("value_num").isNotNull())
    keyed = numeric.join(metric_lookup(metric), "metric_code").join(
        station_lookup(station), "station_external_id"
    )
    return keyed.withColumn("is_late", late(F.col("ingested_at"), F.col("observed_at"), allowed_hours))


def latest_facts(
    raw: DataFrame,
    station: DataFrame,
    metric: DataFrame,
    order: Sequence[str] = ("ingested_at", *TIES),
    allowed_hours: int = ALLOWED_LATENESS_HOURS,
) -> DataFrame:
    """:func:`to_facts` with one row per fact key, the newest by ``order``.

    ``order`` should leave no ties: a task that is computed again must choose the same row.
    """
    newest = latest_wins(to_facts(raw, station, metric, allowed_hours), FACT_KEY, order)
    return newest.select(
        *FACT_KEY, "value_num", "source", "ingested_at", "is_late", "ingest_run_id"
    )


def of_runs(raw: DataFrame, runs: DataFrame, by: str = "ingest_run_id") -> DataFrame:
    """Raw rows of the given runs, with the columns of ``runs`` other than ``run_id``."""
    return raw.join(runs.withColumnRenamed("run_id", by), by)


def normalize_units(
    rows: DataFrame, factors: DataFrame, value: str = "value_num", unit: str = "unit",
    metric: DataFrame | None = None,
) -> DataFrame:
    """Convert ``value`` to the canonical unit: ``value * factor + offset``.

    ``factors`` has ``(unit, unit_canonical, factor, offset)``. A unit without an
    entry is left as it is. With the metric table the target is the canonical unit of
    the row's metric, so a unit may have several targets; without it a unit has one,
    and of several the first by name is taken. No row is doubled.
    """
    converted = (F.col(value) * F.col("factor") + F.coalesce("offset", F.lit(0))).cast(DECIMAL)
    known = factors.select("unit", "unit_canonical", "factor", "offset").withColumnRenamed("unit", unit)
    if metric is None:
        joined = rows.join(first_per_key(known, [unit], [F.asc("unit_canonical")]), unit, "left")
    else:
        target = metric.groupBy("metric_code").agg(F.min("unit_canonical").alias("_target"))
        per_target = first_per_key(known, [unit, "unit_canonical"], [F.asc("factor")])
        at = (F.col("_source") == per_target[unit]) & (F.col("_target") == per_target["unit_canonical"])
        joined = (
            rows.withColumn("_source", F.col(unit)).drop(unit).join(target, "metric_code", "left")
            .join(per_target, at, "left").withColumn(unit, F.col("_source")).drop("_source", "_target")
        )
    return joined.withColumns(
        {
            value: F.when(F.col("factor").isNull(), F.col(value)).otherwise(converted),
            "source_unit": F.col(unit),
            unit: F.coalesce("unit_canonical", unit),
        }
    ).drop("unit_canonical", "factor", "offset")
