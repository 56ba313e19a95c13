"""Detection on arrival, with the two newest rows of every series as state.

The state is a table, one version per micro-batch, and not per-key operator state: a
series that carries a third of all rows is reduced on the map side like any other,
where keyed state would send all its rows to one task.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewarden.functions.lookup import constant_frame
from tidewarden.operators.detectors import (
    BUILT_IN, DetectorConfig, Detector, Observed, as_anomalies, jump_findings,
)
from tidewarden.operators.incidents import stamp_anomalies
from tidewarden.operators.merge import first_per_key, latest_wins
from tidewarden.operators.series import SERIES
from tidewarden.plans.jobs import store_anomalies
from tidewarden.schemas import DECIMAL, KEYS
from tidewarden.sources.warehouse import FACT_ORDER, Warehouse, staged

HEAD_SCHEMA = (
    f"station_id bigint, metric_id bigint, observed_at timestamp, value_num {DECIMAL}, ingested_at timestamp, "
    "ingest_run_id string, source string"
)


def update_heads(heads: DataFrame, facts: DataFrame) -> DataFrame:
    """Newest two observations of every series after new facts arrived.

    A corrected observation replaces the one it repeats before the two are chosen, by the order
    that the facts are merged by.
    """
    columns = heads.columns
    both = heads.unionByName(facts.select(*columns))
    corrected = latest_wins(both, KEYS["fact_observation"], [c for c in FACT_ORDER if c in columns])
    return first_per_key(corrected, SERIES, [F.desc("observed_at")], n=2).select(*columns)


class HeadStore:
    """The newest version of the heads and the one before it, in two alternating slots.

    A replayed micro-batch reads the version before it, which no later batch has
    replaced yet, and writes the same version again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _slot(self, epoch: int) -> str:
        return f"{self.root}/slot-{epoch % 2}"

    def version(self, epoch: int) -> DataFrame:
        """The heads after a micro-batch; empty before the first."""
        if epoch < 0:
            return constant_frame(self.spark, [], HEAD_SCHEMA)
        stored = self.spark.read.schema(f"{HEAD_SCHEMA}, epoch bigint").parquet(self._slot(epoch))
        return stored.where(F.col("epoch") == epoch).drop("epoch")

    def latest(self) -> DataFrame:
        """The heads after the last micro-batch."""
        both = self.spark.read.schema(f"{HEAD_SCHEMA}, epoch bigint").parquet(f"{self.root}/slot-*")
        return both.where(F.col("epoch") == both.agg(F.max("epoch")).scalar()).drop("epoch")

    def advance(self, facts: DataFrame, epoch: int) -> DataFrame:
        """Fold a micro-batch into the version before it."""
        heads = update_heads(self.version(epoch - 1), facts).withColumn("epoch", F.lit(epoch).cast("bigint"))
        heads.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self._slot(epoch))
        return self.version(epoch)


def jumps_on_arrival(
    warehouse: Warehouse,
    store: HeadStore,
    station: DataFrame,
    metric: DataFrame,
    config: DetectorConfig,
    clock: Callable[[], datetime],
) -> Callable[[DataFrame, int], None]:
    """Micro-batch step: advance the heads, look for jumps in the series that got new
    rows, store new anomalies and their incidents."""

    def step(facts: DataFrame, epoch: int) -> None:
        heads = store.advance(facts, epoch)
        moved = heads.join(facts.select(*SERIES).distinct(), SERIES, "left_semi")
        found = [
            as_anomalies(
                jump_findings(moved, station, metric, limits, rising, config.jump_lookback), name, "medium"
            ).withColumn("detector", F.lit(name))
            for name, limits, rising in (("spike", config.spike, True), ("drop", config.drop, False))
        ]
        as_of = clock()
        stamped = stamp_anomalies(found[0].unionByName(found[1]), as_of)
        store_anomalies(warehouse, staged(stamped, "arrivals"), as_of)

    return step


def quiet_detectors() -> tuple[Detector, ...]:
    """Silent and stale detectors for a periodic run over the heads: the heads hold every
    series' newest time, so they stand in for the facts."""
    return tuple(d for d in BUILT_IN if d.name in ("silent_station", "stale_data"))


def observed_heads(heads: DataFrame, station: DataFrame, metric: DataFrame) -> Observed:
    return Observed(heads, station, metric)
