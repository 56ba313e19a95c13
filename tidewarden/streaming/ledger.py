"""Ledger rows of a stream, from what Spark observes while a micro-batch runs."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidewarden.operators import ledger
from tidewarden.plans.jobs import run_identity
from tidewarden.sources.warehouse import Warehouse

HANDLED = "handled_rows"


def observed(rows: DataFrame, time: str = "observed_at") -> DataFrame:
    """The stream with the range of ``time`` and the number of rows observed per micro-batch; no extra pass."""
    return rows.observe(
        HANDLED, F.min(time).alias("watermark_from"), F.max(time).alias("watermark_to"), F.count(F.lit(1)).alias("n_rows"))


class LedgerListener(StreamingQueryListener):
    """Writes a finished run per micro-batch of one named stream, with the range of times that it handled.

    A run's id comes from the stream's name and the batch number, so a replayed batch is the same run.
    """

    def __init__(self, warehouse: Warehouse, stream: str, job: str, clock: Callable[[], datetime]):
        self.warehouse, self.stream, self.job, self.clock = warehouse, stream, job, clock
        self.ended = threading.Event()
        self.error: Exception | None = None

    def onQueryStarted(self, event) -> None:
        if event.name == self.stream:
            self.id = event.id

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(HANDLED)
        if event.progress.name != self.stream or not seen or not seen["n_rows"]:
            return
        counts = {"watermark_from": seen["watermark_from"], "watermark_to": seen["watermark_to"], "rows_inserted": seen["n_rows"]}
        run = run_identity(self.job, f"{self.stream}#{event.progress.batchId}")
        try:
            row = ledger.ledger_finish(self.warehouse.spark, run, self.job, "succeeded", self.clock(), counts)
            self.warehouse.append("ops_job_event", row)
        except Exception as failure:  # raised where the stream is awaited: a listener must not stop the bus
            self.error = failure

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id == getattr(self, "id", None):
            self.ended.set()


def awaited_with_ledger(start: Callable[[], StreamingQuery], listener: LedgerListener) -> StreamingQuery:
    """Start a stream, wait for its end and for its last ledger row."""
    streams = listener.warehouse.spark.streams
    streams.addListener(listener)
    try:
        query = start()
        query.awaitTermination()
        listener.ended.wait(timeout=60)
    finally:
        streams.removeListener(listener)
    if listener.error:
        raise listener.error
    return query
