"""Landed documents as a stream, stored as raw observations batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidewarden import settings
from tidewarden.plans.jobs import ingest_frame
from tidewarden.sources.warehouse import Warehouse


def start_ingest(
    documents: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    clock: Callable[[], datetime],
    metrics: Sequence[settings.PayloadMetric] = settings.PAYLOAD_METRICS,
    provider: str = settings.PROVIDER,
) -> StreamingQuery:
    """Store everything landed so far and stop.

    Every micro-batch is an ingest run in the ledger. Its id comes from the checkpoint
    and the batch number, so a replayed batch is the same run and its rows, appended
    again, fold into the ones that are there.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        ingest_frame(warehouse, batch, clock(), metrics, provider, run_name=f"{checkpoint}#{epoch}")

    return (
        documents.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
