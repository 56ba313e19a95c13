"""Raw observations as a stream, merged into facts batch by batch.

The merge is the batch operator inside ``foreachBatch``; a replayed micro-batch
merges to the same result. No watermark drops late rows: they are stored and flagged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidewarden.operators.transform import TIES, latest_facts
from tidewarden.sources.warehouse import Warehouse, staged


def start_transform(
    raw_stream: DataFrame,
    warehouse: Warehouse,
    station: DataFrame,
    metric: DataFrame,
    checkpoint: str,
    tie_order: Sequence[str] = TIES,
    and_then: Callable[[DataFrame, int], None] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Merge everything available now into the fact table and stop.

    The newest row of a key wins whatever the order of the files. ``and_then`` gets
    the facts of every micro-batch, e.g. to update series heads.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        facts = staged(latest_facts(batch, station, metric, ["ingested_at", *tie_order]), "stream-facts")
        warehouse.merge_facts(facts, newest_wins=True)
        if and_then:
            and_then(facts, epoch)

    writer = raw_stream.writeStream.queryName(name) if name else raw_stream.writeStream
    return (
        writer.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
