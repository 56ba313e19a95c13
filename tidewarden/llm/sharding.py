"""Sharding over fixed virtual slots, DataFrame functions only.

A record's slot is a hash of its id, so it never moves between slots. Bytes are summed per slot and a slot map,
versioned and stored, says which shard a slot belongs to. Rebalancing edits the map and leaves the records alone.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewarden.llm.common import kept
from tidewarden.session import shared_folder

SLOTS = 4096
MAP_SCHEMA = "version long, virtual_slot int, shard int, bytes long, rows long"


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key; a null key has the slot of the empty string."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(slots)).cast("int")


def slot_loads(records: DataFrame) -> DataFrame:
    """Bytes and rows per slot of (virtual_slot, size): at most as many rows as slots."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def first_map(spark: SparkSession, loads: DataFrame, shards: int) -> DataFrame:
    """Version 1: the heaviest slot left goes to the lightest shard. ``loads`` has a row per slot at most."""
    rows = sorted(loads.collect(), key=lambda r: (-r["bytes"], r["virtual_slot"]))
    heap = [(0, s) for s in range(shards)]
    placed = []
    for r in rows:
        load, shard = heapq.heappop(heap)
        placed.append((1, r["virtual_slot"], shard, r["bytes"], r["rows"]))
        heapq.heappush(heap, (load + r["bytes"], shard))
    return spark.createDataFrame(placed, MAP_SCHEMA)


def rebalanced(spark: SparkSession, slot_map: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version of a map for new loads or another number of shards, moving few slots.

    Slots of shards that no longer exist, and slots new to the map, go to the lightest shard. Then the heaviest
    shard gives the lightest one the slot that evens the two best, as long as that helps. A shard is never emptied.
    """
    old = {r["virtual_slot"]: (r["shard"], r["version"]) for r in slot_map.collect()}
    now = {r["virtual_slot"]: (r["bytes"], r["rows"]) for r in loads.collect()}
    version = max((v for _, v in old.values()), default=0) + 1
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    loose = []
    for slot in sorted(old.keys() | now.keys()):
        size = now.get(slot, (0, 0))[0]
        shard = old.get(slot, (-1, 0))[0]
        if 0 <= shard < shards:
            held[shard][slot] = size
        else:
            loose.append((-size, slot))
    total = [sum(x.values()) for x in held]
    for size, slot in sorted(loose):
        to = min(range(shards), key=lambda s: (total[s], s))
        held[to][slot] = -size
        total[to] -= size
    while True:
        high, low = max(range(shards), key=lambda s: (total[s], -s)), min(range(shards), key=lambda s: (total[s], s))
        gap = total[high] - total[low]
        size, slot = min(((abs(gap - 2 * n), s) for s, n in held[high].items() if 0 < n < gap), default=(gap, -1))
        if slot < 0 or size >= gap:
            break
        n = held[high].pop(slot)
        held[low][slot] = n
        total[high] -= n
        total[low] += n
    rows = [(version, slot, s, *now.get(slot, (0, 0))) for s in range(shards) for slot in held[s]]
    return spark.createDataFrame(rows, MAP_SCHEMA)


def store_map(slot_map: DataFrame, path: str) -> None:
    """Append a version; older versions stay readable."""
    slot_map.write.mode("append").parquet(path)


def latest_map(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema(MAP_SCHEMA).parquet(path)
    return stored.join(stored.agg(F.max("version").alias("version")), "version").select(*stored.columns)


def placed(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add ``shard`` and the gapless position ``slot`` in it to (doc_id, size, virtual_slot, ...).

    Rows are numbered inside their virtual slot, which is small however hot a source is, and then moved by the
    rows of the shard's earlier slots. Equal ids are told apart by the other columns; rows equal in all are alike.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select("virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("virtual_slot").orderBy(*records.columns)
    return (
        records.withColumn("place", F.row_number().over(inside) - 1)
        .join(starts, "virtual_slot")
        .withColumn("slot", F.col("first") + F.col("place"))
        .drop("first", "place")
    )


def sharded(documents: DataFrame, shards: int = 40, slots: int = SLOTS) -> DataFrame:
    """Documents over ``shards`` shards of nearly equal bytes.

    Size is the UTF-8 bytes of the text, 0 for a null text, plus 16. A null id is placed as an empty one. Empty
    input gives no rows; repeated rows are all placed. Columns other than doc_id and text are not read.
    """
    spark = documents.sparkSession
    records = documents.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        virtual_slot(F.col("doc_id"), slots).alias("virtual_slot"),
    )
    records = kept(records, "shard-records")
    path = shared_folder(spark, "slot-map")
    store_map(first_map(spark, slot_loads(records), shards), path)
    return placed(records, latest_map(spark, path))


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 0 to 39 by bytes, and its gapless place there."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return sharded(documents).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
