"""Helpers the operators share: shared-folder tables, batches of texts, distributed union-find."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.session import shared_folder

# Fixed by the contracts: a word is a run of anything but a space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, a lost executor costs nothing."""
    return kept_at(df, purpose)[0]


def kept_at(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """As :func:`kept`, with the folder, for a table that is to be dropped."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`kept_at` made, once all that was read from it is written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Stored tables of one computation, each dropped once nothing is left to read from it.

    What is dropped must have been read by finished jobs only; a table that a result still reads stays.
    """

    def __init__(self):
        self.paths: dict[int, tuple[DataFrame, str]] = {}
        self.names: dict[str, str] = {}

    def kept(self, df: DataFrame, purpose: str) -> DataFrame:
        frame, path = kept_at(df, purpose)
        self.paths[id(frame)] = (frame, path)
        return frame

    def bucketed(self, df: DataFrame, purpose: str, key: str) -> DataFrame:
        """As :meth:`kept`, in as many buckets of ``key`` as shuffles have partitions: a join by the key moves the other side only.

        A frame that is grouped or joined by the key comes in buckets already. Buckets are known to Spark through a
        table of the session's catalog, which goes with the folder.
        """
        spark, path, name = df.sparkSession, shared_folder(df.sparkSession, purpose), f"scratch_{uuid.uuid4().hex}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.format("parquet").options(path=path, compression="zstd").bucketBy(buckets, key).saveAsTable(name)
        frame = spark.table(name)
        self.paths[id(frame)] = (frame, path)
        self.names[path] = name
        return frame

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            _, path = self.paths.pop(id(frame))
            if path in self.names:
                frame.sparkSession.sql(f"DROP TABLE IF EXISTS {self.names.pop(path)}")
            dropped(frame.sparkSession, path)
        # Shuffle files of finished jobs go with the driver's garbage, which a driver with little to do collects rarely.
        frames[0].sparkSession._jvm.System.gc()

    def drop_all(self) -> None:
        if self.paths:
            self.drop(*[frame for frame, _ in self.paths.values()])


# Nodes of documents without an id: above all ids, by a hash of the text.
NO_ID = 1 << 62


def node(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A document's node: its id, or for a null id one that its text decides; copies without an id are one node."""
    hashed = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 2)
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID) + hashed)


def known_id(column: str) -> Column:
    """The id of a node; null for a document without one."""
    return F.when(F.col(column) < NO_ID, F.col(column))


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (two multiply-xorshift rounds)."""
    h = h.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(33)
    return h


def byte_table(seed: int) -> np.ndarray:
    """A random 64-bit value per byte, the letters of the polynomial hashes."""
    return mixed(np.arange(256, dtype=np.uint64) + np.uint64(1000 * seed + 1))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


# An odd base and its inverse modulo 2**64: window hashes are differences of one running sum.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


class Rolling:
    """Hashes of all byte windows of one buffer, from one running sum."""

    def __init__(self, data: np.ndarray, letters: np.ndarray):
        values = letters[data]
        values *= powers(BASE, len(data))
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values, out=self.sums[1:])
        self.back = powers(INVERSE, len(data) + 1)

    def windows(self, start: np.ndarray, width) -> np.ndarray:
        """Hash of ``[start, start + width)`` for each start."""
        return mixed((self.sums[start + width] - self.sums[start]) * self.back[start])


def text_batches(batches, column: str, limit: int = 4 << 20):
    """Slices of the incoming Arrow batches that hold about ``limit`` bytes of text each."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        lengths = binary_lengths(batch.column(at))
        group = np.cumsum(lengths) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


def binary_lengths(column) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def joined_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All values of a string or binary column as one byte buffer, and the n + 1 offsets into it."""
    import pyarrow as pa

    column = column.cast(pa.large_binary())
    lengths = binary_lengths(column)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    # A slice keeps its parent's buffer: rebuild it from the values of this slice alone.
    first = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    if column.buffers()[2] is None or offsets[-1] == 0:
        return np.zeros(0, dtype=np.uint8), offsets
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    if first[-1] - first[0] == offsets[-1]:
        return data[first[0]: first[-1]], offsets
    return np.concatenate([data[a: a + n] for a, n in zip(first[:-1], lengths)]), offsets


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each (start, count), concatenated."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(np.asarray(starts) - ends + counts, counts)


# ---------------------------------------------------------------------------
# Distributed union-find
# ---------------------------------------------------------------------------


def _local_forest(frames):
    """Union-find over the links of one partition; keeps one link per node, to the smallest node of its set."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for frame in frames:
        for a, b in zip(frame["a"].tolist(), frame["b"].tolist()):
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = [x for x in list(parent) if find(x) != x]
    for lo in range(0, len(nodes), 100_000):
        part = nodes[lo: lo + 100_000]
        yield pd.DataFrame({"a": [find(x) for x in part], "b": part})


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from every node that has a link.

    ``links``: columns a, b (long), any direction, repeats and self links allowed.
    Returns (id, component) for the nodes that have a link to another node. First a union-find
    inside each partition, which leaves a forest; then star contraction across partitions:
    every node points its neighbours at its smallest neighbour until nothing changes. Each
    round is grouped minima and joins, so a node with a third of all links is combined on the
    map side and split by the skew handling of joins.
    """
    plain = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    edges, path = kept_at(plain.mapInPandas(_local_forest, "a long, b long"), "forest")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        # Larger neighbours of a node point at the node's smallest neighbour ...
        large = edges.join(low, "a").select(F.col("low").alias("a"), "b").distinct()
        # ... then smaller neighbours of a node, and the node, point at the smallest of them.
        least = large.groupBy("b").agg(F.min("a").alias("low"))
        small = large.join(least, "b")
        before = path
        edges, path = kept_at(
            small.select(F.col("low").alias("a"), "b").unionByName(small.select(F.col("low").alias("a"), F.col("a").alias("b")))
            .where("a < b").distinct(), "forest")
        dropped(links.sparkSession, before)
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("id"), F.col("a").alias("component"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or only larger ones."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("low"), F.lit(None).cast("long").alias("a")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("low"), "a"))
    return roles.groupBy("node").agg(F.max("low").alias("low"), F.min("a").alias("x"), F.max("a").alias("y")).where(
        "x < y or (low = 1 and x is not null)").isEmpty()
