"""Near-duplicate embeddings: a small-world graph per shard, every shard queried, cosines verified, components united."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm.common import components, kept, table
from tidewarden.llm.hnsw import Graph

LEAST = 0.93
# Vectors of one graph: 16k vectors of 64 floats and their links take some 8 MB.
SHARD_ROWS = 16384
CHUNK_ROWS = 2048
BEAM = 32
AUDIT = 64
RECALL = 0.98


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    scale = np.abs(wide).max(axis=1, keepdims=True)
    wide = wide / scale
    return (wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))).astype(np.float32)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _pack(table):
    """One row with all ids and vectors of a group: (label, dim, part, ids, vectors)."""
    import pyarrow as pa

    table = table.sort_by("id")
    vectors = np.asarray(table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return pa.table({
        "label": table["label"][:1], "dim": table["dim"][:1], "part": table["part"][:1],
        "ids": pa.array([table["id"].to_numpy().astype("<i8").tobytes()], pa.binary()),
        "vectors": pa.array([vectors.astype("<f8").tobytes()], pa.binary())})


PACKED = "label string, dim int, part long, ids binary, vectors binary"


def _indexed(batches):
    """Add the graph of each packed shard."""
    import pyarrow as pa

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            dim = row.column("dim")[0].as_py()
            graph = Graph.build(_unit(np.frombuffer(row.column("vectors")[0].as_py(), "<f8").reshape(-1, dim)))
            yield pa.RecordBatch.from_arrays([*row.columns, pa.array([graph.dump()], pa.binary())], names=[*row.schema.names, "graph"])


def _links(least: float, recall: float):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name, i=i, batch=batch: batch.column(batch.schema.get_field_index(name))[i].as_py()
                dim = get("dim")
                q_ids, q = np.frombuffer(get("q_ids"), "<i8"), np.frombuffer(get("q_vectors"), "<f8").reshape(-1, dim)
                ids, vectors = np.frombuffer(get("ids"), "<i8"), np.frombuffer(get("vectors"), "<f8").reshape(-1, dim)
                at = np.minimum(np.searchsorted(ids, q_ids), len(ids) - 1)  # a shard is sorted by id
                own = np.where(ids[at] == q_ids, at, -1)
                rows, nodes, _ = Graph.load(get("graph")).audited(_unit(q), own, least - 1e-5, BEAM, AUDIT, recall)
                apart = q_ids[rows] != ids[nodes]
                rows, nodes = rows[apart], nodes[apart]
                for a in range(0, len(rows), 100_000):
                    r, c = rows[a: a + 100_000], nodes[a: a + 100_000]
                    ok = cosines(q[r], vectors[c]) >= least
                    x, y = q_ids[r[ok]], ids[c[ok]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])
    return run


def similar_vectors(vectors: DataFrame, least: float = LEAST, recall: float = RECALL, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept, n_copies) of (vec_id, embedding, label).

    Vectors link when labels are equal and not null, lengths are equal and the cosine, in double precision, is
    ``least`` or more. Null, empty and zero vectors, and those with null or non-finite components, link with nothing.
    Equal vectors of a label are one node and count each as linked with the others. Ids must be distinct and not null.
    Every vector of a label is searched in the graph of every shard of it; links found are verified, none is assumed,
    and beams widen until the audited queries of each chunk lose at most 2 % of their links to others.
    """
    v = F.col("embedding")
    good = (F.col("label").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    rows = vectors.select(
        "vec_id", F.col("label").cast("string").alias("label"), v.cast("array<double>").alias("embedding"),
        F.coalesce(good, F.lit(False)).alias("good"),
        F.unhex(F.md5(F.array_join(v.cast("array<string>"), ",", "null"))).alias("digest"))
    rows = kept(rows, "vectors")
    classes = rows.where("good").groupBy("label", "digest").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("embedding").alias("embedding"))
    classes = kept(classes.withColumn("dim", F.size("embedding")), "vector-classes")
    sizes = kept(classes.groupBy("label", "dim").agg(F.count("*").alias("held")), "vector-counts")
    placed = classes.select("id", "label", "dim", "embedding").join(sizes, ["label", "dim"])
    part = lambda n: F.pmod(F.xxhash64("id"), F.ceil(F.col("held") / n)).cast("long")
    cols = ("id", "label", "dim", "embedding")
    shards = placed.select(*cols, part(shard_rows).alias("part")).groupBy("label", "dim", "part").applyInArrow(_pack, PACKED)
    shards = kept(shards.mapInArrow(_indexed, PACKED + ", graph binary"), "vector-graphs")
    chunks = placed.select(*cols, part(CHUNK_ROWS).alias("part")).groupBy("label", "dim", "part").applyInArrow(_pack, PACKED)
    chunks = kept(chunks.select("label", "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.col("part").alias("chunk")),
                  "vector-chunks")
    pairs = chunks.join(shards, ["label", "dim"]).select("dim", "q_ids", "q_vectors", "ids", "vectors", "graph", "chunk", "part", "label")
    pairs = pairs.repartition("label", "chunk", "part").drop("label", "chunk", "part")
    links = kept(pairs.mapInArrow(_links(least, recall), "a long, b long").distinct(), "vector-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weight = classes.select(F.col("id").alias("b"), "n")
    degree = both.join(weight, "b").groupBy("a").agg(F.sum("n").alias("others"))
    groups = components(links)
    facts = (
        classes.select("label", "digest", "id", "n")
        .join(degree.withColumnRenamed("a", "id"), "id", "left").join(groups, "id", "left")
        .select("label", "digest", F.col("n").alias("n_copies"), (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
                F.coalesce("component", "id").alias("component"))
    )
    facts = kept(facts, "vector-facts")
    out = rows.select("vec_id", F.when(F.col("good"), F.col("label")).alias("label"), "digest").join(facts, ["label", "digest"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      (component == F.col("vec_id")).alias("kept"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return similar_vectors(table(spark, sf_dir, "embeddings"))
