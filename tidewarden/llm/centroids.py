"""Centroid clustering whose distances are kept up to date instead of computed anew.

Every vector is stored with its exact integer dot products with all centroids. When centroids move, a product
changes by the vector's part in the centroid's nonzero component changes, and the nearest centroid is looked up again.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.functions.lookup import constant_frame
from tidewarden.llm.common import dropped, kept, kept_at, table

# Fixed by the contract.
DIMS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = "2"
# Differences of components are below 2**28, so a squared distance of 64 components fits a long.
LARGEST = 1 << 27
EXACT = float(1 << 53)


def integer_vectors(embeddings: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vec) of the vectors with ``dims`` components, all finite: floor(scale * component).

    Other vectors are left out. A component of 2**27 or more after scaling is an error: distances would not fit.
    """
    finite: Column = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = embeddings.where(F.col("embedding").isNotNull()).where((F.size("embedding") == dims) & finite)
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall("embedding", lambda x: F.abs(x.cast("double") * scale) < LARGEST)
    too_large = F.raise_error(F.lit(f"a scaled component is beyond {LARGEST}"))
    return whole.select("vec_id", F.when(fits, scaled).otherwise(too_large).cast("array<int>").alias("vec"))


def first_centroids(vectors: DataFrame, count: int = CENTROIDS, seed: str = SEED) -> np.ndarray:
    """The ``count`` vectors with the smallest hashes of their ids; a null id is hashed as an empty one, equal ids go by components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    picked = vectors.select(digest.alias("digest"), "vec").orderBy("digest", "vec").limit(count).collect()
    return np.array([r.vec for r in picked], dtype=np.int64).reshape(len(picked), -1 if picked else 0)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact matrix product of integers: in doubles where no sum can reach 2**53, else in 64-bit integers."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[-1])
    if bound < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _rows(column, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def moved(state: DataFrame, centroids: np.ndarray, change: np.ndarray) -> DataFrame:
    """(vec_id, vec, dots, cluster, distance) after the centroids changed; one pass, no shuffle.

    ``centroids`` and ``change`` have a row per centroid, which the parameters bound; they travel with the task.
    """
    count, dims = centroids.shape
    norms = (centroids ** 2).sum(axis=1)
    touched = [(j, np.flatnonzero(change[j])) for j in range(count) if change[j].any()]

    def step(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            vec = _rows(batch.column(1), dims, np.int64)
            dots = _rows(batch.column(2), count, np.int64)
            by_component = np.ascontiguousarray(vec.T)
            for j, at in touched:
                dots[:, j] += product(change[j, at], by_component[at])
            far = (vec ** 2).sum(axis=1)[:, None] - 2 * dots + norms
            cluster = far.argmin(axis=1)
            starts = pa.array(np.arange(0, dots.size + 1, count), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(starts, pa.array(dots.ravel())),
                 pa.array(cluster.astype(np.int32)), pa.array(far[np.arange(len(far)), cluster])],
                names=["vec_id", "vec", "dots", "cluster", "distance"])

    kinds = f"vec_id {state.schema['vec_id'].dataType.simpleString()}, vec array<int>, dots array<long>, cluster int, distance long"
    return state.select("vec_id", "vec", "dots").mapInArrow(step, kinds)


def new_centroids(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of each centroid's vectors; a centroid without any stays.

    Every task sends one row per centroid and component.
    """
    count, dims = centroids.shape

    def sums(batches):
        import pyarrow as pa

        total, rows = np.zeros((count, dims), dtype=np.int64), np.zeros(count, dtype=np.int64)
        for batch in batches:
            cluster = batch.column(1).to_numpy()
            chosen = np.zeros((count, len(cluster)), dtype=np.int64)
            chosen[cluster, np.arange(len(cluster))] = 1
            total += product(chosen, _rows(batch.column(0), dims, np.int64))
            rows += np.bincount(cluster, minlength=count)
        at = np.repeat(np.arange(count, dtype=np.int32), dims)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(np.tile(np.arange(dims, dtype=np.int32), count)), pa.array(total.ravel()),
             pa.array(np.repeat(rows, dims))], names=["cluster", "component", "total", "n"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    parts = state.select("vec", "cluster").mapInArrow(sums, "cluster int, component int, total long, n long").where("n > 0")
    out = centroids.copy()
    for r in parts.groupBy("cluster", "component").agg(wide("total").alias("total"), wide("n").alias("n")).collect():
        out[r.cluster, r.component] = int(r.total) // int(r.n)
    return out


def clustered(embeddings: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS,
              scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every whole vector.

    Vectors that are null, of another length, or hold a null or non-finite component give no row. Null and repeated
    ids are vectors like any other; ties between centroids go to the smaller number. With fewer vectors than
    ``count`` there are as many centroids; an empty table gives no rows. Other columns are not read.

    A round reads the vectors with their products and writes them with the new ones; the version before is dropped
    then. A lost executor repeats the tasks of one round.
    """
    spark = embeddings.sparkSession
    vectors = kept(integer_vectors(embeddings, dims, scale), "vectors")
    centroids = first_centroids(vectors, count, seed)
    if not len(centroids):
        return vectors.select("vec_id", *[F.lit(None).cast(kind).alias(c) for c, kind in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    none = F.array_repeat(F.lit(0).cast("long"), len(centroids)).alias("dots")
    state, path = kept_at(moved(vectors.select("vec_id", "vec", none), centroids, centroids), "products")
    for _ in range(rounds):
        new = new_centroids(state, centroids)
        change, centroids = new - centroids, new
        if not change.any():
            break
        before = path
        state, path = kept_at(moved(state, centroids, change), "products")
        dropped(spark, before)
    sums = {r.cluster: int(r.s) for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(k, s, sum(sums.values()), marks[k]) for k, s in sorted(sums.items())]
    totals = constant_frame(spark, rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(totals, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole vector's cluster after five rounds of forty centroids."""
    return clustered(table(spark, sf_dir, "embeddings"))


def _sql(rounds: int = ROUNDS) -> str:
    nearest = """SELECT k, cluster, d AS distance FROM (
                   SELECT v.k, c.j AS cluster, sum((v.x - c.x) * (v.x - c.x)) AS d
                   FROM long v JOIN {c} c ON c.i = v.i GROUP BY v.k, c.j)
                 QUALIFY row_number() OVER (PARTITION BY k ORDER BY d, cluster) = 1"""
    steps = []
    for r in range(rounds):
        steps.append(f"n{r} AS MATERIALIZED ({nearest.format(c=f'c{r}')})")
        steps.append(f"""c{r + 1} AS MATERIALIZED (
            SELECT c.j, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
                SELECT n.cluster AS j, v.i, (sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS x
                FROM long v JOIN n{r} n ON n.k = v.k GROUP BY n.cluster, v.i) m ON m.j = c.j AND m.i = c.i)""")
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
            FROM embeddings
            WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
        long AS MATERIALIZED (SELECT k, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM kept),
        c0 AS MATERIALIZED (
            SELECT j, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM (
                SELECT vec, row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), vec) - 1 AS j
                FROM kept QUALIFY j < {CENTROIDS})),
        {", ".join(steps)},
        final AS MATERIALIZED ({nearest.format(c=f'c{rounds}')}),
        marks AS (SELECT j, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY i)) AS mark FROM c{rounds} GROUP BY j)
        SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
               CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia, mark AS centroid_sha256
        FROM final JOIN kept USING (k) JOIN marks ON marks.j = cluster"""


OP13_SQL = _sql()
