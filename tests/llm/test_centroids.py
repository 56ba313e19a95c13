"""Centroid clustering against a plain version, the SQL, and odd inputs."""

import hashlib
import math
import random

import numpy as np
import oracle
import pytest

from tidewarden.llm import centroids

SHAPE = "vec_id long, embedding array<float>, label int"
SMALL = "/root/testdata/sf0.001"


def plain(rows, count, rounds, dims):
    vectors = []
    for i, e, *_ in rows:
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e):
            vectors.append((i, [math.floor(256 * float(np.float32(x))) for x in e]))
    mark = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    middle = [v for _, v in sorted(vectors, key=lambda r: (mark(r[0]), r[1]))[:count]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda: [min((far(v, c), j) for j, c in enumerate(middle)) for _, v in vectors]
    for _ in range(rounds):
        mine = nearest()
        for j in range(len(middle)):
            own = [v for (_, v), (_, k) in zip(vectors, mine) if k == j]
            if own:
                middle[j] = [sum(x) // len(own) for x in zip(*own)]
    mine = nearest()
    total = {j: sum(d for d, k in mine if k == j) for j in range(len(middle))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, j, d, total[j], sum(total.values()), digest[j]) for (i, _), (d, j) in zip(vectors, mine)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_clusters_agree_with_sql(spark):
    assert oracle.differences(centroids.op13_centroid_clusters(spark, SMALL), oracle.connect(SMALL), centroids.OP13_SQL) is None


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_clusters_agree_with_brute_force(spark, scale):
    """The larger scale is beyond exact doubles, so products are integer there."""
    rng = random.Random(3)
    rows = [(i % 90, [rng.gauss(0, scale) for _ in range(4)], None) for i in range(300)] + [(None, [0.0] * 4, 1)] * 3
    assert got(centroids.clustered(spark.createDataFrame(rows, SHAPE), 7, 5, 4)) == plain(rows, 7, 5, 4)


def test_vectors_that_are_not_whole_are_left_out(spark):
    rows = [(1, None, 1), (2, [], 1), (3, [1.0], 1), (4, [1.0, None], 1), (5, [1.0, float("nan")], 1), (6, [float("inf"), 0.0], 1),
            (7, [0.1, -0.1], None), (7, [0.1, -0.1], None), (None, [2.0, -2.0], None)]
    named = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 AS vec", "2 AS dots", "3 AS cluster", "4 AS distance", "5 AS n")
    assert got(centroids.clustered(named, 40, 5, 2)) == plain(rows, 40, 5, 2)
    assert centroids.clustered(named.where("vec_id = 1"), 40, 5, 2).count() == 0
    assert centroids.op13_centroid_clusters.__name__ == "op13_centroid_clusters"


def test_ties_and_equal_vectors(spark):
    rows = [(i, [float(i % 3), 0.0], None) for i in range(60)]
    assert got(centroids.clustered(spark.createDataFrame(rows, SHAPE), 10, 5, 2)) == plain(rows, 10, 5, 2)


def test_too_large_components_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0], None)], SHAPE)
    with pytest.raises(Exception, match="scaled component"):
        centroids.clustered(df, 2, 1, 2).collect()
