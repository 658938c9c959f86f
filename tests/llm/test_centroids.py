import hashlib
import math
import random

import numpy as np
import pytest

from trapiche.llm.centroids import assign, cluster_vectors

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string"


def brute(rows, clusters, rounds, width, factor=64):
    kept = []
    for own, vector in rows:
        if vector is None or len(vector) != width:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((own, [math.floor(factor * float(np.float32(x))) for x in vector]))
    named = sorted(
        (hashlib.sha256(f"1:{own}".encode()).hexdigest(), v) for own, v in kept if own is not None
    )
    centroids = [v for _, v in named[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for i in range(len(centroids)):
            own = [v for (_, v), j in zip(kept, found) if j == i]
            if own:
                centroids[i] = [sum(x) // len(own) for x in zip(*own)]
    final = [(own, *nearest(v)) for own, v in kept]
    spread = {}
    for _, d, i in final:
        spread[i] = spread.get(i, 0) + d
    total = sum(spread.values())
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((own, i, d, spread[i], total, marks[i]) for own, d, i in final),
        key=lambda r: (r[0] is None, r),
    )


def found(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    result = cluster_vectors(table, **options)
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    mine = sorted((tuple(r) for r in result.select(*names).collect()), key=lambda r: (r[0] is None, r))
    return mine, result


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 0.3) for _ in range(8)] for _ in range(5)]
    rows = [
        (i, [x + draw.gauss(0, 0.08) for x in draw.choice(centres)]) for i in range(400)
    ]
    rows += [(1000 + i, [round(draw.choice([-0.5, 0.5]), 1)] * 8) for i in range(60)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (2000, None), (2001, []), (2002, [0.1] * 7)]
    rows += [(2003, [None] + [0.1] * 7), (2004, [math.nan] * 8), (2005, [math.inf] * 8)]
    mine, result = found(spark, rows, clusters=6, rounds=3, components=8)
    assert mine == brute(rows, 6, 3, 8)
    work = sum(r["evaluations"] for r in result.collect())
    assert work < 0.9 * 4 * 6 * len(mine)


def test_few_vectors_and_none(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-1.0, 2.0])]
    mine, _ = found(spark, rows, clusters=16, rounds=3, components=2)
    assert mine == brute(rows, 16, 3, 2)
    for none in ([], [(1, None), (2, [1.0])]):
        empty, result = found(spark, none, components=2)
        assert empty == [] and dict(result.dtypes)["distance"] == "bigint"


def test_bounds_use_total_displacement():
    """A centroid that went away and came back leaves the bounds as they were."""
    vectors = np.array([[0, 0], [10, 0]], np.int64)
    start = np.array([[1, 0], [9, 0]], np.int64)
    away = np.array([[4, 0], [6, 0]], np.int64)
    cluster, known = np.zeros(2, np.int32), np.zeros((2, 2), np.int64)
    since = np.full((2, 2), -1, np.int32)
    assert assign(vectors, cluster, known, since, [start]) >= 4
    assert cluster.tolist() == [0, 1]
    assert assign(vectors, cluster, known, since, [start, away, start]) == 0


def test_component_without_exact_distance(spark):
    table = spark.createDataFrame([(1, [1e30], "x", "y")], SCHEMA)
    with pytest.raises(Exception, match="no exact distance"):
        cluster_vectors(table, components=1)
