import math
import random

import numpy as np
import pytest

from trapiche.llm import hard_negatives
from trapiche.llm.hard_negatives import mine_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string"


def brute(rows, every):
    kept = []
    for own, vector, label in rows:
        if own is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((own, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    found = []
    for anchor in {(a, b, tuple(v)) for a, b, v in kept if a % every == 0}:
        scored = [(-sum(x * y for x, y in zip(anchor[2], v)), own, label) for own, label, v in kept]
        scored.sort()
        same = [(s, own) for s, own, label in scored if label == anchor[1] and own != anchor[0]]
        for score, positive in same[:5]:
            p = -score
            inside = [
                (-s, own)
                for s, own, label in scored
                if label != anchor[1] and 50 * p <= -100 * s <= 95 * p
            ]
            for rank, (n, own) in enumerate(inside[:3], 1):
                found.append((anchor[0], positive, rank, own, p, n))
    return sorted(found)


def mined(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in mine_negatives(table, **options).collect())


def rows_of(seed):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 0.2) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(500):
        at = draw.randrange(4)
        length = draw.choice([0.5, 1, 3])
        rows.append((i, [length * (x + draw.gauss(0, 0.1)) for x in centres[at]], at % 3))
    rows += [(1000 + i, [0.25] * 6, i % 2) for i in range(40)]
    rows += [(2000, [0.0] * 6, 1), (2001, [], 1), (2010, [0.5, 0.5], 0), (2020, [0.1] * 9, 2)]
    rows += [(3000, None, 1), (3001, [0.1] * 6, None), (None, [0.1] * 6, 1)]
    rows += [(3010, [None] + [0.1] * 5, 1), (3020, [math.nan] * 6, 0), (3030, [math.inf] * 6, 0)]
    return rows + [rows[10], rows[13]]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(hard_negatives, "LEAST_SLICE_ROWS", 50)
    rows = rows_of(seed)
    mine = mined(spark, rows, anchor_every=10, clusters=7, slice_rows=150)
    assert mine == brute(rows, 10)
    assert len(mine) > 100


def test_scores_beyond_exact_floats(spark):
    draw = random.Random(5)
    rows = [(i, [draw.uniform(1e5, 2e5) for _ in range(4)], i % 2) for i in range(60)]
    assert mined(spark, rows, anchor_every=20) == brute(rows, 20)


def test_without_anchors_or_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.5], 0), (2, [0.5], 1)]) == []
    assert mined(spark, [(0, [0.5], 0), (2, [0.5], 1)]) == []


def test_walk_stops_before_the_end():
    draw = np.random.default_rng(3)
    around = draw.normal(size=(20_000, 8)) + np.repeat(np.eye(8) * 12, 2_500, axis=0)
    vectors = np.floor(around * 20).astype(np.int64)
    candidates = hard_negatives.Candidates(np.arange(20_000), np.zeros(20_000), vectors)
    anchors = vectors[:30]
    centre = hard_negatives._unit(anchors.sum(axis=0)[None])[0][0]
    reach = hard_negatives._angles(hard_negatives._unit(anchors)[0], centre).max()
    shared = hard_negatives.SharedList(candidates, centre, reach)
    block = {"id": np.arange(30), "label": np.zeros(30), "vector": anchors}
    scores, rows, formed = hard_negatives._positives(block, candidates, shared, 5)
    assert formed < 0.5 * 30 * 20_000
    products = anchors @ vectors.T
    products[np.arange(30), np.arange(30)] = -(1 << 40)
    for i in range(30):
        best = sorted(zip(-products[i], range(20_000)))[:5]
        assert [(-s, r) for s, r in best] == list(zip(scores[i, 0], rows[i, 0]))
