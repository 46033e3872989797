from __future__ import annotations

import hashlib
import math
import random

import numpy as np

from tickgate.llm import centroids

DIM = 64
SCHEMA = "vec_id long, embedding array<float>, cluster string, id string, vec string"


def brute(rows, k=40, rounds=5, dim=DIM):
    ok = [(i, v) for i, v in rows if v is not None and len(v) == dim
          and all(x is not None and math.isfinite(x) and abs(x) < 1 << 19 for x in v)]
    vecs = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in ok]
    start = sorted(vecs, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [c for _, c in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        which = [near(v)[1] for _, v in vecs]
        for j in range(len(centres)):
            mine = [v for (_, v), w in zip(vecs, which) if w == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, *near(v)[::-1]) for i, v in vecs]
    total = {j: sum(d for _, w, d in out if w == j) for j in range(len(centres))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    fits = lambda x: x if x < 1 << 63 else None
    return [(i, j, d, fits(total[j]), fits(sum(total.values())), sha[j]) for i, j, d in out]


def _key(r):
    return tuple((x is None, x) for x in r)


def _same(spark, rows, k=40):
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA)
    got = centroids.cluster(df, k=k)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=_key) == sorted(brute(rows, k), key=_key)


def test_clustered_vectors_ties_and_defects(spark):
    rng = random.Random(3)
    hubs = [[rng.uniform(-1, 1) for _ in range(DIM)] for _ in range(9)]
    rows = [(i, [x + rng.gauss(0, 0.02) for x in hubs[i % 9]]) for i in range(700)]
    rows += [(1000 + i, hubs[0]) for i in range(400)]                                  # a large group of equal vectors
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, hubs[1]), (None, hubs[2])]       # repeated and null ids
    rows += [(2000, None), (2001, []), (2002, [0.0] * 63), (2003, [0.0] * 63 + [float("nan")]), (2004, [None] + [0.0] * 63),
             (2005, [float("inf")] + [0.0] * 63), (2006, [0.0] * 64), (2007, [3e30] + [0.0] * 63), (2008, [0.0] * 65)]
    _same(spark, rows)


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    _same(spark, [(i, [rng.uniform(-5e5, 5e5) for _ in range(DIM)]) for i in range(60)], k=7)


def test_few_vectors_and_empty_table(spark):
    _same(spark, [(1, [0.5] * DIM), (2, [0.25] * DIM), (3, [0.25] * DIM)])
    _same(spark, [])
    _same(spark, [(1, None)])


def test_boxes_never_lose_the_nearest_centroid_and_do_prune():
    rng = np.random.default_rng(1)
    pruned = 0
    for _ in range(60):
        centres = rng.integers(-300, 300, (12, 5))
        q = rng.integers(-300, 300, 5) + rng.integers(-40, 40, (30, 5))
        d = ((q[:, None] - centres) ** 2).sum(2)
        at = centroids.candidates(q.min(0), q.max(0), centres)
        which, dist = centroids._nearest(q, (q.min(0), q.max(0)), centres)
        assert (which == d.argmin(1)).all() and (dist == d.min(1)).all()
        pruned += 12 - len(at)
    assert pruned > 300


def test_hilbert_curve_visits_neighbours():
    for axes, bits in ((2, 3), (3, 2), (4, 1)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = [k.tobytes() for k in centroids.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        path = cells[sorted(range(len(cells)), key=lambda i: keys[i])]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()
