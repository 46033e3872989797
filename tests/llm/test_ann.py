from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickgate.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, asks, k=10):
    ok = {}
    for i, v, _ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v) or len(v) != len(rows[0][1]):
            continue
        ok.setdefault((i, tuple(v)), np.array(v, np.float64))
    out = {}
    for q, x in ok.items():
        if asks(q[0]):
            near = sorted((float(np.sqrt(((x - y) ** 2).sum())), i[0]) for i, y in ok.items() if i[0] != q[0])
            out[q[0]] = near[:k]
    return out


def _check(got, want):
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    assert set(by) == {q for q, near in want.items() if near}
    for q, rows in by.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, len(rows) + 1))
        assert [v for _, _, v in rows] == [v for _, v in want[q]]
        assert np.allclose([s for _, s, _ in rows], [s for s, _ in want[q]], rtol=0, atol=1e-12)


def _vectors(n, dim, seed=0):
    return np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)


def test_small_tables_are_exact(spark):
    x = _vectors(300, 8)
    x[50:90] = x[7]             # equal vectors, more than k
    x[91] = x[100]
    rows = [(i, [float(v) for v in row], "clash") for i, row in enumerate(x)]
    rows += [(1000, None, "c"), (1100, [0.0] * 8, "c"), (1200, [None] + [1.0] * 7, "c"), (1300, [float("nan")] + [1.0] * 7, "c"),
             (1400, [float("inf")] + [1.0] * 7, "c"), (1500, [1.0, 2.0], "c"), (None, [1.0] * 8, "c"), (100, rows[100][1], "c"), (1600, [], "c")]
    asks = lambda i: i % 10 == 0
    got = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, trees=8).collect()
    _check(got, brute(rows, asks))


def test_fewer_candidates_than_asked_for(spark):
    rows = [(i * 100, [float(i), 1.0], "c") for i in range(4)]
    got = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, trees=4).collect()
    _check(got, brute(rows, lambda i: True))
    one = spark.createDataFrame(rows[:1], SCHEMA)
    assert ann.search(one, F.lit(True), trees=4).count() == 0
    assert ann.search(one.limit(0), F.lit(True), trees=4).count() == 0


@pytest.mark.parametrize("piece", [200, 100_000])
def test_recall_and_pieces(spark, piece):
    """Longer prefixes and crowded nodes split into pieces give the same candidates."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 32))
    x = (centres[rng.integers(0, 20, 3000)] + 0.6 * rng.normal(size=(3000, 32))).astype(np.float32)
    rows = [(i, [float(v) for v in row], "c") for i, row in enumerate(x)]
    want = brute(rows, lambda i: i % 100 == 0)
    got = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, trees=32, candidates=1500, piece=piece).collect()
    hits = sum(len({r.vec_id for r in got if r.query_id == q} & {v for _, v in near}) for q, near in want.items())
    assert hits / sum(map(len, want.values())) > 0.9


def test_synchronous_ascent(spark):
    """Trees go up together; on the last level only as many as are needed."""
    counts = spark.createDataFrame([(1, 0, [50, 20, 4, 1, 1]), (1, 1, [50, 10, 3, 2, 1])], "id long, tree int, counts array<long>")
    level = lambda most, prefix=0: {r.tree: r.level for r in ann.levels(counts, prefix, most).collect()}
    assert level(2) == {0: 4, 1: 4}            # 1 + 1 entries at full length
    assert level(6) == {0: 2, 1: 3}            # 1, 2 | 2, 3 | 6: enough after the first tree of this level
    assert level(7) == {0: 2, 1: 2}
    assert level(10 ** 6) == {0: 0, 1: 0}
    assert level(10 ** 6, 1) == {0: 1, 1: 1}


def test_stopping_point_grows_with_the_table(spark):
    """A number of entries that is too small for the table is raised until the sampled queries reach their neighbours."""
    x = _vectors(4000, 32, seed=3)
    rows = [(i, [float(v) for v in row], "c") for i, row in enumerate(x)]
    want = brute(rows, lambda i: i % 50 == 0)
    df = spark.createDataFrame(rows, SCHEMA)
    hits = []
    for rule in ({}, {"recall": 0.0}):
        got = ann.search(df, F.col("vec_id") % 50 == 0, trees=32, candidates=300, **rule).collect()
        hits.append(sum(len({r.vec_id for r in got if r.query_id == q} & {v for _, v in near}) for q, near in want.items())
                    / sum(map(len, want.values())))
    assert hits[0] > 0.9 and hits[1] < 0.6


def test_outliers_ascend_above_the_dealt_prefix(spark):
    """Beside tight groups an outlier is alone in its nodes at a long prefix, and still gets all its rows."""
    rng = np.random.default_rng(8)
    centres = 5 * rng.normal(size=(3, 16))
    x = centres[rng.integers(0, 3, 600)] + 0.01 * rng.normal(size=(600, 16))
    x[::60] = 5 * rng.normal(size=(10, 16))
    rows = [(i, [float(v) for v in row], "c") for i, row in enumerate(x.astype(np.float32))]
    want = brute(rows, lambda i: i % 60 == 0)
    # pieces of 1 make the longest prefix, of 12 a shorter one and pieces of nodes below the level
    for piece in (1, 12):
        got = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 60 == 0, trees=4, candidates=1, piece=piece).collect()
        by = {}
        for r in got:
            by.setdefault(r.query_id, []).append(r["rank"])
        assert set(by) == set(want) and all(sorted(r) == list(range(1, 11)) for r in by.values())
    # enough entries for the whole table: exact
    got = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 60 == 0, trees=2, candidates=1200, piece=12).collect()
    _check(got, want)


def test_found_ids_travel_in_chunks(spark, monkeypatch):
    """A dense group that shares whole strings comes in bounded rows; slots and parts change no result."""
    import pyarrow as pa
    entries = pa.table({"string": np.full(10_000, 77, np.int32), "id": np.arange(10_000)})
    queries = pa.table({"string": np.array([77, 5], np.int32), "id": np.array([3, 4]), "level": np.array([4, 4], np.int32)})
    got = ann._collect((0, 0, 0), entries, queries)
    lengths = [len(x) for x in got.column("found")]
    assert sum(lengths) == 10_000 and max(lengths) <= 4096 and set(got.column("id").to_pylist()) == {3}
    assert sorted(i for x in got.column("found").to_pylist() for i in x) == list(range(10_000))
    rng = np.random.default_rng(4)
    x = np.concatenate([np.ones((100, 8)) + 1e-3 * rng.normal(size=(100, 8)), rng.normal(size=(200, 8))]).astype(np.float32)
    rows = [(i, [float(v) for v in row], "c") for i, row in enumerate(x)]
    for name, value in (("CHUNK", 7), ("ASKED", 3), ("PART", 4)):
        monkeypatch.setattr(ann, name, value)
    got = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, trees=8, piece=64).collect()
    _check(got, brute(rows, lambda i: i % 10 == 0))
