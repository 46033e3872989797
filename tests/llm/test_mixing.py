from __future__ import annotations

import math
import random
import re

import pytest

from tickgate.llm import mixing

SCHEMA = "doc_id long, text string, source string, copies string"


def _rows():
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * int(rng.lognormvariate(3, 1))), rng.choice(["a", "a", "a", "b", "c", None, "é"]), "x")
            for i in range(600)]
    return rows + [(1000, None, "a", "x"), (1001, "", "only-empty", "x"), (1002, "w " * 30000, "b", "x"),
                   (1003, "a b c", "c", "x"), (None, "w w", "b", "x"), (5, rows[5][1], rows[5][2], "x")]


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = (total - sum(target.values())) / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > cap * sizes[s]}
        if not over:
            target |= {s: level * w[s] for s in free}
            break
        target |= {s: cap * sizes[s] for s in over}
        free -= over
    return target


def test_mix_against_brute_force(spark):
    rows = _rows()
    got = mixing.plan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = brute_targets(sizes)
    by = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r["size"] and r.taken <= 2 * r["size"]
        e = r.target / r.source_size if r.source_size else 0
        assert math.floor(e) <= r.copies <= math.ceil(e)
        by.setdefault(r.source, []).append(r)
    for s, rs in by.items():
        expected = sum(r.target / r.source_size for r in rs) if sizes[s] else 0
        assert abs(sum(r.copies for r in rs) - expected) <= 1
    # blocks of ids change how ranks are found, not what they are
    assert sorted(map(tuple, got), key=repr) == sorted(
        map(tuple, mixing.plan(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()), key=repr)


def test_id_blocks_do_not_change_ranks(spark, monkeypatch):
    docs = spark.createDataFrame(_rows(), SCHEMA)
    whole = sorted(map(tuple, mixing.plan(docs).collect()), key=repr)
    monkeypatch.setattr(mixing, "ID_BLOCK", 16)
    assert sorted(map(tuple, mixing.plan(docs).collect()), key=repr) == whole


def test_rows_of_the_mix_and_empty_table(spark):
    rows = [r for r in _rows() if r[0] is not None][:-1]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    counts = {}
    for r in out.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {r.doc_id: r.copies for r in mixing.plan(docs).collect() if r.copies}
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.plan(empty).count() == 0 and mixing.mix(empty).count() == 0
