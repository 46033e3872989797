from __future__ import annotations

import hashlib

import pytest

from tickgate.llm import exact_dedup

ROWS = [(1, "a", "x"), (2, "a", None), (3, "", "x"), (4, None, "x"), (5, "long " * 5000, "x"), (6, "long " * 5000, "y"),
        (7, "A", "x"), (8, "a ", "x"), (None, "a", "x"), (None, "z", "x"), (None, "z", "x"), (9, "q", "x"), (9, "q", "x")]
SCHEMA = "doc_id long, text string, keep_id string"


def brute(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t, _ in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_decisions_equal_brute_force(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for bits in (21, 10):
        got = exact_dedup.decide(docs, max_block_bits=bits)
        assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS)


def test_a_saturated_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_block_bits", lambda rows, most: 1)
    rows = [(i, f"t{i % 700}", "") for i in range(1000)]
    got = exact_dedup.decide(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("slices", [1, 5])
def test_repeated_bits_are_all_found_and_travel_packed(spark, slices):
    texts = [f"t{i}" for i in range(3000)] + [f"t{i}" for i in range(0, 300, 7)] + ["hot"] * 1500
    rows = spark.createDataFrame([(hashlib.sha256(t.encode()).digest(),) for t in texts], "sha binary").repartition(slices)
    words = exact_dedup.possibly_repeated(rows, "sha", exact_dedup._block_bits(len(texts), 21))
    hit = {bytes(r["sha"]) for r in exact_dedup._route(rows, "sha", words, exact_dedup._block_bits(len(texts), 21)).where("__hit").collect()}
    twice = {t for t in texts if texts.count(t) > 1}
    assert {hashlib.sha256(t.encode()).digest() for t in twice} <= hit
    if slices > 1:      # with one slice alone a part holds many bits
        assert len(hit) < 2000


def test_rows_that_stay(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = exact_dedup.keep_distinct(docs)
    assert got.columns == docs.columns
    want = [(2, "a", None), (4, None, "x"), (6, "long " * 5000, "y"), (7, "A", "x"), (8, "a ", "x"),
            (None, "z", "x"), (None, "z", "x"), (9, "q", "x"), (9, "q", "x")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.decide(docs).count() == 0
    assert exact_dedup.keep_distinct(docs).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    plan = exact_dedup.decide(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
