from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tickgate.llm import near_dedup as N
from tickgate.llm.components import connected

SCHEMA = "doc_id long, text string, n string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(rows):
    sets = []
    for _, t, _ in rows:
        w = words(t)
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    label = [i for i, _, _ in rows]
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return sorted((i, len(s), c, i == c) for (i, _, _), s, c in zip(rows, sets, label))


def _rows():
    rng = random.Random(11)
    base = [["w%d" % rng.randint(0, 5000) for _ in range(rng.choice([60, 120, 300]))] for _ in range(12)]
    rows, i = [], 100
    for b in base:
        for edits in (0, 0, 1, 2, 3, 4, 6, 9):
            w = list(b)
            for _ in range(edits):
                w[rng.randrange(len(w))] = "x%d" % rng.randint(0, 10 ** 6)
            rows.append((i, rng.choice([" ", "\n", "\t "]).join(w), "c"))
            i += 1
    chain = list(base[0])
    for k in range(10):    # each close to the last, the ends far apart
        chain[20 * k % len(chain)] = f"y{k}"
        chain = chain[1:]
        rows.append((i, " ".join(chain), "c"))
        i += 1
    rows += [(1, "", "c"), (2, None, "c"), (3, " \n", "c"), (4, "one two", "c"), (5, "ONE\ttwo", "c"), (6, "two one", "c"),
             (7, "a b c d e", "c"), (8, "A b  c d e", "c"), (9, "É a b c d", "c"), (10, "é a b c d", "c"), (11, "a b", "c"),
             (12, "a b", "c"), (13, "spam " * 40_000, "c"), (14, "spam " * 7, "c")]
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark, monkeypatch):
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, N.group(docs).collect()))
    assert got == brute(rows)
    monkeypatch.setattr(N, "BLOCK", 3)   # many blocks in the full search
    assert sorted(map(tuple, N.group(docs.repartition(5)).collect())) == got
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, _, k in got if k)


def test_members_that_miss_the_hub_are_still_linked(spark):
    """Three texts: 1 ~ 2 ~ 3 but not 1 ~ 3, where 1 is the hub; and a pair that both miss their hub."""
    rng = random.Random(4)
    b = ["w%d" % rng.randint(0, 9999) for _ in range(400)]
    rows = [(1, b), (2, b[40:] + ["p%d" % k for k in range(10)]), (3, b[80:] + ["p%d" % k for k in range(10)]),
            (4, b[130:] + ["q%d" % k for k in range(20)]), (5, b[131:] + ["q%d" % k for k in range(20)])]
    rows = [(i, " ".join(w), "c") for i, w in rows]
    assert sorted(map(tuple, N.group(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)


def test_nulls_repeats_and_empty(spark):
    rows = [(None, "a b c d e f", "c"), (1, "a b c d e f", "c"), (1, "a b c d e f", "c"), (2, "a b c d e f", "c")]
    got = sorted(map(tuple, N.group(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted([(None, 2, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)], key=repr)
    empty = spark.createDataFrame([], SCHEMA)
    assert N.group(empty).count() == 0 and N.keep_one(empty).count() == 0


def test_minima_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(200):
        s = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
        a, b = s[:500], s[100:]
        errors.append((N.minima(np.unique(a)) == N.minima(np.unique(b))).mean() - 400 / 600)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.055


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 32, (20_000, N.HASHES), dtype=np.uint64).astype(np.uint32)
    for similarity, low, high in ((0.75, 0.999, 1.0), (0.4, 0.0, 0.01)):
        b = np.where(rng.random(a.shape) < similarity, a, a ^ np.uint32(1))
        assert low <= len(N.survivors(a, b, 0.75)) / len(a) <= high


def test_posterior_tail():
    for n in (32, 128):
        m = N.fewest_matches(n, 0.75, 1e-3)
        x = np.linspace(0, 1, 200_001)
        tail = lambda m: (x ** m * (1 - x) ** (n - m))[x >= 0.75].sum() / (x ** m * (1 - x) ** (n - m)).sum()
        assert tail(m) >= 1e-3 * 0.99 and tail(m - 1) < 1e-3


@pytest.mark.parametrize("seed", [0, 1])
def test_connected(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 180)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = dict(map(tuple, connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {x: find(x) for x in got} and all(x in got for e in edges if e[0] != e[1] for x in e)
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
