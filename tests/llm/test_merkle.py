from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tickgate.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, id string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(i, text, lang, source, n):
    f = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    return H(f(i), f(source), f(lang), f(n), f(text))


def _tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def _way(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 8 * 8
        out.append((level[first:i], level[i + 1:first + 8]))
        i //= 8
    return out


def brute(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(*r)))
        trees[lang] = _tree([_leaf(*r) for r in langs[lang]])
    top = _tree([trees[lang][-1][0] for lang in order])
    out = []
    for at, lang in enumerate(order):
        for i, r in enumerate(langs[lang]):
            way = _way(trees[lang], i) + _way(top, at)
            node = _leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                node = _leaf(r[0], r[1].translate(lower), *r[2:])
            for left, right in way:
                node = H(*left, node, *right)
            proof = H(*(x for left, right in way for x in left + right))
            root = top[-1][0]
            out.append((r[0], _leaf(*r), trees[lang][-1][0], root, proof, node, node == root))
    return out, {"" if lang is None else "=" + lang: trees[lang] for lang in order}


def rows_(n=1400):
    rng = random.Random(6)
    lang = lambda: rng.choice(["en"] * 8 + ["de", "de", "é", "z", None])
    rows = [(i * 3, rng.choice(["Some text %d", "lower text %d", "ÀÉ only %d"]) % i, lang(), rng.choice(["a", "b", None]), i % 90)
            for i in range(n)]
    rows += [(7_000_001, None, "en", "a", None), (7_000_002, "", "de", "", 0), (7_000_003, "Alone", "solo", "a", 5),
             (None, "No Id", "en", "a", 5), (None, "No Id either", "en", "a", 5), (3, "Again", "en", "a", 1), rows[2],
             (7_000_004, "LONG " * 50_000, "en", "a", 250_000)]
    return rows


def _same(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    m = merkle.Manifest(df)
    key = lambda r: (r[0] is not None, r)
    want, trees = brute(rows)
    assert sorted(map(tuple, m.proofs().collect()), key=key) == sorted(want, key=key)
    return m, trees


def test_proofs_against_brute_force(spark):
    m, trees = _same(spark, rows_())
    got = {}
    for r in m.log().collect():
        got.setdefault(r["tree"], {})[r["position"]] = (r["level"], r["index"], r["digest"].hex())
    assert set(got) == set(trees)
    for name, levels in trees.items():
        nodes = {(k, j, d) for k, level in enumerate(levels) for j, d in enumerate(level)}
        assert set(got[name]) == set(range(len(nodes))) and set(got[name].values()) == nodes
        seen = set()
        for p in sorted(got[name]):                    # every node after its children
            level, j, _ = got[name][p]
            assert level == 0 or {(level - 1, c) for c in range(8 * j, min(8 * j + 8, len(levels[level - 1])))} <= seen
            seen.add((level, j))


@pytest.mark.parametrize("rows", [[], [(1, "One", "en", "a", 3)], [(i, None, None, None, None) for i in range(9)],
                                  [(i, "T", f"l{i:03}", "a", 1) for i in range(70)]])
def test_small_tables(spark, rows):
    _same(spark, rows)


def test_closed_form_positions_are_completion_order():
    for n in (1, 2, 7, 8, 9, 63, 64, 65, 513, 600):
        digests = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
        log = merkle.postorder(digests, merkle.height(n))
        level, k = digests, 0
        while True:
            assert all(log[merkle.position(k, j, n)] == d for j, d in enumerate(level))
            if len(level) == 1:
                break
            level, k = [merkle._parent(level[i:i + 8]) for i in range(0, len(level), 8)], k + 1
        assert len(log) == sum(-(-n // 8 ** m) for m in range(merkle.height(n) + 1))


def test_tampering_is_found(spark):
    rows = [(i, f"Text {i}", "en", "a", 6) for i in range(40)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    for r in merkle.prove(df).collect():
        assert r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 != 0)
