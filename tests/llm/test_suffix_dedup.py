from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tickgate.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string, kept string"


def brute(rows, length):
    texts = [(t or "").encode() for _, t, _ in rows]
    seen = {}
    for b in texts:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for (doc_id, _, _), b in zip(rows, texts):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def _rows(length, seed=1):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdeé") for _ in range(n))
    shared = [word(rng.choice([length // 2, length - 1, length, length + 3, 2 * length, 4 * length])) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [word(rng.randint(0, length))]
        for _ in range(rng.randint(0, 4)):
            parts += [rng.choice(shared), word(rng.choice([0, 1, 7, length // 3]))]
        rows.append((i, "".join(parts), "clash"))
    w = word(3 * length)
    rows += [(100, w, "c"), (101, w, "c"), (102, w[5:], "c"), (103, "x" + w[:-1], "c"), (104, w[:length] + "!" + w[length + 1:], "c")]
    rows += [(110, None, "c"), (111, "", "c"), (112, "ab" * length, "c"), (113, "z" * (length + 1), "c"), (114, "y" * length, "c"),
             (None, word(2 * length), "c"), (None, "q" * length, "c"), (100, w, "c"), (100, word(length) + shared[-1], "c")]
    rng.shuffle(rows)
    return rows


def _got(spark, rows, length):
    return sorted(map(tuple, S.report(spark.createDataFrame(rows, SCHEMA).repartition(4), length=length).collect()), key=repr)


@pytest.mark.parametrize("length", [400, 60, 7])
def test_against_brute_force(spark, length):
    rows = _rows(length)
    assert _got(spark, rows, length) == brute(rows, length)


def test_many_buckets_and_flushes(spark, monkeypatch):
    """Small buckets, flushes and parts change nothing. Sizes are read on the driver, the rest is set where it is used."""
    rows = _rows(60, seed=2)
    monkeypatch.setattr(S, "BUCKET", 200)
    assert _got(spark, rows, 60) == brute(rows, 60)


def test_cover_has_every_difference():
    for length in (7, 26, 60, 146, 400, 1000):
        v, cover = S.difference_cover(length)
        assert v <= max(1, length // 2) and len({(a - b) % v for a in cover for b in cover}) == v
    assert S.difference_cover(400) == (181, S.difference_cover(400)[1]) and len(S.difference_cover(400)[1]) == 16


def test_fingerprints_follow_content(monkeypatch):
    rng = np.random.default_rng(1)
    b = rng.integers(0, 3, 3000).astype(np.uint8)
    starts = np.arange(0, 2991)
    want = {}
    for part in (1 << 18, 64):
        monkeypatch.setattr(S, "PART", part)
        f = S.fingerprints(b, starts, 10)
        for s, x in zip(starts, f):
            assert want.setdefault(b[s:s + 10].tobytes(), int(x)) == int(x)
    assert len(set(want.values())) == len(want)


def test_thue_morse_texts_do_not_collide(spark):
    """Such strings collide in every polynomial modulo 2 ** 64; unique texts lose nothing."""
    word = lambda n, a, b: "".join(a if bin(i).count("1") % 2 else b for i in range(n))
    one, two = word(1 << 12, "M", "j"), word(1 << 12, "j", "M")
    b = np.frombuffer((one + two).encode(), np.uint8)
    f = S.fingerprints(b, np.array([0, 1 << 12]), 1 << 12)
    assert f[0] != f[1]
    assert S._reduced(np.array([S.PRIME, S.PRIME - 1, (S.PRIME - 1) ** 2, 0], np.uint64)).tolist() == [0, S.PRIME - 1, 1, 0]
    rows = [(1, one, "c"), (2, two, "c"), (3, "x" * 10 + one[:900], "c"), (4, "unique " * 3, "c")]
    assert _got(spark, rows, 400) == brute(rows, 400)


def test_dealer_and_bucket_combine_equal_entries():
    import pyarrow as pa
    d = S.Dealer(0, True)
    one = np.array([5, 5, 9], np.uint64)
    d.add(1, one, one, np.array([0, 10, 20]))
    d.add(2, one[:1], one[:1], np.array([3]))
    a = d.rows()
    d.add(3, one[2:], one[2:], np.array([7]))
    d.add(3, np.array([77], np.uint64), np.array([77], np.uint64), np.array([8]))
    t = S._repeated_in_bucket(8)(pa.Table.from_batches([a, d.rows()]))
    t = S.gathered(t)
    got = {(r["ref"], int(p) & 0x7FFFFFFF): bool(int(p) >> 31) for r in t.to_pylist() for p in np.frombuffer(r["places"], np.uint32)}
    assert got == {(1, 0): True, (1, 10): False, (2, 3): False, (1, 20): True, (3, 7): False}


def test_long_text_and_empty_table(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(400_000))
    rows = [(1, text, "c"), (2, text[200_000:200_500], "c")]
    got = {r.doc_id: r for r in S.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[1].n_removed, got[1].n_spans, got[2].n_removed) == (500, 1, 500)
    assert S.report(spark.createDataFrame([], SCHEMA)).count() == 0
