"""The pipeline stage by stage against brute force over the smallest tables."""
from __future__ import annotations

import hashlib
import os
import re

import pytest

import corpus_pipeline as C
from tickgate.llm.common import read, written

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def shingles(text):
    w = [x for x in re.split("[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.fixture(scope="module")
def steps(spark):
    docs = read(spark, SF, "documents")
    out = [("documents", docs)]
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, SF))
        out.append((name, docs))
    return out


def test_stages(spark, steps):
    assert [n for n, _ in C.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "bpe"]
    columns = steps[0][1].columns
    rows = [[r.asDict() for r in df.collect()] for _, df in steps]
    for (_, df) in steps[:-1]:
        assert df.columns == columns
    docs, good, distinct, single, mixed, tokens = rows
    label = {r.doc_id: r.quality for r in read(spark, SF, "labels").collect()}
    kept = {r["doc_id"] for r in good}
    assert all(kept.__contains__(r["doc_id"]) == bool(label[r["doc_id"]]) for r in docs if r["doc_id"] in label)

    largest = {}
    for r in good:
        largest[r["text"] or ""] = max(largest.get(r["text"] or "", -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in distinct) == sorted(largest.values())

    sets = {r["doc_id"]: shingles(r["text"]) for r in distinct}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert sorted(r["doc_id"] for r in single) == sorted({find(i) for i in ids})

    text = {r["doc_id"]: r["text"] or "" for r in single}
    times = {}
    for r in mixed:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert set(times) <= set(text) and max(times.values()) <= 2
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    total, taken = sum(words(t) for t in text.values()), sum(words(text[i]) * n for i, n in times.items())
    assert abs(taken - 1.5 * total) < 0.1 * total

    assert len(tokens) == len(mixed)
    for r in tokens:
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_run_gives_the_last_stage(spark, steps):
    got = C.run(spark, SF)
    key = lambda r: tuple(r)
    assert sorted(map(key, got.collect())) == sorted(map(key, steps[-1][1].collect()))
    assert C.ORACLE_SQL is None


def test_stages_on_awkward_rows(spark):
    """Null and empty texts, null ids, sources and languages, repeated ids and rows, a very long text."""
    docs = read(spark, SF, "documents")
    good = max((r.text for r in docs.join(read(spark, SF, "labels").where("quality = 1"), "doc_id").collect()), key=len)
    words = good.split()
    some = lambda k: " ".join(words[k:] + words[:k])
    odd = [(10**6, None, "en", "web"), (10**6 + 1, "", "en", "web"), (None, some(3), "en", "web"), (None, None, None, None),
           (10**6 + 2, some(50), "en", None), (10**6 + 2, some(90), None, "web"), (10**6 + 3, some(120), "en", "web"),
           (10**6 + 3, some(120), "en", "web"), (10**6 + 4, " ".join(some(k) for k in range(0, 100, 2)), "de", "news")]
    rows = [{"doc_id": i, "text": t, "lang": la, "source": s, "n_chars": None if t is None else len(t)} for i, t, la, s in odd]
    frame = docs.unionByName(spark.createDataFrame([[r[f.name] for f in docs.schema] for r in rows], docs.schema))
    was, key = None, lambda r: (r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"])
    for name, stage in C.STAGES:
        frame = written(stage(spark, frame, SF))
        now = [r.asDict() for r in frame.collect()]
        if was is not None and name != "bpe":
            assert {key(r) for r in now} <= {key(r) for r in was}, name
        if name == "exact_dedup":
            # rows that repeat id and text are one document; texts without any id stay
            assert {r["text"] or "" for r in now} == {r["text"] or "" for r in was}
            assert len({(r["doc_id"], r["text"] or "") for r in now}) == len({r["text"] or "" for r in was})
        if name == "bpe":
            left = sorted((repr(r["doc_id"]), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in was)
            assert sorted((repr(r["doc_id"]), r["decoded_sha256"]) for r in now) == left
        else:
            assert frame.columns == docs.columns
            was = now


def test_stages_on_an_empty_table(spark):
    frame = read(spark, SF, "documents").limit(0)
    columns = frame.columns
    for name, stage in C.STAGES:
        frame = written(stage(spark, frame, SF))
        assert frame.count() == 0 and (name == "bpe" or frame.columns == columns), name
