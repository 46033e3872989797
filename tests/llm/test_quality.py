from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tickgate.llm import quality as Q

D = "doc_id long, text string, stats string"


def _text(rng, kind, n):
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8))) for _ in range(n)]
    if kind == "shout":
        return " ".join(w.upper() + "!!" for w in words)
    if kind == "marks":
        return " ".join(w + rng.choice(["%%%", "&&&"]) for w in words)
    if kind == "again":
        return " ".join(w for w in words[: n // 10 + 1] for _ in range(10))
    return " ".join(words).capitalize() + "."


def _data(n=400, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        kind = rng.choice(["good"] * 5 + ["shout", "marks", "again"])
        docs.append((i, _text(rng, kind, rng.choice([20, 100, 400])), "clash"))
        if rng.random() < 0.7:
            labels.append((i, int(kind == "good"), "clash"))
    return docs, labels


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = _data()
    return (spark.createDataFrame(docs, D), spark.createDataFrame(labels, "doc_id long, quality int, text string"),
            dict((i, q) for i, q, _ in labels))


def test_held_out_accuracy_and_columns(spark, data):
    docs, labels, truth = data
    got = Q.score(docs, labels).collect()
    assert len(got) == 400
    from zlib import crc32
    right = []
    for r in got:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.held_out and r.doc_id in truth:
            right.append(r.predicted == truth[r.doc_id])
    assert len(right) > 30 and sum(right) / len(right) > 0.95


def test_column_equals_rules(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, len(Q.STATS)))
    y = ((x[:, 1] > 0.2) & (x[:, 3] < 0.5)).astype(float)
    m = Q.fit_arrays(x, y)
    assert 0 < len(m.rules) < 200
    z = m.bias + Q.holds(m.rules, x) @ np.array(m.weights)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "i long, s array<double>")
    from pyspark.sql import functions as F
    got = [r[0] for r in df.select("i", m.column(F.col("s")).alias("p")).orderBy("i").select("p").collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-z)))
    assert ((np.array(got) > 0.5) == y).mean() > 0.97


def test_held_out_labels_and_other_columns_are_not_used(spark, data):
    docs, labels, _ = data
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda r: r.doc_id
    a, b = (sorted(Q.score(docs, x).collect(), key=key) for x in (labels, flipped))
    assert [r.score for r in a] == [r.score for r in b]


def test_edges(spark, data):
    docs, labels, _ = data
    odd = docs.unionByName(spark.createDataFrame(
        [(None, "a b", "c"), (1000, None, "c"), (1001, "", "c"), (0, "twice", "c"), (0, "twice", "c"), (1002, "wort " * 60_000, "c")], D))
    got = Q.score(odd, labels.unionByName(spark.createDataFrame([(5, None, "c")], labels.schema))).collect()
    assert len(got) == 406 and all(0 <= r.score <= 1 for r in got)
    kept = Q.keep_good(odd, labels)
    assert kept.columns == odd.columns
    by_id = sorted(r.doc_id for r in got if r.predicted and r.doc_id is not None)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == by_id
    none = labels.limit(0)
    assert {r.score for r in Q.score(docs.limit(3), none).collect()} == {0.5}
    assert Q.score(docs.limit(0), labels).count() == 0


def plain_statistics(text):
    """The statistics as their names say, letter by letter."""
    import math
    if not text:
        return [0.0] * 16
    b = text.encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", b) if w]
    lines = [x for x in b.split(b"\n") if re.search(rb"[^\x20\x09-\x0D]", x)]
    of = lambda chars: sum(chr(x) in chars for x in b if x < 128)
    high = sum(x >= 128 for x in b)
    upper, lower = (sum(lo <= x <= hi for x in b) for lo, hi in ((65, 90), (97, 122)))
    n, m = max(1, len(words)), max(1, len(lines))
    again = sum(1 for k in range(1, len(words)) if words[k] == words[k - 1])
    return [math.log(1 + len(b)), len(words) / m, sum(len(w) for w in words) / n, upper / max(1, upper + lower + high),
            of("0123456789") / len(b), high / len(b), of("!") / n, of("|") / n, of("#$%&*+<=>@\\^_`~{}[]") / n, of(".?:;") / n, of(",") / n,
            again / n, math.log(1 + len(set(words))) / math.log(1 + n), (len(lines) - len(set(lines))) / m if lines else 0.0,
            len([w for w in words if len(w) > 24]) / n, len([w for w in words if len(w) == 1]) / n]


def test_statistics_equal_brute_force(spark):
    rng = random.Random(6)
    parts = ["word", "Word", "HTML", "é", "日本", "!", "!!", "|", "a", "x" * 30, "12", "3.5", ",", "#tag", "{}", "[x]", "\\", "~", "`", "?", ";",
             "\n", "\n\n", "\t", " ", "\r\n", "\x0b", "\x0c", "same same", "same\nsame", "\x1f", "\u00a0", "-", "(", "'", "/"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts += ["", " ", "\n \n", None, "z" * 200_000, "line\n" * 20_000]
    got = {r.doc_id: r.out for r in Q.with_statistics(spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], D), out="out").collect()}
    assert len(Q.STATS) == 16
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(plain_statistics(t), rel=1e-12, abs=1e-12), (t or "")[:60]
