from __future__ import annotations

import hashlib
import random

from tickgate.llm import line_dedup

SCHEMA = "doc_id long, text string, id string, sha string, keys string, __n_linesx string"
BLANK = " \t\n\x0b\x0c\r"


def _key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows, min_chars=40, min_docs=5):
    where = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(_key(line)) >= min_chars:
                where.setdefault(_key(line), set()).add(i)
    keep = {k: max(ids, key=lambda x: (x is not None, x or 0)) for k, ids in where.items() if len(ids) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if _key(x) not in keep or keep[_key(x)] == i]
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def rows_():
    rng = random.Random(2)
    line = lambda: " ".join(rng.choice(["alpha", "Beta", "gamma", "déjà", "vu", "zwölf"]) for _ in range(rng.randint(1, 14)))
    shared = [line() + " shared by several documents of the set" for _ in range(30)]
    hot = "This very common line stands in a third of all documents"
    rows = []
    for i in range(400):
        lines = [line() for _ in range(rng.randint(0, 8))] + rng.sample(shared, rng.randint(0, 3))
        if i % 3 == 0:
            lines += [rng.choice(["", "  ", "\t"]) + (hot.upper() if i % 2 else hot) + rng.choice(["", " ", "\r"])] * rng.choice([1, 1, 2])
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    four, exact, short = "x" * 39 + "4", "é" * 40, "y" * 39
    rows += [(500 + i, four if i < 4 else "") for i in range(5)]                   # four documents only
    rows += [(600 + i, f"{exact}\n{short}\n\x0b{exact}") for i in range(5)]        # just long enough, and too short
    rows += [(700, None), (701, ""), (702, "\n\n"), (None, hot), (None, "a\n" + hot), (703, "\xa0" + hot), (704, "İ" * 40)]
    rows += [(5, rows[5][1]), (6, hot + "\nelse"), (800, (hot + "\n") * 3000 + "end")]   # repeated ids, a long text
    return rows


def _same(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], SCHEMA)
    got = line_dedup.report(df, **kw)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0] is not None, r)) == brute(rows, **kw)


def test_report_against_brute_force(spark):
    rows = rows_()
    assert sum(r[2] for r in brute(rows)) > 300
    _same(spark, rows)


def test_full_filters_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MAX_WORDS", line_dedup.CHUNK)
    monkeypatch.setattr(line_dedup, "BITS_A_KEY", 1)
    _same(spark, rows_())


def test_other_limits_and_empty_tables(spark):
    _same(spark, rows_(), min_chars=5, min_docs=2)
    _same(spark, [])
    _same(spark, [(1, None)])


def test_dedup_keeps_other_columns(spark):
    rows = [(i, f"own line {i}\n" + "the same long line in each of the documents") for i in range(6)]
    df = spark.createDataFrame([(i, t, f"a{i}", "b", "c", "d") for i, t in rows], SCHEMA)
    got = {r["doc_id"]: r for r in line_dedup.dedup(df).collect()}
    assert set(df.columns) < set(got[0].asDict()) and got[3]["id"] == "a3"
    assert got[3]["text"] == "own line 3" and got[5]["text"] == rows[5][1] and got[0]["__n_dropped"] == 1


def test_only_suspects_shuffle(spark):
    """Of unique long lines hardly any hits the second filter."""
    rng = random.Random(8)
    rows = [(i, "\n".join(f"{rng.random():.17f} " * 3 for _ in range(20))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, text string")
    bits = line_dedup._word_bits(df, line_dedup.text_or_empty("text"), 40)
    keys = df.select("id", line_dedup.line_keys(df["text"]).alias("keys"))
    assert line_dedup._suspects(keys, line_dedup.seen_twice(keys, bits), bits).count() < 0.03 * 6000
