from __future__ import annotations

import hashlib
import random
import re

import pytest

from tickgate.llm import pii

SCHEMA = "doc_id long, text string, spans string"


def luhn(s):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if 2 * int(c) > 9 else 2 * int(c))
               for i, c in enumerate(reversed(s))) % 10 == 0


def base(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    tests = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15))
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in tests for m in re.finditer(p, t) if ok(m)]


def texts():
    rng = random.Random(8)
    parts = ["bob.x@mail8.example.com", "a@b.c_d@e.f", "a@b@c.d", "x@y", "+1 (988) 555-2485", "+49 30 1234567", "++12345678901", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "378282246310005", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "0255.000.1.1", "999999999999999999999.1.1.1",
             "é", "🙂", "word", "\n", ".", ",", "-", " ", "12", "call", "card:", "e-mail", "(at)", "1" * 50, "a" * 50, "%", "+"]
    out = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(1, 25))) for _ in range(250)]
    return out + ["", "🙂🙂 bob@x.org", "a" * 60_000 + "@", "7" * 40_000, "1." * 20_000, "a@" + "b." * 8_000 + "c", " ".join(["bob@x.org"] * 1500),
                  "+" + "1 " * 20_000, "none at all"]


def test_base_spans_equal_brute_force(spark):
    ts = texts()
    rows = [(i, t, "clash") for i, t in enumerate(ts)] + [(None, None, "c"), (0, ts[0], "c")]
    got = pii.report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        t = ts[r.doc_id] if r.doc_id is not None else ""
        want = base(t)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t[:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k in pii.KINDS]
        spans = [x.split(":") for x in r.spans.split(",") if x]
        assert set(want) <= {":".join(x) for x in spans}
        assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), int(x[1])))


def test_luhn(spark):
    from pyspark.sql import functions as F
    rng = random.Random(1)
    ds = ["".join(rng.choice("0123456789") for _ in range(rng.randint(1, 19))) for _ in range(300)] + ["4111111111111111"]
    got = spark.createDataFrame([(d,) for d in ds], "d string").select("d", pii.luhn(F.col("d")).alias("ok")).collect()
    assert {r.d: r.ok for r in got} == {d: luhn(d) for d in ds}


def test_em_finds_the_unreliable_labeler():
    rng = random.Random(3)
    right = [(0.95, 0.9), (0.9, 0.95), (0.85, 0.85), (0.5, 0.5), (0.9, 0.8)]
    counts, truth = {}, {}
    for _ in range(20_000):
        y = rng.random() < 0.4
        v = tuple(0 if rng.random() < 0.2 else (1 if y else -1) * (1 if rng.random() < r[not y] else -1) for r in right)
        counts[v] = counts.get(v, 0) + 1
        truth[v] = truth.get(v, 0) + y
    p, rate = pii.expectation_maximisation([(0, list(v), c) for v, c in counts.items()])
    error = sum(abs(q - truth[v] / c) * c for (v, c), q in zip(counts.items(), p)) / 20_000
    assert error < 0.05
    assert min(rate, key=sum) == rate[3]


def test_added_spans(spark):
    """Written-out addresses are added where the other signs speak for them; ordinary numbers are not."""
    rows = [(i, f"Please mail bob{i}@site.com or call phone: +1 (988) 555-24{i:02d}. Card: 4111 1111 1111 1111.", "c") for i in range(30)]
    rows += [(100, "E-mail: jane.doe (at) site [dot] com now", "c"), (101, "phone: (988) 555-2485", "c"), (102, "order serial 1234567890123456", "c"),
             (103, "plain words and 12 numbers, version 1.2.3.4", "c")]
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[100].spans == "email:8:36" and got[100].n_email == 0
    assert got[101].spans == "phone:7:21"
    assert got[102].spans == "" and got[103].spans == "ip:36:43"


def test_native_and_empty(spark):
    docs = spark.createDataFrame([(1, "a@b.c", "c")], SCHEMA)
    plan = pii.report(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pii.report(docs.limit(0)).count() == 0
    assert pii.report(spark.createDataFrame([(1, "nothing here", "c")], SCHEMA)).first().spans == ""


@pytest.mark.parametrize("text", ["x" * 300_000, "1-" * 100_000, "a.b" * 100_000])
def test_long_runs_take_linear_time(spark, text):
    assert pii.report(spark.createDataFrame([(1, text + "@", "c")], SCHEMA)).count() == 1


def planted(n=400, seed=4):
    """(rows, spans that are personal data, spans that are not) of forms that the base patterns miss."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    name = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 9)))
    forms = [
        ("email", lambda: (f"{rng.choice(['E-mail', 'contact', 'write to'])}: ", f"{name()}.{name()} (at) {name()} [dot] {rng.choice(['com', 'org', 'de'])}", " today")),
        ("phone", lambda: (f"{rng.choice(['phone', 'call', 'mobile', 'tel'])}: ", f"({rng.randint(200, 989)}) {rng.randint(200, 989)}-{digits(4)}", " after noon")),
        ("ip", lambda: (f"{rng.choice(['host', 'server', 'login from'])} ", ":".join(f"{rng.randrange(4096, 65536):x}" for _ in range(8)), " seen")),
        (None, lambda: (f"{rng.choice(['order', 'serial', 'tracking'])} ", "9" + digits(15), " shipped")),
        (None, lambda: (f"{rng.choice(['part no', 'invoice', 'serial'])} ", f"{rng.randint(200, 989)}-{rng.randint(200, 989)}-{digits(4)}", " in stock")),
    ]
    rows, true, false = [], set(), set()
    for i in range(n):
        kind, form = forms[i % len(forms)]
        before, span, after = form()
        if kind is None and luhn(re.sub("[^0-9]", "", span)):
            span = span[:-1] + str((int(span[-1]) + 1) % 10)     # a right check digit would be a base span
        lead = " ".join(name() for _ in range(rng.randint(0, 30))) + " "
        rows.append((i, f"{lead}{before}{span}{after}", "c"))
        place = (i, len(lead) + len(before), len(lead) + len(before) + len(span))
        (true if kind else false).add((kind, *place) if kind else place)
        if i % 4 == 0:      # ordinary base spans, as a corpus holds
            rows.append((n + i, f"Mail bob{i}@{name()}.com or phone: +1 (988) 555-{i % 10000:04d}. Card: 4111 1111 1111 1111. Server 10.20.30.{i % 250}", "c"))
    return rows, true, false


def test_added_spans_on_planted_forms(spark):
    rows, true, false = planted()
    got = set()
    for r in pii.report(spark.createDataFrame(rows, SCHEMA)).collect():
        if r.doc_id < 400:
            for x in filter(None, r.spans.split(",")):
                kind, s, e = x.split(":")
                got.add((kind, r.doc_id, int(s), int(e)))
    precision, recall = len(got & true) / max(1, len(got)), len(got & true) / len(true)
    by_kind = {k: (sum(x in got for x in true if x[0] == k), sum(x[0] == k for x in true)) for k in ("email", "phone", "ip")}
    print("added spans:", round(precision, 3), round(recall, 3), by_kind)
    assert not {x[1:] for x in got} & false
    assert precision >= 0.95 and recall >= 0.9
