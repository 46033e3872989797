"""Personal data by weak supervision; DataFrame functions only.

Base spans come from one pattern per kind and a test of the match. Further candidates come from looser
patterns: written-out at-signs, long internet addresses, card numbers with a wrong check digit and phone
numbers without a country prefix. Five labelers (regex, gazetteer, context, shape, borders) vote yes, no or
abstain on every span. Expectation-maximisation over the counts of vote patterns estimates how reliable
each labeler is and how likely each pattern is personal data; a logistic span classifier is trained on
these probabilities over votes and flags, and compiled into a column expression. Candidates that it
scores at ``LIMIT`` or more are added; base spans stay.

One pass over whole texts keeps an array of spans per document; the fit reads only counts of (kind, votes,
flags), at most 4 * 3**5 * 2**6 rows whatever the input, and scoring reads the arrays: no shuffle but that count.

Offsets are in code points, ends exclusive. They come from the matches and the pieces between them, so no
marker is put into the text. Patterns are possessive and start only where a match can start, so long
runs of word characters or digits take linear time.

Defined cases: null text is the empty text; documents without spans have counts of 0 and empty strings;
candidates that overlap a base span or an earlier kind's candidate are dropped; without any span no classifier is needed and
nothing is added; null ids and rows that repeat an id are answered row by row; other columns are ignored; an
empty table gives an empty result.
"""
from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickgate.llm.common import text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("regex", "gazetteer", "context", "shape", "borders")
FLAGS = 6
LIMIT = 0.9
AROUND = 32     # code points of context on either side

# The base patterns, written so that a failed start cannot be tried again inside the same run.
LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What must be in a text for the pattern to be worth running.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
LOOSE = {
    "email": rf"(?<!{LOCAL}){LOCAL}++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
LOOSE_NEEDS = {"email": r"[(\[]at[)\]]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]", "phone": r"[0-9]{3}[\x20.-][0-9]{4}"}

# Gazetteers: top-level domains, card issuer prefixes, country calling codes (first digits).
DOMAINS = "com|org|net|edu|gov|info|biz|io|co|de|fr|es|it|uk|us|eu|ch|at|nl|be|pl|se|ru|cn|jp|in|br|ca|au|mx"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|64|35|30|36|38)"
CALLING = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
YES_WORDS = {
    "email": r"e-?mail|mail|contact|write|reach|address|correo|courriel", "ip": r"\bip\b|address|host|server|login|from",
    "card": r"card|visa|master|amex|credit|debit|payment|carte|tarjeta|karte",
    "phone": r"phone|\btel|call|mobile|cell|fax|contact|ring|telefon|whatsapp",
}
NO_WORDS = {
    "email": r"example only|noreply", "ip": r"version|\bv\b|release|section|chapter", "card": r"isbn|order|invoice|serial|tracking",
    "phone": r"isbn|order|invoice|serial|version|part no",
}

SPAN = "array<struct<kind:int,s:int,e:int,m:string,base:boolean>>"


# ---------------------------------------------------------------- spans

def located(text: Column, pattern: str) -> Column:
    """All matches with their offsets: array of struct(s, e, m)."""
    kind = "array<struct<s:int,e:int,m:string>>"
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    steps = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)),
                       lambda m, gap: F.struct(m.alias("m"), F.length(gap).alias("gap"), F.length(m).alias("n")))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        return F.struct((s + x["n"]).alias("at"), F.concat(acc["out"], F.array(
            F.struct(s.alias("s"), (s + x["n"]).alias("e"), x["m"].alias("m")))).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    return F.aggregate(steps, start, step, lambda acc: acc["out"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), F.lit(0), lambda a, i: a + value(i))
    return total % 10 == 0


def _fits(kind: str, m: Column) -> Column:
    d = _digits(m)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.when(
            F.length(F.regexp_replace(p, "^0++", "")) <= 3, F.coalesce(F.regexp_replace(p, "^0++", "").try_cast("int"), F.lit(0)) <= 255)
            .otherwise(F.lit(False)))
    if kind == "card":
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(d).between(9, 15)
    return F.lit(True)


def _as_spans(found: Column, kind: str, base: bool) -> Column:
    k = KINDS.index(kind)
    return F.transform(found, lambda x: F.struct(F.lit(k).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"),
                                                 F.lit(base).alias("base")))


def _where(text: Column, needs: str, found: Column) -> Column:
    return F.when(text.rlike(needs), found).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def spans_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text, spans: base spans and candidates of every whole text."""
    text = F.col("text")
    df = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    df = df.withColumns({f"r_{k}": _where(text, NEEDS[k], located(text, BASE[k])) for k in KINDS})
    df = df.withColumns({f"b_{k}": _as_spans(_filtered(f"r_{k}", k), k, True) for k in KINDS})
    df = df.withColumn("base", F.concat(*[F.col(f"b_{k}") for k in KINDS]))
    loose = {k: _where(text, LOOSE_NEEDS[k], located(text, LOOSE[k])) for k in LOOSE}
    loose["card"] = F.filter("r_card", lambda x: F.length(_digits(x["m"])).between(13, 19) & ~luhn(_digits(x["m"])))
    df = df.withColumns({f"l_{k}": _as_spans(loose[k], k, False) for k in KINDS})
    for k in KINDS:   # a candidate must be clear of base spans and of earlier kinds' candidates
        df = df.withColumn("base", F.concat("base", F.filter(f"l_{k}", lambda x: ~F.exists(
            "base", lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"])))))
    return df.select("id", "text", F.col("base").cast(SPAN).alias("spans"))


def _filtered(col: str, kind: str) -> Column:
    return F.filter(col, lambda x: _fits(kind, x["m"]))


# ---------------------------------------------------------------- labelers

def _by_kind(kind: Column, choose: Callable[[str], Column]) -> Column:
    out = F.lit(None)
    for k in reversed(KINDS):
        out = F.when(kind == KINDS.index(k), choose(k)).otherwise(out)
    return out


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(2)).when(no, F.lit(0)).otherwise(F.lit(1))


def labelled(spans: DataFrame) -> DataFrame:
    """id, spans: each span with ``votes`` (base-3 digits of the labelers: 0 no, 1 abstain, 2 yes) and ``flags``."""
    text = F.col("text")
    with_context = F.transform("spans", lambda x: F.struct(
        x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), x["base"].alias("base"),
        F.lower(F.substr(text, F.greatest(x["s"] - AROUND, F.lit(0)) + 1, F.least(x["s"], F.lit(AROUND)))).alias("before"),
        F.lower(F.substr(text, x["e"] + 1, F.lit(AROUND))).alias("after")))

    def mark(x: Column) -> Column:
        kind, m, near = x["kind"], x["m"], F.concat_ws(" \n ", x["before"], x["after"])
        digits = _digits(m)
        none = F.lit(False)
        regex = _vote(x["base"], ~x["base"] & (kind == KINDS.index("card")))
        gazetteer = _vote(
            _by_kind(kind, lambda k: {"email": F.lower(m).rlike(rf"[.)\]]\x20?(?:{DOMAINS})$"),
                                      "ip": ~m.rlike(r"^(?:0|255)\.") & m.rlike(r"^[0-9]{2,3}\."),
                                      "card": digits.rlike(ISSUERS), "phone": m.rlike(CALLING)}[k]),
            _by_kind(kind, lambda k: {"email": none, "ip": m.rlike(r"^[0-3](?:\.[0-9]){3}$"),
                                      "card": ~digits.rlike(ISSUERS), "phone": digits.rlike(r"^0{3}|^1{5}")}[k]))
        context = _vote(_by_kind(kind, lambda k: near.rlike(YES_WORDS[k]) & ~near.rlike(NO_WORDS[k])),
                        _by_kind(kind, lambda k: near.rlike(NO_WORDS[k])))
        shape = _vote(
            _by_kind(kind, lambda k: {"email": m.rlike(r"^[A-Za-z0-9][^@]{1,63}@?"), "ip": ~m.rlike(r"(?:^|\.)0[0-9]"),
                                      "card": m.rlike(r"^(?:[0-9]{13,16}|(?:[0-9]{4}[\x20-]){3}[0-9]{4}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})$"),
                                      "phone": m.rlike(r"[\x20().-]")}[k]),
            _by_kind(kind, lambda k: {"email": m.rlike(r"^[._%+-]|[._%+-]@"), "ip": m.rlike(r"(?:^|\.)0[0-9]"),
                                      "card": m.rlike(r"[\x20-][0-9][\x20-]"), "phone": m.rlike(r"[().-]{2}")}[k]))
        left, right = x["before"].rlike(r"(?:^|[\s:;,(<\"'=])$"), x["after"].rlike(r"^(?:$|[\s:;,.)>\"'!?])")
        borders = _vote(left & right, ~left & ~right)
        votes = reduce(lambda a, v: a * 3 + v, (regex, gazetteer, context, shape, borders))
        flags = [F.length(m) > 20, F.length(digits) > 10, m.rlike(r"[\x20()-]"), x["before"].rlike(r"[:=]\s*$"),
                 x["before"].rlike(r"[0-9]\s*$"), x["after"].rlike(r"^\s*[0-9]")]
        bits = reduce(lambda a, b: a + b, [f.cast("int") * (1 << i) for i, f in enumerate(flags)])
        return F.struct(kind.alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["base"].alias("base"),
                        votes.cast("int").alias("votes"), bits.cast("int").alias("flags"))

    return spans.withColumn("spans", with_context).select("id", F.transform("spans", mark).alias("spans"))


# ---------------------------------------------------------------- fit

def split_votes(code: int) -> list[int]:
    """-1, 0 or 1 per labeler."""
    out = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        out.append(v - 1)
    return out[::-1]


def expectation_maximisation(patterns: list[tuple[int, list[int], float]], rounds: int = 50):
    """(kind, votes, count) -> probability per pattern, and per labeler its (right yes, right no) reliabilities.

    Given the truth, labelers vote independently; abstaining says nothing. Yes-votes in the majority start
    the estimate. Reliabilities are smoothed and shared by the kinds, the share of true spans is not.
    """
    p = [1 / (1 + math.exp(-1.5 * sum(v))) for _, v, _ in patterns]
    rate = [(0.7, 0.7)] * len(LABELERS)
    for _ in range(rounds):
        rate = []
        for j in range(len(LABELERS)):
            yy = sum(c * q for (_, v, c), q in zip(patterns, p) if v[j] > 0)
            ny = sum(c * q for (_, v, c), q in zip(patterns, p) if v[j] < 0)
            nn = sum(c * (1 - q) for (_, v, c), q in zip(patterns, p) if v[j] < 0)
            yn = sum(c * (1 - q) for (_, v, c), q in zip(patterns, p) if v[j] > 0)
            rate.append(((yy + 4) / (yy + ny + 5), (nn + 4) / (nn + yn + 5)))
        prior = {}
        for k in {k for k, _, _ in patterns}:
            n = sum(c for kk, _, c in patterns if kk == k)
            prior[k] = (sum(c * q for (kk, _, c), q in zip(patterns, p) if kk == k) + 1) / (n + 2)
        p = []
        for k, v, _ in patterns:
            z = math.log(prior[k] / (1 - prior[k]))
            for j, x in enumerate(v):
                if x > 0:
                    z += math.log(rate[j][0] / (1 - rate[j][1]))
                elif x < 0:
                    z += math.log((1 - rate[j][0]) / rate[j][1])
            p.append(1 / (1 + math.exp(-max(-40, min(40, z)))))
    return p, rate


def _features(kind: int, votes: list[int], flags: int) -> list[float]:
    return [1.0, *[float(kind == k) for k in range(len(KINDS))], *[float(v > 0) for v in votes], *[float(v < 0) for v in votes],
            *[float(flags >> i & 1) for i in range(FLAGS)]]


def train(rows: list[tuple[int, int, int, int]], rounds: int = 300) -> list[float]:
    """Weights of the span classifier from (kind, votes, flags, count) rows, on the probabilities of the votes."""
    import numpy as np
    if not rows:
        return [0.0] * len(_features(0, [0] * len(LABELERS), 0))
    totals: dict[tuple[int, int], float] = {}
    for k, v, _, c in rows:
        totals[k, v] = totals.get((k, v), 0) + c
    keys = list(totals)
    p, _ = expectation_maximisation([(k, split_votes(v), totals[k, v]) for k, v in keys])
    truth = dict(zip(keys, p))
    x = np.array([_features(k, split_votes(v), f) for k, v, f, _ in rows])
    y = np.array([truth[k, v] for k, v, _, _ in rows])
    c = np.array([c for *_, c in rows], float)
    c /= c.sum()
    w = np.zeros(x.shape[1])
    for _ in range(rounds):   # Newton steps with a small ridge
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (c * (q - y)) + 1e-4 * w
        h = (x * (c * np.maximum(q * (1 - q), 1e-6))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def probability(x: Column, weights: list[float]) -> Column:
    """The span classifier as an expression over a labelled span."""
    it = iter(weights)
    z = F.lit(next(it))
    for k in range(len(KINDS)):
        z = z + F.when(x["kind"] == k, F.lit(next(it))).otherwise(F.lit(0.0))
    n = len(LABELERS)
    digit = lambda j: F.floor(x["votes"] / (3 ** (n - 1 - j))) % 3
    for value in (2, 0):
        for j in range(n):
            z = z + F.when(digit(j) == value, F.lit(next(it))).otherwise(F.lit(0.0))
    for i in range(FLAGS):
        z = z + F.when(F.shiftright(x["flags"], i).bitwiseAND(F.lit(1)) == 1, F.lit(next(it))).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


# ---------------------------------------------------------------- whole job

def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """id and ``spans``: array of struct(kind, s, e, base) by kind as listed, then start."""
    rows = written(labelled(spans_of(docs, id_col, text_col)))
    counts = rows.select(F.explode("spans").alias("x")).groupBy("x.kind", "x.votes", "x.flags").count()
    weights = train([tuple(r) for r in counts.orderBy("kind", "votes", "flags").collect()])
    kept = F.filter("spans", lambda x: x["base"] | (probability(x, weights) >= limit))
    return rows.select(F.col("id").alias(id_col), F.array_sort(F.transform(kept, lambda x: F.struct(
        x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["base"].alias("base")))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """Per document: id, n_<kind> of the base spans, base_sha256, spans (base and added)."""
    d = detect(docs, id_col, text_col, limit).withColumn("base", F.filter("spans", lambda x: x["base"]))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return d.select(id_col, *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                    F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
