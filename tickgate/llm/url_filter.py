"""URL filter: domain rules first, then a logistic regression on hashed character n-grams.

Host and path are cut into character n-grams, each hashed with its field's name to one of ``DIM``
weights. The weights are fitted on a small labelled table of URLs by the same Spark expression that
scores the pages, and travel as one array literal, so scoring is a projection: no shuffle, no join.
The labelled table is collected to the driver for the fit; ``max_labelled`` bounds it.

Defined cases: a null url, or one without ``://``, has an empty host and path; the empty host is
scored like any other; rules match by code point; among rules of equal length the first wins; extra
columns are ignored; an empty table gives an empty result; an empty labelled table gives weights 0
and so a score of 0.5, which allows at the default limit.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAMS = (3, 4)
DIM = 4096
LIMIT = 0.6          # scores above block: a page is kept unless it is clearly unwanted
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))

# Fixed word lists for the labelled table: words of unwanted host names, of ordinary ones, and words that go with either.
UNWANTED = ("casino poker slots jackpot roulette blackjack baccarat betting bets bookie wager gamble gambling lottery lotto bingo "
            "viagra cialis pharma pills pill meds steroid tramadol xanax slimming weightloss botox "
            "porn porno xxx xxxtube xxxcams xxxmovies xxxpics sex sexy nude nudes escort escorts erotic milf camgirl "
            "camgirls hookup adult fetish hentai "
            "spam spammer phish phishing malware virus trojan warez crack cracks keygen serials torrent pirated hack hacks "
            "cheat cheats scam fake counterfeit replica knockoff "
            "payday loan loans credit forex crypto bitcoin doubler ponzi millionaire getrich cashback prize prizes winner win "
            "giveaway freebie coupon clickbait adserver adserv ads adtrack tracker tracking popup popunder banner banners "
            "redirect doorway linkfarm backlinks seo traffic clicks botnet proxy cheap discount free bonus cash money").split()
ORDINARY = ("news times herald tribune gazette library museum archive garden weather science physics chemistry biology history "
            "geography school college university campus faculty kitchen recipes cooking bakery travel hotel trains railway airport "
            "music concert orchestra theatre cinema film books reader journal letters poetry council city village river mountain "
            "forest ocean harbor bridge market baker farmer doctor clinic hospital health nursing sport football tennis running "
            "bicycle hiking wiki docs manual python linux kernel forum notes photo gallery art studio design paper press radio "
            "family wedding pets birds horse gardenclub church parish temple mosque synagogue charity trust foundation institute "
            "research academy society union office court justice police fire rescue energy water solar wind steel stone wood glass "
            "cotton fashion tailor furniture house home kitchenware toys games chess bridgeclub puzzle planet space stars moon "
            "verein schule haus garten stadt maison ecole lettres jardin ville casa escuela libro ciudad camino").split()
EITHER = ("best top online my the go get world pro club zone hub net24 365 live now today plus max box shop store site web "
          "portal center group team king star royal gold super mega direct express video videos forum page guide").split()


def invented_names() -> list[str]:
    """Pronounceable names that are no words, by rule: two or three syllables of a consonant and a vowel."""
    parts = [c + v for c in "bdfgklmnprstvz" for v in "aeiou"]
    return [parts[i] + parts[(i * 37 + 11) % 70] + (parts[(i * 53 + 29) % 70] if i % 2 else "") + ("n", "r", "s", "")[i % 4]
            for i in range(70)] + [parts[(i * 31 + 7) % 70] + parts[(i * 17 + 3) % 70] + "l" for i in range(70)]


def labelled_names() -> list[tuple[str, int]]:
    """(host name, label): words alone, two of a kind, and with words that go with either; 1 is unwanted."""
    out = []
    for label, words in ((1, UNWANTED), (0, ORDINARY), (0, invented_names())):
        n = len(words)
        for i, w in enumerate(words):
            other, e, f = words[(i * 7 + 3) % n], EITHER[i % len(EITHER)], EITHER[(i * 5 + 2) % len(EITHER)]
            out += [(x, label) for x in (w, f"{e}{w}", f"{w}-{f}", f"{w}{other}", f"{other}-{w}", f"{f}-{w}-{i * 7 % 90}")]
    return out


def labelled_urls(names: Sequence[tuple[str, int]] | None = None) -> list[tuple[str, int]]:
    """(url, label) of each name, set in the same frames whatever its label, so frames carry no signal."""
    subs = ("", "www.", "blog.", "m.", "shop.")
    tlds = ("com", "net", "org", "info", "co.uk", "de", "fr", "example.com", "example.net")
    tails = ("/", "", "/index.html", "/a/b/{}", "/page/{}", "/{}.html", "/articles/{}/", "/en/{}")
    out = []
    for i, (name, label) in enumerate(labelled_names() if names is None else names):
        for k in range(2):
            tail = tails[(i * 5 + k * 3) % 8].format((i * 389 + k * 173) % 1000)
            out.append((f"https://{subs[(i + k * 2) % 5]}{name}.{tlds[(i * 4 + k * 5) % 9]}{tail}", label))
    return out


def host_of(url: Column) -> Column:
    rest = _rest(url)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, upper.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + F.lit(3))), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one. Tested longest first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ordered = sorted(enumerate(rules), key=lambda r: (-len(r[1][1] + r[1][2]), r[0]))
    for _, (kind, h, p) in reversed(ordered):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column, sizes: Sequence[int] = GRAMS, dim: int = DIM) -> Column:
    """Weight numbers of all n-grams of ``^host$`` and of the path."""
    def cut(field: str, text: Column, n: int) -> Column:
        last = F.length(text) - (n - 1)
        weight = lambda i: F.pmod(F.xxhash64(F.lit(field), F.substr(text, i, F.lit(n))), F.lit(dim)).cast("int")
        found = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), weight)
        return F.when(last >= 1, found).otherwise(F.array().cast("array<int>"))

    parts = [cut(field, text, n) for field, text in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", path))
             for n in sizes]
    return F.concat(*parts)


def fit(spark: SparkSession, labelled: Sequence[tuple[str, int]], l2: float = 3e-5, rounds: int = 800,
        max_labelled: int = 20_000) -> tuple[list[float], float]:
    """Weights and bias. Full-batch gradient descent with momentum on length-scaled counts; classes weigh the same."""
    import numpy as np
    if len(labelled) > max_labelled:
        raise ValueError(f"{len(labelled)} labelled urls; max_labelled is {max_labelled}")
    if not labelled:
        return [0.0] * DIM, 0.0
    df = spark.createDataFrame([(u, int(y)) for u, y in labelled], "url string, label int")
    rows = df.select(grams(host_of(F.col("url")), path_of(F.col("url"))).alias("g"), "label").collect()
    # counts as (row, weight number, value), which is all the memory that the fit takes
    at = np.repeat(np.arange(len(rows)), [len(r.g) for r in rows])
    gram = np.concatenate([np.empty(0, np.int64), *[np.array(r.g, np.int64) for r in rows]]).astype(np.int64)
    value = 1 / np.sqrt(np.maximum(np.bincount(at, minlength=len(rows)), 1.0))[at]
    y = np.array([r.label for r in rows], float)
    c = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    w, b, vw, vb = np.zeros(DIM), 0.0, np.zeros(DIM), 0.0
    for _ in range(rounds):
        z = np.bincount(at, w[gram] * value, minlength=len(rows)) + b
        g = c * (1 / (1 + np.exp(-z)) - y) / len(y)
        vw, vb = 0.9 * vw - 6.0 * (np.bincount(gram, g[at] * value, minlength=DIM) + l2 * w), 0.9 * vb - 6.0 * g.sum()
        w, b = w + vw, b + vb
    return [float(v) for v in w], float(b)


def score(host: Column, path: Column, model: tuple[list[float], float]) -> Column:
    """Probability that the URL is unwanted."""
    weights, bias = model
    g = grams(host, path)
    w = F.lit(weights)
    z = F.aggregate(g, F.lit(0.0), lambda a, i: a + F.get(w, i))
    z = z / F.sqrt(F.greatest(F.size(g), F.lit(1)).cast("double")) + F.lit(bias)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
          rules: Sequence[tuple[str, str, str]] = RULES, labelled: Sequence[tuple[str, int]] | None = None,
          limit: float = LIMIT) -> DataFrame:
    """Per row: id, host, path, rule, score, verdict."""
    model = fit(pages.sparkSession, labelled_urls() if labelled is None else labelled)
    host, path = F.col("host"), F.col("path")
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    rule, verdict = rule_for(host, path, rules)
    rows = rows.select("id", "host", "path", rule.alias("rule"), verdict.alias("ruled"),
                       score(host, path, model).alias("score"))
    return rows.select(F.col("id").alias(id_col), "host", "path", "rule", "score", F.coalesce(
        "ruled", F.when(F.col("score") > limit, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
