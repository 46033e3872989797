"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Statistics: one Arrow pass over whole texts gives a short array of numbers per document.
2. Rules: shallow boosted trees are grown on labelled rows; every path from a root to a node is a
   conjunction of comparisons.
3. Weights: an L1-penalised logistic regression over the rules' 0/1 values drops most of them.
4. Scoring: what is left is compiled into one Spark column expression over the statistics.

The fit runs on the driver on at most ``MAX_TRAIN`` labelled rows (those with the smallest hash of
their id), a few numbers each. Rows with crc32(id as text) mod 5 = 0 are held out and never seen by it.
Both classes weigh the same in the fit, so a score of 0.5 means that nothing speaks for either.

Defined cases: null text is the empty text, whose statistics are all 0; rows with a null id are
held out; null labels are skipped; if a document has several labels, all count; without labels of
both classes every score is the share of label 1, or 0.5 without labels; rows that repeat an id are
scored one by one; extra columns are kept by ``classify`` and ignored by ``score``; an empty table
gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tickgate.llm.common import ready, written

LIMIT = 0.3
MAX_TRAIN = 20_000
FOLDS = 5
TREES, DEPTH, BINS = 24, 3, 32
L1 = 2e-3

# Shares are of bytes, words or lines. Variety is log(distinct words) / log(words), which hardly depends on length.
STATS = ("log_bytes", "words_per_line", "word_bytes", "upper", "digits", "non_ascii", "bangs_per_word", "bars_per_word",
         "symbols_per_word", "stops_per_word", "commas_per_word", "same_as_last_word", "variety", "repeated_lines",
         "long_words", "alone_marks")


def _byte_classes():
    import numpy as np
    table = np.zeros(256, np.uint8)
    for k, chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"!", b"|",
                               b"#$%&*+<=>@\\^_`~{}[]", b".?:;", b",")):
        table[list(chars)] = k + 1
    table[128:] = 9
    return table


def statistics(text: bytes, table) -> list[float]:
    """STATS of one UTF-8 text."""
    import math
    import operator

    import numpy as np
    if not text:
        return [0.0] * len(STATS)
    c = np.bincount(table[np.frombuffer(text, np.uint8)], minlength=10)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n, m, letters = max(1, len(words)), max(1, len(lines)), max(1, int(c[1] + c[2] + c[9]))
    same = sum(map(operator.eq, words, words[1:]))
    sizes = list(map(len, words))
    return [
        math.log1p(len(text)), len(words) / m, sum(sizes) / n, c[1] / letters, c[3] / len(text), c[9] / len(text), c[4] / n,
        c[5] / n, c[6] / n, c[7] / n, c[8] / n, same / n, math.log(len(set(words)) + 1) / math.log(n + 1), 1 - len(set(lines)) / m if lines else 0.0,
        sum(s > 24 for s in sizes) / n, sizes.count(1) / n,
    ]


def with_statistics(docs: DataFrame, text_col: str = "text", out: str = "stats", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the array of statistics of every whole text."""
    ready(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    # a text that is kept anyway travels once
    sent = list(dict.fromkeys([*keep, text_col]))
    src, at = docs.select(*sent), sent.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        table = _byte_classes()
        for batch in batches:
            found = [statistics(b"" if t.as_py() is None else t.as_py().encode(), table) for t in batch.column(at)]
            stats = pa.array([[float(v) for v in row] for row in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], stats], names=[*keep, out])

    schema = StructType([*[src.schema[c] for c in keep], StructField(out, ArrayType(DoubleType()))])
    return src.mapInArrow(run, schema)


# ---------------------------------------------------------------- rules

Rule = tuple[tuple[int, bool, float], ...]   # (statistic, above, threshold), all must hold


@dataclass
class Model:
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0

    def column(self, stats: Column) -> Column:
        """The score as an expression over the array of statistics."""
        z = F.lit(float(self.bias))
        for rule, w in zip(self.rules, self.weights):
            tests = [(F.get(stats, F.lit(k)) > F.lit(t)) if above else (F.get(stats, F.lit(k)) <= F.lit(t)) for k, above, t in rule]
            z = z + F.when(reduce(lambda a, b: a & b, tests), F.lit(float(w))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def describe(self) -> list[str]:
        return [f"{w:+.3f} if " + " and ".join(f"{STATS[k]} {'>' if above else '<='} {t:.4g}" for k, above, t in rule)
                for rule, w in zip(self.rules, self.weights)]


def _cuts(x) -> list:
    """Per statistic, thresholds half-way between neighbouring quantiles."""
    import numpy as np
    out = []
    for k in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS), method="nearest"))
        out.append((q[:-1] + q[1:]) / 2)
    return out


def grow_rules(x, y, weight) -> list[Rule]:
    """Paths of boosted trees on the logistic loss."""
    import numpy as np
    cuts = _cuts(x)
    bins = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], 1)
    z, found = np.zeros(len(y)), {}

    def split(rows, g, h):
        best, gs, hs = (1e-6, None, None), g[rows].sum(), h[rows].sum()
        for k, c in enumerate(cuts):
            if not len(c):
                continue
            gl = np.cumsum(np.bincount(bins[rows, k], g[rows], len(c) + 1))[:-1]
            hl = np.cumsum(np.bincount(bins[rows, k], h[rows], len(c) + 1))[:-1]
            gain = gl ** 2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs ** 2 / (hs + 1)
            gain[(hl < 1e-3) | (hs - hl < 1e-3)] = 0
            j = int(gain.argmax())
            if gain[j] > best[0]:
                best = (gain[j], k, j)
        return best[1:]

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (y - p), weight * p * (1 - p)
        todo = [((), np.arange(len(y)))]
        while todo:
            path, rows = todo.pop()
            k, j = split(rows, g, h) if len(path) < DEPTH else (None, None)
            if k is None:
                z[rows] += 0.4 * g[rows].sum() / (h[rows].sum() + 1)
                continue
            low = bins[rows, k] <= j
            for above, part in ((False, rows[low]), (True, rows[~low])):
                rule = (*path, (k, above, float(cuts[k][j])))
                found.setdefault(tuple(sorted(rule)), None)
                todo.append((rule, part))
    return list(found)


def holds(rules: list[Rule], x):
    import numpy as np
    out = np.ones((len(x), len(rules)))
    for r, rule in enumerate(rules):
        for k, above, t in rule:
            out[:, r] *= (x[:, k] > t) if above else (x[:, k] <= t)
    return out


def lasso(a, y, weight, l1: float = L1, rounds: int = 400):
    """Weights and bias of an L1-penalised logistic regression (accelerated proximal gradient)."""
    import numpy as np
    n = len(y)
    full = np.column_stack([a, np.ones(n)])
    step = 4.0 / max(np.linalg.norm(full * np.sqrt(weight / n)[:, None], 2) ** 2, 1e-12)
    w = v = np.zeros(full.shape[1])
    t = 1.0
    for _ in range(rounds):
        grad = full.T @ (weight * (1 / (1 + np.exp(-np.clip(full @ v, -40, 40))) - y)) / n
        u = v - step * grad
        u[:-1] = np.sign(u[:-1]) * np.maximum(np.abs(u[:-1]) - step * l1, 0)
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = u + (t - 1) / s * (u - w), u, s
    return w[:-1], float(w[-1])


def fit_arrays(x, y) -> Model:
    import numpy as np
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()), 1e-6), 1 - 1e-6) if len(y) else 0.5
        return Model(bias=float(np.log(share / (1 - share))))
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    rules = grow_rules(x, y, weight)
    w, b = lasso(holds(rules, x), y, weight)
    used = [i for i in range(len(rules)) if abs(w[i]) > 1e-6]
    return Model([rules[i] for i in used], [float(w[i]) for i in used], b)


# ---------------------------------------------------------------- Spark

def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        max_train: int = MAX_TRAIN) -> Model:
    """Fit on the rows of ``stats`` (id, stats) that have a label and are not held out."""
    import numpy as np
    y = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("__y")) \
        .where("__y IS NOT NULL").where(~held_out(F.col("__id")))
    share = min(1.0, max_train / max(1, y.count()))   # of the labelled ids; so tasks send few rows between them
    spread = F.shiftrightunsigned(F.xxhash64("__id"), 11) / F.lit(float(1 << 53))
    rows = stats.select(F.col(id_col).alias("__id"), "stats").join(y.where(spread < share), "__id") \
        .orderBy(spread, "__id", "__y").limit(max_train).select("stats", "__y").collect()
    return fit_arrays(np.array([r[0] for r in rows]).reshape(len(rows), len(STATS)), np.array([r[1] for r in rows], float))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", limit: float = LIMIT, max_train: int = MAX_TRAIN) -> DataFrame:
    """Per document: id, held_out, score, predicted."""
    stats = written(with_statistics(docs, text_col, "stats", [id_col]))
    model = fit(stats, labels, id_col, label_col, max_train)
    s = stats.select(id_col, held_out(F.col(id_col)).alias("held_out"), model.column(F.col("stats")).alias("score"))
    return s.withColumn("predicted", (F.col("score") >= limit).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` with all its columns and ``__score``. No text is shuffled: the fit reads a narrow table of statistics."""
    stats = written(with_statistics(docs, text_col, "stats", [id_col]))
    model = fit(stats, labels, id_col, label_col, max_train)
    rows = with_statistics(docs, text_col, "__stats")
    return rows.withColumn("__score", model.column(F.col("__stats"))).drop("__stats")


def keep_good(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, **names) -> DataFrame:
    """The rows of ``docs`` that score at least ``limit``."""
    return classify(docs, labels, **names).where(F.col("__score") >= limit).drop("__score")
