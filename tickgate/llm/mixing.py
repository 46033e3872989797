"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source size`` times. Within its source
documents are ordered by (size, id), their expected copies are summed up along that order,
one offset per source in [0, 1) is added, and a document is emitted once for each whole
number its stretch of the sum crosses. Ordering by size spreads the copies evenly over
short and long documents, so the words taken come near the target.

The expectation is the same for all documents of a source, so the prefix sum is
``expectation * rank``. The rank never needs one task per source: rows are ranked inside
(source, size, block of ids), and two small windows add the row counts of the blocks and
sizes before them. A source with a third of all rows, or a third of all rows with one size,
is spread over its blocks.

Defined cases: null text has size 0; null source is a source of its own, last in the order of
sources; an empty source has target 0; null ids come first within their size; rows that repeat
an id are documents of their own; an empty table gives an empty result. Reruns agree.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickgate.llm.common import WORD, written

ID_BLOCK = 4096       # ids per ranking block
WEIGHTS = (3, 1, 2)   # of the sources in code-point order, repeating
SHARE = 1.5           # of all words
CAP = 2.0             # times a source's size
SEED = "mix"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            cap: float = CAP) -> DataFrame:
    """Per source: source, source_size, target. ``sizes`` has columns source and size.

    Targets are weight times one level, cut at ``cap`` times the source's size. Sources sorted
    by size per weight are cut first, so the level follows from the first source that is not cut.
    The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ws = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("w", F.element_at(
        ws, ((F.row_number().over(order) - 1) % F.lit(len(weights)) + 1).cast("int")))
    cut = F.col("source_size") * F.lit(float(cap))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) * F.lit(float(share))
             - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(cap))) / F.sum("w").over(rest)
    per = per.withColumn("level", level)
    # A level is right from the first source that it does not fill; later sources' own levels count
    # sources as cut that are not, and are smaller. So the largest level that fits is the final one.
    final = F.max(F.when(F.col("level") * F.col("w") <= cut, F.col("level"))).over(every)
    return per.select("source", "source_size",
                      F.coalesce(F.least(final * F.col("w"), cut), cut).cast("double").alias("target"))


def offset(source: Column, seed: str = SEED) -> Column:
    """The source's offset in [0, 1): 52 bits of an MD5."""
    h = F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit(":"), source), F.lit(""))).cast("binary"))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP,
         seed: str = SEED) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken."""
    rows = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                               size_of(F.col(text_col)).alias("size")))
    per = written(targets(rows, weights, share, cap).withColumn("u", offset(F.col("source"), seed)))
    rows = rows.withColumn("block", F.floor(F.col("id") / F.lit(ID_BLOCK)))
    counts = rows.groupBy("source", "size", "block").agg(F.count("*").alias("n"))
    by_size = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    prior = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    by_size = by_size.select("source", "size", F.coalesce(F.sum("n").over(prior), F.lit(0)).alias("of_sizes"))
    within = Window.partitionBy("source", "size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("of_blocks", F.coalesce(F.sum("n").over(within), F.lit(0)))
    same = lambda a, b, keys: [a[k].eqNullSafe(b[k]) for k in keys]
    starts = written(starts.join(by_size, same(starts, by_size, ("source", "size")), "inner").select(
        starts["source"], starts["size"], starts["block"],
        (F.col("of_sizes") + F.col("of_blocks")).alias("start")))
    ranked = rows.withColumn("k", F.row_number().over(
        Window.partitionBy("source", "size", "block").orderBy("id")) - 1)
    out = ranked.join(starts, same(ranked, starts, ("source", "size", "block")), "inner").select(
        ranked["id"], ranked["source"], ranked["size"], (F.col("start") + F.col("k")).alias("rank"))
    out = out.join(per, same(out, per, ("source",)), "inner").drop(per["source"])
    e = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    stop = F.floor(e * (F.col("rank") + 1) + F.col("u"))
    copies = F.least(stop - F.floor(e * F.col("rank") + F.col("u")), F.ceil(e))
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size",
                      "target", copies.cast("long").alias("copies"),
                      (copies * F.col("size")).cast("long").alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP,
        seed: str = SEED) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it.

    Ids must identify rows here; of rows that repeat an id, each takes the largest number of copies
    that the id was given.
    """
    p = plan(docs, id_col, text_col, source_col, weights, share, cap, seed)
    p = p.groupBy(F.col(id_col).alias("__id")).agg(F.max("copies").cast("int").alias("__copies")) \
        .where("__copies > 0")
    return (docs.join(p, docs[id_col].eqNullSafe(p["__id"]), "inner")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select(*docs.columns))
