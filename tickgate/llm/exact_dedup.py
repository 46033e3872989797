"""Exact dedup by two-pass Bloom filtering; DataFrame functions only.

Pass 1 reads each text once and keeps a narrow row (id, SHA-256). Every hash sets one bit of a filter, and the bits
meet as bits of the input's slices (one a task of pass 1), not as rows: a task packs, for each chunk of the filter, the
distinct bits that its slice sets and, for each ``PARTS``-th of the chunk, how many rows set them. A bit is *possibly
repeated* if two slices set it, or if more rows of one slice than bits fell into its part of the chunk, since then
some bit there was set twice. So any hash that occurs twice is found, whatever the slices are, and a hash that a third
of all rows share is one bit a slice.
Pass 2 tests each row against the possibly repeated bits. Rows that miss are unique and pass straight through; only
rows that hit shuffle, on their full hash, so a false hit costs a shuffled narrow row and never a wrong answer.

The filter has ``BITS_A_ROW`` bits a row and at most ``2 ** max_block_bits`` words of 64 whatever the input
(broadcast as 32 MiB of rows at the default). A fuller filter lets more rows into the shuffle; results do not depend
on its size.

Defined cases: null text counts as the empty text and equals it; of equal texts the row
with the largest id stays, null ids lose to any other; if all ids of a group are null,
keep_id is null and all its rows stay; rows that repeat id and text are one document and
get the same answer; an empty table gives an empty result; other columns are not touched.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickgate.llm.common import text_or_empty, written

BITS_A_ROW = 32
CHUNK = 15       # a chunk has 2 ** CHUNK bits, whose numbers take two bytes each
PARTS = 8


def _digest(text_col: str) -> Column:
    return F.unhex(F.sha2(text_or_empty(text_col).cast("binary"), 256))


def _bit(digest: Column, block_bits: int) -> Column:
    """The filter's bit of a digest, of 64 * 2 ** block_bits."""
    return F.shiftrightunsigned(F.xxhash64(digest), 64 - 6 - block_bits)


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))


def _block_bits(rows: int, max_block_bits: int) -> int:
    return max(CHUNK - 6, min(max_block_bits, math.ceil(math.log2(max(1, rows) * BITS_A_ROW / 64 + 1))))


def possibly_repeated(rows: DataFrame, digest: str, block_bits: int) -> DataFrame:
    """(__block, __bits): the words of the bits that two rows may share, written."""
    bit = F.col("bit")
    set_ = rows.select(F.spark_partition_id().alias("slice"), _bit(F.col(digest), block_bits).alias("bit")).select(
        "slice", F.shiftright(bit, CHUNK).cast("int").alias("chunk"), bit.bitwiseAND(F.lit((1 << CHUNK) - 1)).cast("short").alias("bit"))
    part = F.floor(F.col("bit") / ((1 << CHUNK) // PARTS))
    packed = set_.withColumn("part", part).groupBy("slice", "chunk").agg(
        *[F.collect_set(F.when(F.col("part") == i, F.col("bit"))).alias(f"s{i}") for i in range(PARTS)],
        *[F.count_if(F.col("part") == i).alias(f"n{i}") for i in range(PARTS)])
    twice_here = [F.when(F.col(f"n{i}") > F.size(f"s{i}"), F.col(f"s{i}")).otherwise(F.array().cast("array<smallint>")) for i in range(PARTS)]
    met = packed.select("chunk", F.concat(*[F.col(f"s{i}") for i in range(PARTS)]).alias("once"), F.concat(*twice_here).alias("twice")) \
        .groupBy("chunk").agg(F.sort_array(F.flatten(F.collect_list("once"))).alias("once"), F.flatten(F.collect_list("twice")).alias("twice"))
    # a slice's bits are distinct, so an equal neighbour comes from another slice
    among = F.filter("once", lambda x, i: (i > 0) & (F.get("once", i - 1) == x))
    found = met.select("chunk", F.explode(F.array_distinct(F.concat(among, "twice"))).alias("bit"))
    word = F.shiftleft(F.col("chunk"), CHUNK - 6).bitwiseOR(F.shiftright(F.col("bit").cast("int"), 6)).cast("long")
    return written(found.groupBy(word.alias("__block")).agg(F.bit_or(_mask(F.col("bit").cast("long"))).alias("__bits")))


def _route(rows: DataFrame, digest: str, bloom: DataFrame, block_bits: int) -> DataFrame:
    """Add ``__hit``: whether the row's hash is possibly repeated."""
    bit = _bit(F.col(digest), block_bits)
    return (
        rows.withColumns({"__block": F.shiftright(bit, 6), "__mask": _mask(bit)})
        .join(F.broadcast(bloom), "__block", "left")
        .withColumn("__hit", F.coalesce(F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask"),
                                        F.lit(False)))
        .drop("__block", "__mask", "__bits")
    )


class _Plan:
    """The written narrow rows, the filter, and the groups of at least two equal texts."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, max_block_bits: int):
        self.rows = written(docs.select(F.col(id_col).alias("__id"), _digest(text_col).alias("__sha")))
        self.block_bits = _block_bits(self.rows.count(), max_block_bits)
        self.bloom = possibly_repeated(self.rows, "__sha", self.block_bits)
        self.routed = _route(self.rows, "__sha", self.bloom, self.block_bits)
        # partial aggregation keeps a hot group to one row per task; written, so that the join
        # below reads plain shuffles, which Spark splits when one group is hot
        self.groups = written(
            self.routed.where("__hit").groupBy("__sha")
            .agg(F.max("__id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"))

    def decisions(self) -> DataFrame:
        one = F.lit(1).cast("long")
        alone = self.routed.where("NOT __hit").select("__id", "__sha", F.col("__id").alias("keep_id"),
                                                      one.alias("group_size"))
        hits = (
            self.routed.where("__hit").join(self.groups, "__sha", "left")
            .select("__id", "__sha",
                    F.when(F.col("group_size").isNull(), F.col("__id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", one).alias("group_size"))
        )
        return alone.unionByName(hits).withColumn("kept", F.col("__id").eqNullSafe(F.col("keep_id")))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           max_block_bits: int = 21) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    d = _Plan(docs, id_col, text_col, max_block_bits).decisions()
    return d.select(F.col("__id").alias(id_col), "keep_id", "group_size", "kept",
                    F.lower(F.hex("__sha")).alias("text_sha256"))


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  max_block_bits: int = 21) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Texts of rows that miss the filter are not shuffled; the others meet the ids that
    stay in a join on the id, which no group of copies can make hot.
    """
    p = _Plan(docs, id_col, text_col, max_block_bits)
    stay = p.decisions().where("kept AND group_size > 1").select(
        F.col("__id").alias("__stay_id"), F.col("__sha").alias("__stay_sha")).distinct()
    again = p.groups.select(F.col("__sha").alias("__rep_sha"))
    rows = _route(docs.withColumn("__sha", _digest(text_col)), "__sha", p.bloom, p.block_bits)
    alone = rows.where("NOT __hit")
    hits = rows.where("__hit")
    false_hits = hits.join(again, hits["__sha"] == again["__rep_sha"], "left_anti")
    chosen = hits.join(stay, (hits["__sha"] == stay["__stay_sha"])
                       & hits[id_col].eqNullSafe(stay["__stay_id"]), "left_semi")
    return alone.select(*docs.columns).unionByName(false_hits.select(*docs.columns)) \
        .unionByName(chosen.select(*docs.columns))
