"""Connected components of a table of links, by alternating large and small stars.

Each round replaces links so that every document points at a smaller one; the table never grows, all
work is aggregation and joins on narrow rows, and each round is written to the shared folder. The
number of rounds is logarithmic in the longest chain.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickgate.llm.common import written


def _large(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(low, "u")
    return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (columns a, b); component is the smallest id reachable."""
    e = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        e = written(_small(_large(e)))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
