"""Small helpers shared by the operators: reading tables, word pattern, written intermediates."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickgate.session import ship_package, write_table

# A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]++"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of ``sf_dir``; any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    Used for narrow intermediates that several branches read: the wide scan is
    done once, and a lost executor costs only a re-read.
    """
    return write_table(df)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ready(spark: SparkSession) -> None:
    """Before Python tasks start: executors can import this package, and batches are small.

    A task holds a batch several times over (JVM buffers, the worker's copy, what it makes of it), so batches
    of 8 MiB, not the default of 64, keep long texts from adding up. A session's own setting is left alone.
    """
    ship_package(spark)
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(8 << 20))


FILTER_BITS = 27     # a filter of ids has 2 ** FILTER_BITS bits at most, in words of 64: 32 MiB as broadcast rows


def parted(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str = "id") -> tuple[DataFrame, DataFrame]:
    """``rows`` whose key is none of the distinct keys ``wanted``, and those that may be; nothing shuffles.

    A filter of the hashes of the wanted keys, whose size has a fixed bound, is broadcast; a row that misses it is no
    match. The filter's size changes how many rows hit by accident, never that a match hits.
    """
    bits = max(12, min(FILTER_BITS, (wanted.count() * 16).bit_length()))
    place = lambda c: F.shiftrightunsigned(F.xxhash64(c), 64 - bits)
    bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))
    word = lambda p: F.shiftright(p, 6).cast("int")
    at = place(F.col(wanted_key))
    words = written(wanted.select(word(at).alias("__word"), bit(at).alias("__bit"))
                    .groupBy("__word").agg(F.bit_or("__bit").alias("__bits")))
    here = place(F.col(key))
    tested = rows.withColumn("__word", word(here)).join(F.broadcast(words), "__word", "left").withColumn(
        "__hit", F.coalesce(F.col("__bits").bitwiseAND(bit(here)) != 0, F.lit(False)))
    return tested.where("NOT __hit").select(*rows.columns), tested.where("__hit").select(*rows.columns)


def narrowed(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str = "id", anti: bool = False,
             exact: bool = True) -> DataFrame:
    """Semi-join (or anti-join) of wide ``rows`` with the distinct ids ``wanted``, shuffling few of them.

    Rows that miss the filter of ``parted`` pass (or go) where they are. Only rows that hit meet the ids in a join.
    Without ``exact`` the few rows that hit by accident stay, for a caller that joins with the ids anyway.
    """
    missed, hits = parted(rows, key, wanted, wanted_key)
    if not exact and not anti:
        return hits
    ids = wanted.select(F.col(wanted_key).alias("__wanted"))
    found = hits.join(ids, hits[key].eqNullSafe(ids["__wanted"]), "left_anti" if anti else "left_semi")
    return missed.unionByName(found) if anti else found
