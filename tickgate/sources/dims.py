"""Dimensions: universe (S1), schema -> venues (S2), estimates.

The venue dimension and catalogues are fixed configuration (19 venues, three
schemas): their size is bounded by the config, so they may be broadcast or
inlined as literal arrays.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickgate import config as cfg


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """One symbol per non-blank trimmed line; an absent file gives an empty universe, any other error is raised."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "symbol string")
    return lines.select(F.trim("value").alias("symbol")).where(F.col("symbol") != "")


def universe_from(df: DataFrame, col: str = "symbol") -> DataFrame:
    """Distinct symbols of a frame (the universe seen in landed data)."""
    return df.select(F.col(col).cast("string").alias("symbol")).where(F.col("symbol").isNotNull()).distinct()


def venue_array(schema: str, venues=None) -> Column:
    """The venues of one schema as a literal array<struct<venue, earliest_start>>.

    Used to expand the plan per symbol with ``explode`` instead of a join.
    """
    venues = venues or cfg.SCHEMA_VENUES.get(schema, cfg.LIT_VENUES)
    return F.array(*[
        F.struct(F.lit(v).alias("venue"),
                 F.lit(cfg.VENUE_EARLIEST_START.get(v)).cast("string").alias("earliest_start"))
        for v in venues])


def mode_schemas(mode: str) -> tuple[str, ...]:
    """lit / ats / ohlcv / all -> schemas (anything else means all)."""
    return cfg.MODE_SCHEMAS.get(mode, cfg.MODE_SCHEMAS["all"])


def estimates_dim(spark: SparkSession) -> DataFrame:
    rows = [(s, cfg.ESTIMATE_RECORDS_PER_CHUNK[s], cfg.ESTIMATE_MB_PER_CHUNK[s], cfg.ESTIMATE_USD_PER_GB[s])
            for s in cfg.ESTIMATE_RECORDS_PER_CHUNK]
    return spark.createDataFrame(rows, "schema string, records_per_chunk bigint, mb_per_chunk double, "
                                       "usd_per_gb double")
