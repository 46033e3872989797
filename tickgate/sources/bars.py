"""Bar scans (S4, S5, S11, S12) and the test adapters that derive bars from the driver tables.

Layout reads keep file order: ``with_file_order`` adds ``file_path`` and
``row_index`` from the Parquet reader's hidden ``_metadata`` column, which is
the only honest source of ingest order for check C.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickgate.config import LIT_VENUES, OHLCV_SCHEMA, QUARANTINE_PART
from tickgate.functions import keys as K
from tickgate.session import qualified

HIVE_PARTS = ("schema", "symbol", "venue_safe", "year_month")

# Test-adapter venues: user_id % 3 picks one of the first three lit venues.
ADAPTER_VENUES = LIT_VENUES[:3]


def with_file_order(df: DataFrame) -> DataFrame:
    """Add (file_path, row_index) from the scan metadata. Call right after the read."""
    return df.select("*", F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.row_index").alias("row_index"))


def _reader(spark: SparkSession, skip_unreadable: bool):
    """Columns are unioned across files (U1). Only callers that have probed the files, and so can
    name the unreadable ones, may skip them."""
    return spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", str(skip_unreadable).lower())


def read_flat(spark: SparkSession, data_dir: str, symbol: str | None = None,
              file_order: bool = True, skip_unreadable: bool = False) -> DataFrame:
    """Flat per-symbol files ``{SYMBOL}.parquet``; the symbol comes from the file name.

    Report files are excluded: non-Parquet files by the glob, and files whose
    name ends in ``_validation`` by a filter on the file name (F3); paths with
    a ``quarantine`` part are skipped (F2).
    """
    glob = f"{symbol}.parquet" if symbol else "*.parquet"
    df = _reader(spark, skip_unreadable).option("pathGlobFilter", glob).parquet(data_dir)
    df = with_file_order(df) if file_order else df.withColumn("file_path", F.col("_metadata.file_path"))
    name = F.regexp_extract(F.col("file_path"), r"([^/]+)\.parquet$", 1)
    keep = ~name.endswith("_validation") & ~F.array_contains(F.split(F.col("file_path"), "/"), QUARANTINE_PART)
    out = df.withColumn("symbol", name).where(keep)
    return out if file_order else out.drop("file_path")


def read_chunks(spark: SparkSession, root: str, schema: str = OHLCV_SCHEMA,
                symbol: str | None = None, file_order: bool = True,
                layout: str = "chunk", skip_unreadable: bool = False) -> DataFrame:
    """A recursive read of the chunk layout ``{root}/{schema}/{symbol}/{venue_safe}/{YYYY-MM}.parquet``.

    The key columns (schema, symbol, venue, year_month) are rebuilt from the path
    (P4, P3); paths with fewer than four parts under ``root`` are dropped, and so
    is any path with a ``quarantine`` part (F2). A ``symbol`` filter is applied
    to the listed path so it prunes files before any data is read (F1).

    ``layout='hive'`` reads a ``partitionBy(schema, symbol, venue_safe,
    year_month)`` tree instead, with partition pruning on the same filters.
    """
    if layout == "hive":
        base = f"{root.rstrip('/')}/schema={schema}"
        # data columns from the footers (no partition discovery), then the
        # partition columns typed as strings: with type inference a symbol such
        # as '00' would come back as the integer 0
        data = _reader(spark, skip_unreadable).option("recursiveFileLookup", "true").parquet(base).schema
        full = T.StructType([f for f in data.fields if f.name not in HIVE_PARTS]
                            + [T.StructField(c, T.StringType()) for c in HIVE_PARTS])
        df = spark.read.option("ignoreCorruptFiles", str(skip_unreadable).lower()).schema(full) \
            .option("basePath", root).parquet(base)
        df = with_file_order(df) if file_order else df
        df = df.withColumn("venue", K.venue_unsafe(F.col("venue_safe"))).drop("venue_safe")
        return df.where(F.col("symbol") == symbol) if symbol else df
    base = f"{root.rstrip('/')}/{schema}"
    pattern = f"{base}/{symbol}" if symbol else base
    df = (_reader(spark, skip_unreadable).option("recursiveFileLookup", "true")
          .option("pathGlobFilter", "*.parquet").parquet(pattern))
    df = with_file_order(df) if file_order else df.withColumn("file_path", F.col("_metadata.file_path"))
    rel = K.relpath_under(F.col("file_path"), qualified(spark, root))
    key = K.parse_chunk_relpath(rel)
    parts = F.split(rel, "/")
    no_quarantine = ~F.array_contains(parts, QUARANTINE_PART)
    out = (df.withColumn("_key", key)
           .where(F.col("_key").isNotNull() & no_quarantine)
           .withColumn("schema", F.col("_key.schema"))
           .withColumn("symbol", F.col("_key.symbol"))
           .withColumn("venue", F.col("_key.venue"))
           .withColumn("year_month", F.col("_key.year_month"))
           .drop("_key"))
    return out if file_order else out.drop("file_path")


def read_range(landing: DataFrame, symbol: str, venue: str, start: str, end: str,
               ts: str = "ts_event") -> DataFrame:
    """S11 (re-aimed): one chunk's rows from a landing frame, ``start`` inclusive, ``end`` exclusive."""
    return landing.where((F.col("symbol") == symbol) & (F.col("venue") == venue)
                         & (F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
                         & (F.col(ts) < F.lit(end).cast("timestamp_ntz")))


def read_published(spark: SparkSession, root: str, symbol: str, schema: str = OHLCV_SCHEMA) -> DataFrame:
    """A consumer's read of one published symbol, sorted by time."""
    return read_chunks(spark, root, schema, symbol=symbol, file_order=False).orderBy("ts_event")


# ---------------------------------------------------------------------------
# Test adapters: bars from the driver tables (not reference operators).
# ---------------------------------------------------------------------------

def bars_from_events(events: DataFrame, wide: bool = False, defects: bool = True) -> DataFrame:
    """Hourly OHLCV bars from ``events``.

    symbol = event_type (or 'U' || user_id when ``wide``); venue = one of three
    lit venues by user_id % 3; ts_event = the UTC hour of ``ts``; open/close =
    value of the first/last event_id; high/low = max/min(value); volume =
    sum(user_id % 10). With ``defects``, three deterministic faults are injected:
    signup prices x1000 (A), error open negated at 01 UTC (B, J), view
    high = low - 1 at 00 UTC (J).
    """
    ts = F.col("ts")
    hour = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))
    sym = F.concat(F.lit("U"), F.col("user_id").cast("string")) if wide else F.col("event_type")
    venues = F.array(*[F.lit(v) for v in ADAPTER_VENUES])
    venue = F.element_at(venues, (F.col("user_id") % 3 + 1).cast("int"))
    bars = (events.select(sym.alias("symbol"), venue.alias("venue"), hour.alias("ts_event"),
                          "event_id", "value", (F.col("user_id") % 10).alias("vol"))
            .groupBy("symbol", "venue", "ts_event")
            .agg(F.min_by("value", "event_id").alias("open"),
                 F.max("value").alias("high"),
                 F.min("value").alias("low"),
                 F.max_by("value", "event_id").alias("close"),
                 F.sum("vol").cast("bigint").alias("volume")))
    if not defects:
        return bars
    s, h = F.col("symbol"), F.hour("ts_event")
    x1000 = s == "signup"
    neg_open = (s == "error") & (h == 1)
    bad_high = (s == "view") & (h == 0)
    o = F.when(x1000, F.col("open") * 1000).when(neg_open, -F.col("open")).otherwise(F.col("open"))
    hi = (F.when(x1000, F.col("high") * 1000).when(bad_high, F.col("low") - 1)
          .otherwise(F.col("high")))
    lo = F.when(x1000, F.col("low") * 1000).otherwise(F.col("low"))
    cl = F.when(x1000, F.col("close") * 1000).otherwise(F.col("close"))
    return bars.select("symbol", "venue", "ts_event", o.alias("open"), hi.alias("high"),
                       lo.alias("low"), cl.alias("close"), "volume")


def trades_from_events(events: DataFrame) -> DataFrame:
    """A trade-shaped frame (for check D on the ``trades`` catalogue)."""
    venues = F.array(*[F.lit(v) for v in ADAPTER_VENUES])
    return events.select(
        F.col("ts").alias("ts_recv"), F.col("ts").alias("ts_event"),
        F.col("event_type").alias("symbol"),
        F.element_at(venues, (F.col("user_id") % 3 + 1).cast("int")).alias("venue"),
        F.col("value").alias("price"), (F.col("user_id") % 10).alias("size"))


def lineitem_daily(lineitem: DataFrame) -> DataFrame:
    """Daily (dv, v) per supplier from ``lineitem``: close = price / quantity, volume = quantity.

    The day is ``l_shipdate`` (already day-granular; no time-zone step)."""
    close = F.col("l_extendedprice") / F.col("l_quantity")
    vol = F.col("l_quantity")
    return (lineitem.select(F.col("l_suppkey").alias("symbol"),
                            F.to_date("l_shipdate").alias("et_date"),
                            (close * vol).alias("_dv"), vol.alias("_v"))
            .groupBy("symbol", "et_date")
            .agg(F.sum("_dv").alias("dv"), F.sum("_v").alias("v")))
