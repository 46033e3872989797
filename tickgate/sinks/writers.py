"""Sinks (K1-K4, K6-K10).

Every write sets its overwrite mode explicitly. Partitioned overwrites use
``partitionOverwriteMode=dynamic`` so only the partitions present in the
written frame are replaced (a static overwrite of a tree that is also being
read would delete it first).
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickgate.config import PARQUET_COMPRESSION, PARQUET_ROW_GROUP, WAREHOUSE_FIELDS
from tickgate.functions import keys as K
from tickgate.session import ensure_checkpoint_dir, qualified, ship_package
from tickgate.sinks.chunk_source import KEY, LEDGER_SCHEMA, ChunkSource

def _parquet(writer, row_group: int = PARQUET_ROW_GROUP):
    return (writer.option("compression", PARQUET_COMPRESSION)
            .option("parquet.block.row.count.limit", str(row_group)))


def write_chunks(df: DataFrame, root: str, mode: str = "overwrite", ts: str = "ts_event") -> None:
    """K1/K3: Hive-partitioned chunk layout ``schema=/symbol=/venue_safe=/year_month=``.

    Rows are clustered by chunk and sorted by time inside each file. Only the
    chunks present in ``df`` are replaced. The ``rebalance`` hint clusters by
    chunk while letting AQE split an oversized chunk over several tasks (and
    files) and merge tiny ones, so a hot chunk is never written by one task.
    """
    out = df
    if "year_month" not in out.columns:
        out = out.withColumn("year_month", K.year_month_of(F.col(ts)))
    out = out.withColumn("venue_safe", K.venue_safe(F.col("venue"))).drop("venue")
    parts = ["schema", "symbol", "venue_safe", "year_month"]
    out = out.hint("rebalance", *parts).sortWithinPartitions(*parts, ts)
    w = (out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*parts))
    _parquet(w).parquet(root)


def write_chunk_files(df: DataFrame, root: str, ts: str = "ts_event",
                      row_group: int = PARQUET_ROW_GROUP) -> DataFrame:
    """K1/K3 in the exact per-chunk layout ``{root}/{schema}/{symbol}/{venue_safe}/{YYYY-MM}.parquet``.

    Each chunk is hashed to one task, sorted by time and streamed to its own
    file in row groups of ``row_group`` rows; Spark's commit puts the files of the
    attempts that count into place (``sinks.chunk_source``). Column types are those of ``df``, with
    ``volume`` always double, so chunks with and without NULLs can be read
    together. NULL key parts get a folder name of their own (``keys.NO_KEY``).

    Returns the ledger (chunk key, path, rows, size_bytes, success, message, elapsed) of the files written. A chunk that
    cannot be written or put into place (or whose file does not hold its rows) is a row with its message, cut at
    ``MESSAGE_CHARS``; the other chunks are not held up. One file per chunk means one writer per chunk;
    for very large chunks prefer ``write_chunks`` (Hive layout), which splits them.
    """
    spark = df.sparkSession
    ship_package(spark)
    out = df if "year_month" in df.columns else df.withColumn("year_month", K.year_month_of(F.col(ts)))
    if "volume" in out.columns:
        out = out.withColumn("volume", F.col("volume").cast("double"))
    out = out.repartition(*KEY).sortWithinPartitions(*KEY, ts)
    run = uuid.uuid4().hex
    ledger = qualified(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{run}")
    spark.dataSource.register(ChunkSource)
    (out.write.format(ChunkSource.name()).mode("append").option("run", run).option("ledger", ledger)
     .option("row_group", row_group).option("path", qualified(spark, root)).save())
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def write_reports(report: DataFrame, root: str) -> None:
    """K4: one JSON report per key, partitioned by schema and symbol; replaced per key."""
    (report.withColumn("_schema", F.col("schema")).withColumn("_symbol", F.col("symbol"))
     .repartition("_schema", "_symbol")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_schema", "_symbol").json(root))


def write_manifests(manifest: DataFrame, root: str) -> None:
    """K6: one manifest per (schema, symbol), replaced per key."""
    (manifest.withColumn("_schema", F.col("schema")).withColumn("_symbol", F.col("symbol"))
     .repartition("_schema", "_symbol")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_schema", "_symbol").json(root))


def warehouse_frame(df: DataFrame) -> DataFrame:
    """K7: the warehouse row shape, and which rows cannot be loaded.

    Fields with a declared type (``config.WAREHOUSE_FIELDS``) take it, time zones aside; ``dt`` is the UTC date of
    ts_recv, else ts_event. ``_unfit`` marks rows without symbol, venue or time, or with a value that does not fit
    its declared type.
    """
    kinds = {n: t for n, t in WAREHOUSE_FIELDS.items() if n in df.columns and not (
        t == "timestamp" and df.schema[n].dataType.typeName().startswith("timestamp"))}
    fitted = {n: F.col(n).try_cast(t) for n, t in kinds.items()}
    unfit = F.lit(False)
    for n in kinds:
        unfit = unfit | (F.col(n).isNotNull() & fitted[n].isNull())
    axis = [fitted.get(n, F.col(n)) for n in ("ts_recv", "ts_event") if n in df.columns]
    time = F.coalesce(*axis) if axis else F.lit(None).cast("timestamp")
    for n in ("symbol", "venue"):
        unfit = unfit | (F.col(n).isNull() if n in df.columns else F.lit(True))
    return df.withColumns({**fitted, "dt": F.to_date(time), "_unfit": unfit | time.isNull()})


def append_run_log(log: DataFrame, root: str) -> None:
    """K9: structured run log, JSON lines, one folder per day."""
    (log.withColumn("run_date", F.to_date("ts")).write.mode("append").partitionBy("run_date").json(root))


def log_rows(spark, level: str, logger: str, msgs: DataFrame | None = None, msg: str | None = None) -> DataFrame:
    """Build run-log rows, either from a frame with a ``msg`` column or from one message."""
    if msgs is None:
        msgs = spark.createDataFrame([(msg,)], "msg string")
    return msgs.select(F.current_timestamp().alias("ts"), F.lit(level).alias("level"),
                       F.lit(logger).alias("logger"), F.col("msg"), F.lit(None).cast("string").alias("exc"))
