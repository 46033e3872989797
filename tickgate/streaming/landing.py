"""Structured Streaming over a landing folder.

The reference validates in batch after downloads finish. As a stream, files
landing in a folder drive the same checks:

* ``revalidate_on_arrival``: each micro-batch names the keys it touched; the
  batch function re-reads those keys' full history (a semi-join, so only their
  rows), runs the batch validator and overwrites their reports (dynamic
  partition overwrite, one folder per key). Re-running an epoch after a
  failure rewrites the same reports: the sink is idempotent.
* ``row_checks``: the row-local checks (B, J, E counts) per key and ET day for
  each micro-batch, appended as they arrive (stateless, no watermark needed).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickgate.config import ValidationConfig
from tickgate.operators.normalize import normalize_bars
from tickgate.plans import incremental as I
from tickgate.plans.validate import validate
from tickgate.operators.nulls import join_same
from tickgate.session import write_table
from tickgate.sinks import writers as W
from tickgate.sinks.snapshots import SnapshotTable
from tickgate.sources.bars import with_file_order

BAR_STREAM_SCHEMA = ("symbol string, venue string, ts_event timestamp_ntz, open double, high double, "
                     "low double, close double, volume double")


def landing_stream(spark: SparkSession, landing_dir: str, schema: str = BAR_STREAM_SCHEMA,
                   max_files_per_trigger: int | None = None, layout: str = "flat") -> DataFrame:
    r = spark.readStream.schema(schema)
    if layout != "hive":
        r = r.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(landing_dir)


HIVE_PARTITIONS = "symbol string, venue_safe string, year_month string"


def _history(spark: SparkSession, landing_dir: str, schema: str, layout: str) -> DataFrame:
    if layout == "hive":
        # partition discovery: symbol/venue_safe/year_month come from the paths
        return spark.read.schema(schema).parquet(landing_dir)
    return spark.read.schema(schema).option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "*.parquet").parquet(landing_dir)


def _revalidate(landing_dir: str, reports_root: str, cfg: ValidationConfig, schema: str, layout: str = "flat"):
    keys = list(cfg.keys)

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        touched = batch.select(*keys).distinct()
        history = _history(spark, landing_dir, schema, layout)
        rows = join_same(history, touched, keys, "left_semi")
        if layout == "hive":
            rows = rows.drop("venue_safe")
        v = validate(rows, cfg)
        W.write_reports(v.report.withColumn("epoch", F.lit(epoch_id)), reports_root)
    return run


def _fold(state_root: str, reports_root: str, cfg: ValidationConfig):
    keys = list(cfg.keys)

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        table = SnapshotTable(spark, f"{state_root.rstrip('/')}/{cfg.schema}")
        listing = write_table(batch.select(*keys, F.col("file_path").alias("path"),
                                           F.sha2(I.plain_path(F.col("file_path")), 256).alias("digest")).distinct())
        # an epoch that is replayed after its commit finds its files known
        fresh = listing.join(table.loads().select(F.col("md5").alias("digest")), "digest", "left_anti")
        if not fresh.isEmpty():
            names = F.array(*[F.lit(c) for c in batch.columns if c not in ("file_path", "row_index")])
            footers = fresh.select("path", F.lit(True).alias("ok"), names.alias("columns")).distinct()
            I.record(table, fresh, batch.drop("venue_safe"), footers, cfg)
        v = I.verdicts(table, None, cfg, only=listing.select(*keys).distinct())
        W.write_reports(v.report.withColumn("epoch", F.lit(epoch_id)), reports_root)
    return run


def revalidate_on_arrival(spark: SparkSession, landing_dir: str, reports_root: str, checkpoint: str,
                          cfg: ValidationConfig = ValidationConfig(), schema: str = BAR_STREAM_SCHEMA,
                          available_now: bool = True, layout: str = "flat",
                          state_root: str | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has landed and stops.

    With ``state_root`` a micro-batch reads only its own files: their partial aggregates are committed to the state
    (``plans.incremental``) and the touched keys are judged from it. Without, it re-reads the touched keys' history.

    ``layout='hive'``: ``landing_dir`` is one schema's Hive tree
    (``symbol=/venue_safe=/year_month=``, as written by ``sinks.writers.write_chunks``);
    the partition columns are read from the paths.
    """
    if layout == "hive":
        names = {f.split()[0] for f in schema.split(",")}
        if "symbol" in names:
            schema = ", ".join(f for f in schema.split(",") if f.split()[0] not in ("symbol", "venue"))
        schema = schema + ", " + HIVE_PARTITIONS
    landed = landing_stream(spark, landing_dir, schema, layout=layout)
    each = (_fold(state_root, reports_root, cfg) if state_root
            else _revalidate(landing_dir, reports_root, cfg, schema, layout))
    w = ((with_file_order(landed) if state_root else landed).writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def row_checks(stream: DataFrame, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    """B, J and E counts per (key, ET date) of each micro-batch (row-local, stateless)."""
    n = normalize_bars(stream, cfg).df
    o, h, lo, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    return (n.groupBy(*cfg.keys, "et_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count_if(o <= 0) + F.count_if(h <= 0) + F.count_if(lo <= 0) + F.count_if(c <= 0)).alias("n_bad_ohlc"),
        F.count_if(v < 0).alias("n_neg_volume"),
        F.count_if((h < o) | (h < c)).alias("n_bad_high"),
        F.count_if((lo > o) | (lo > c)).alias("n_bad_low"),
        F.count_if(h < lo).alias("n_bad_high_low"),
        F.count_if("in_session").alias("n_kept")))


def start_row_checks(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str,
                     cfg: ValidationConfig = ValidationConfig(), available_now: bool = True) -> StreamingQuery:
    """Per-batch tallies appended to ``out_dir`` (Parquet, one batch per epoch)."""
    def append(batch: DataFrame, epoch_id: int) -> None:
        # a replayed epoch replaces its own partition
        (row_checks(batch, cfg).withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out_dir))

    w = landing_stream(spark, landing_dir).writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
