"""Validation that reads each chunk once (V incremental).

All that the verdicts need is mergeable: the base aggregates are counts, sums and extremes, a file's steps back in
time add up over files, and required columns are judged per file. So the partial aggregates of every chunk are kept,
by the chunk's digest, in a snapshot table; a run scans the chunks that have no entry, commits theirs as a whole, and
merges the entries of the chunks that are there now. Changed chunks get a new digest, and entries of chunks that are
gone or were replaced no longer take part. A run that dies leaves nothing behind that is read.

A chunk's digest is that of its path, size and time of modification, which a listing tells; no bytes are read for it.
Time axis and columns are picked per run from the files it scans.
"""
from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickgate.config import ValidationConfig
from tickgate.functions import keys as K
from tickgate.functions import timez
from tickgate.operators import checks as C
from tickgate.operators.normalize import normalize_bars
from tickgate.operators.nulls import join_same
from tickgate.plans.validate import Validation, judge
from tickgate.session import qualified, write_table
from tickgate.sinks.snapshots import SnapshotTable
from tickgate.sources import bars as B
from tickgate.sources import files

LEVEL_KEYS = ["level", "et_date", "ts_event", "close"]


@dataclass
class Incremental:
    validation: Validation
    scanned: int       # chunks whose rows this run read
    reused: int        # chunks known from earlier runs


def plain_path(path: Column) -> Column:
    """A path as listings and scans both name it: decoded, without scheme."""
    return F.regexp_replace(F.url_decode(path), "^[a-z0-9]+:/+", "/")


def chunk_digest(path: Column, size: Column, modified: Column) -> Column:
    return F.sha2(F.concat_ws("|", plain_path(path), size.cast("string"), F.unix_micros(modified).cast("string")), 256)


def partial_aggregates(rows: DataFrame, cfg: ValidationConfig) -> DataFrame:
    """The mergeable aggregates of ``rows`` (with file order) per file: levels ts, px and order."""
    norm = normalize_bars(rows, cfg).df.withColumn("file_path", plain_path(F.col("file_path")))
    per_file = replace(cfg, keys=(*cfg.keys, "file_path"))
    viol = C.order_violations(norm, [*cfg.keys, "file_path"], block_rows=cfg.c_block_rows)
    return C.base_aggregates(norm, per_file).unionByName(viol.withColumn("level", F.lit("order")), allowMissingColumns=True)


def record(table: SnapshotTable, listing: DataFrame, rows: DataFrame | None, footers: DataFrame, cfg: ValidationConfig) -> None:
    """Commits the partial aggregates of the listed chunks; ``footers``: (path, ok, columns) of each."""
    at = listing.select("digest", plain_path(F.col("path")).alias("file_path"), *[F.col(k).alias(f"_{k}") for k in cfg.keys])
    foot = footers.select(plain_path(F.col("path")).alias("file_path"), "ok", "columns")
    entry = at.join(foot, "file_path", "left").select(
        "digest", *[F.col(f"_{k}").alias(k) for k in cfg.keys], "file_path", F.lit("file").alias("level"),
        F.coalesce("ok", F.lit(False)).alias("ok"), "columns")
    if rows is not None:
        parts = partial_aggregates(rows, cfg).join(at.select("digest", "file_path").distinct(), "file_path")
        entry = parts.unionByName(entry, allowMissingColumns=True)
    loads = listing.select(F.col("path").alias("blob_name"), F.col("digest").alias("md5"),
                           F.lit(None).cast("bigint").alias("rows")).distinct()
    table.append(entry, loads, partition="level", cluster=("digest",))


def merged(table: SnapshotTable, current: DataFrame | None, cfg: ValidationConfig,
           only: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(base, violations, file entries) of the chunks in ``current`` (digest; all without), of the keys ``only``."""
    keys = list(cfg.keys)
    kept = table.read()
    if current is not None:
        kept = kept.join(current.select("digest").distinct(), "digest", "left_semi")
    if only is not None:
        kept = join_same(kept, only, keys, "left_semi")
    base = kept.where(F.col("level").isin("ts", "px")).groupBy(*keys, *LEVEL_KEYS).agg(*C.merged_aggregates())
    viol = kept.where(F.col("level") == "order").groupBy(*keys).agg(F.sum("n_violations").cast("bigint").alias("n_violations"))
    return base, viol, kept.where(F.col("level") == "file")


def verdicts(table: SnapshotTable, current: DataFrame | None, cfg: ValidationConfig,
             only: DataFrame | None = None) -> Validation:
    """The validation of the chunks in ``current`` (digest, keys), from their stored aggregates alone.

    ``only``: the keys to judge, for a caller that knows which have changed.
    """
    keys = list(cfg.keys)
    base, viol, entries = merged(table, current, cfg, only)
    entries = write_table(entries.select(*keys, "file_path", "ok", "columns"))
    columns = entries.where("ok").select(*keys, F.col("file_path").alias("path"), F.explode("columns").alias("column"))
    # the distinct column names of the layout: bounded by its schema
    present = sorted({r["column"] for r in columns.select("column").distinct().collect()} | set(keys))
    bad = entries.where("NOT ok").groupBy(*keys).agg(F.count("*").alias("n_unreadable"))
    return judge(write_table(base, ("level",)), viol, cfg, present, timez.pick_time_axis(present) is not None,
                 missing_by_key=C.file_missing_columns(columns, cfg.required(), keys), unreadable=bad,
                 expected_keys=(current if only is None else only).select(*keys))


def chunk_listing(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """(schema, symbol, venue, year_month, path, digest) of the chunk layout; a listing, no bytes read."""
    found = files.list_files(spark, f"{root.rstrip('/')}/{schema}").where(files.not_quarantined(F.col("path")))
    key = K.parse_chunk_relpath(K.relpath_under(F.col("path"), qualified(spark, root)))
    return found.withColumn("_k", key).where(F.col("_k").isNotNull()).select(
        "_k.*", "path", chunk_digest(F.col("path"), F.col("size_bytes"), F.col("modified")).alias("digest"))


def validate_incremental(spark: SparkSession, root: str, state_root: str,
                         cfg: ValidationConfig = ValidationConfig()) -> Incremental:
    """VS over the chunk layout, scanning only chunks that no earlier run with ``state_root`` has seen.

    ``state_root`` belongs to one configuration (keys, session and thresholds of what is stored).
    """
    table = SnapshotTable(spark, f"{state_root.rstrip('/')}/{cfg.schema}")
    listing = write_table(chunk_listing(spark, root, cfg.schema))
    known = table.loads().select(F.col("md5").alias("digest")).distinct()
    fresh = write_table(listing.join(known, "digest", "left_anti"))
    n = fresh.count()
    if n:
        foot = write_table(files.parquet_footers(fresh))
        # the paths are what Spark's file index keeps on the driver for any scan of these files
        paths = [r["path"] for r in foot.where("ok").select("path").collect()]
        rows = None
        if paths:
            key = K.parse_chunk_relpath(K.relpath_under(F.col("file_path"), qualified(spark, root)))
            rows = B.with_file_order(spark.read.option("mergeSchema", "true").parquet(*paths))
            rows = rows.withColumn("_k", key).withColumns({c: F.col(f"_k.{c}") for c in ("symbol", "venue")}).drop("_k")
        record(table, fresh, rows, foot, cfg)
    return Incremental(verdicts(table, listing, cfg), n, listing.count() - n)
