"""Publish workflow (C5, C6): gate -> copy -> verify -> manifest -> warehouse -> summary.

Object stores and the warehouse are any Hadoop-compatible paths. Copying is a
task per file (bytes streamed with pyarrow's filesystem layer, ``.tmp`` then
rename); verification re-reads the target digests with Spark and joins them
with the local ones.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickgate.config import PUBLISH_PREFIX
from tickgate.functions import keys as K
from tickgate.operators import publishing as PB
from tickgate.session import arrow_uri, cut_lineage, qualified, ship_package, write_table
from tickgate.sinks import writers as W
from tickgate.sinks.snapshots import SnapshotTable
from tickgate.sources import files, reports


@dataclass
class PublishResult:
    ledger: DataFrame
    manifest: DataFrame
    loaded: DataFrame
    summary: DataFrame


def _copier(target_root: str):
    def copy(batches):
        import pyarrow.fs as pafs
        for pdf in batches:
            out = []
            for src, blob in zip(pdf["path"], pdf["blob_name"]):
                sfs, sp = pafs.FileSystem.from_uri(arrow_uri(src))
                dfs, dp = pafs.FileSystem.from_uri(arrow_uri(target_root.rstrip("/") + "/" + blob))
                dfs.create_dir(dp.rsplit("/", 1)[0], recursive=True)
                tmp = f"{dp}.{uuid.uuid4().hex}.tmp"    # of this attempt alone
                pafs.copy_files(sp, tmp, source_filesystem=sfs, destination_filesystem=dfs)
                dfs.move(tmp, dp)
                out.append(blob)
            yield pd.DataFrame({"blob_name": out})
    return copy


def _target_uri(target_root: str, blob: F.Column) -> F.Column:
    return F.concat(F.lit(target_root.rstrip("/") + "/"), blob)


def _present(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its own file system (metadata only)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def existing_objects(spark: SparkSession, target_root: str, digests: bool = False,
                     only: DataFrame | None = None) -> DataFrame:
    """(blob_name, size_bytes, md5) of objects already under the target.

    A listing reads no bytes; ``digests=True`` also hashes the objects, and
    ``only`` (a frame with ``blob_name``) limits that to the objects of interest.
    """
    if not _present(spark, target_root):
        return spark.createDataFrame([], "blob_name string, size_bytes bigint, md5 string")
    listing = files.list_files(spark, target_root)
    objs = listing.select("path", K.relpath_under(F.col("path"), qualified(spark, target_root)).alias("blob_name"), "size_bytes")
    if only is not None:
        objs = objs.join(only.select("blob_name").distinct(), "blob_name", "left_semi")
    if not digests:
        return objs.select("blob_name", "size_bytes", F.lit(None).cast("string").alias("md5"))
    d = files.digests_of(objs.select("path"))
    return objs.join(d.select("path", "md5"), "path", "left").select("blob_name", "size_bytes", "md5")


def _list_prefixes(target_root: str):
    """(blob_name, size_bytes) of the objects directly below each prefix; a prefix that is absent has none."""
    def run(batches):
        import pyarrow.fs as pafs
        for pdf in batches:
            out = []
            for prefix in pdf["prefix"]:
                fs, p = pafs.FileSystem.from_uri(arrow_uri(f"{target_root.rstrip('/')}/{prefix}"))
                for f in fs.get_file_info(pafs.FileSelector(p, allow_not_found=True)):
                    if f.type == pafs.FileType.File:
                        out.append((f"{prefix}/{f.base_name}", f.size))
            yield pd.DataFrame(out, columns=["blob_name", "size_bytes"])
    return run


def prefixes_to_list(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """The distinct prefixes (folders) of the wanted objects that ``known`` (blob_name, ...) does not cover."""
    open_ = wanted.select("blob_name").join(known.select("blob_name"), "blob_name", "left_anti")
    return open_.select(F.regexp_replace("blob_name", r"/[^/]*$", "").alias("prefix")).distinct()


def target_state(spark: SparkSession, target_root: str, wanted: DataFrame, manifest_root: str | None = None) -> DataFrame:
    """(blob_name, size_bytes, md5) of the wanted objects that exist at the target.

    Objects in the stored manifests are known from there; only the prefixes of the others are listed, a task per
    group of prefixes, so publishing one chunk lists one prefix, however large the target is.
    """
    ship_package(spark)
    names = wanted.select("blob_name", "schema", "symbol").distinct()
    known = spark.createDataFrame([], "blob_name string, size_bytes bigint, md5 string")
    if manifest_root and _present(spark, manifest_root):
        kept = reports.manifest_entries(reports.read_manifests(spark, manifest_root))
        known = write_table(kept.join(names, ["schema", "symbol", "blob_name"], "left_semi")
                            .select("blob_name", "size_bytes", "md5"))
    listed = prefixes_to_list(names, known).repartition(files.io_tasks(spark), "prefix").mapInPandas(
        _list_prefixes(target_root), "blob_name string, size_bytes bigint")
    found = listed.join(names, "blob_name", "left_semi").join(known.select("blob_name"), "blob_name", "left_anti")
    return known.unionByName(found.withColumn("md5", F.lit(None).cast("string")))


def _rows_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The rows of the listed chunk files with ``_file``; Spark's own scan, which opens no other file."""
    read = spark.read.option("mergeSchema", "true").parquet(*paths)
    return read.select("*", F.col("_metadata.file_path").alias("_file"))


def warehouse_table(spark: SparkSession, warehouse_root: str, schema: str) -> SnapshotTable:
    """The table of a schema, partitioned by day, rows clustered by symbol and venue."""
    return SnapshotTable(spark, f"{warehouse_root.rstrip('/')}/{schema.replace('-', '_')}")


def load_chunks(spark: SparkSession, ok: DataFrame, schema: str, warehouse_root: str,
                given: DataFrame | None = None) -> DataFrame:
    """K7/K8: append the rows of chunks not yet loaded, as one commit; returns the chunks loaded.

    A chunk with a row that the table cannot take is left out, as its load would fail.
    """
    table = warehouse_table(spark, warehouse_root, schema)
    before = table.loads().select("blob_name", "md5")
    if given is not None:
        before = before.unionByName(given.select("blob_name", "md5"))
    new, _ = PB.load_ledger(ok.select("blob_name", "md5"), before.distinct())
    new = write_table(new.join(ok.select("blob_name", "md5", "path", F.col("row_count").alias("rows")), ["blob_name", "md5"]))
    # the paths are what Spark's file index keeps on the driver for any scan of these files
    paths = [r["path"] for r in new.where("rows > 0").select("path").collect()]
    if not paths:
        return new.select("blob_name", "md5")
    plain = lambda c: F.regexp_replace(F.url_decode(c), "^[a-z0-9]+:/+", "/")
    fitness = W.warehouse_frame(_rows_of(spark, paths)).groupBy(plain(F.col("_file")).alias("_file")).agg(
        F.count_if("_unfit").alias("n_unfit")).where("n_unfit > 0")
    fit = write_table(new.join(fitness, plain(F.col("path")) == F.col("_file"), "left_anti"))
    good = [r["path"] for r in fit.where("rows > 0").select("path").collect()]
    if good:
        table.append(W.warehouse_frame(_rows_of(spark, good)).drop("_unfit", "_file"), fit.select("blob_name", "md5", "rows"))
    return fit.select("blob_name", "md5")


def _manifests(spark: SparkSession, entries: DataFrame, manifest_root: str) -> DataFrame:
    """The new entries put into the stored manifests (by object name), stored and returned."""
    if _present(spark, manifest_root):
        old = reports.manifest_entries(reports.read_manifests(spark, manifest_root))
        old = old.join(entries.select("schema", "symbol").distinct(), ["schema", "symbol"], "left_semi")
        entries = PB.manifest_upsert(old, entries)
    manifest = write_table(PB.manifest_build(entries))
    W.write_manifests(manifest, manifest_root)
    return manifest


def publish(spark: SparkSession, cache_root: str, schema: str, chunks: DataFrame, report: DataFrame,
            target_root: str,
            warehouse_root: str | None = None, load_ledger: DataFrame | None = None,
            overwrite: bool = False, require_report: bool = False, verify_existing: bool = False,
            prefix: str = PUBLISH_PREFIX, manifest_root: str | None = None) -> PublishResult:
    """C5 for one schema. ``chunks``: its chunk probe (key, path, rows, size_bytes).

    Only the chunks being published are hashed. Existing objects are known from the stored manifests, and
    only prefixes that these do not cover are listed; only the objects copied in this run are
    re-read to verify them. ``verify_existing`` lists the target and hashes the existing
    objects that would be skipped (D-09); otherwise those that no manifest knows have a NULL ``digest_match``.

    An object counts as uploaded only if it is at the target with the local digest. Manifests are
    kept under ``manifest_root`` (default ``{target}/_manifests``) and upserted; the warehouse table's own
    log holds the chunks loaded, so a rerun, also of a run that died at any point, appends nothing twice.
    """
    ship_package(spark)
    target_root = qualified(spark, target_root)
    # written once, a row per chunk: the steps below read it several times, and each would carry the report's whole plan
    gated = write_table(PB.with_blob_name(PB.publish_gate(chunks.drop("md5"), report, require_report=require_report), prefix))
    local = files.digests_of(gated.where(F.col("decision") == "publish").select("path"))
    gated = gated.join(local.select("path", "md5"), "path", "left")
    manifest_root = manifest_root or f"{target_root.rstrip('/')}/_manifests"
    existing = (existing_objects(spark, target_root, digests=True, only=gated) if verify_existing
                else target_state(spark, target_root, gated, manifest_root))
    ledger = PB.publish_ledger(gated, existing, target_root, overwrite)
    ledger = ledger.join(gated.select("blob_name", "path"), "blob_name", "left")
    # reliable checkpoint: the outcome is fixed before any object is written
    ledger = cut_lineage(ledger)
    to_copy = ledger.where(F.col("success") & ~F.col("skipped"))
    to_copy.select("path", "blob_name").repartition(files.io_tasks(spark), "blob_name") \
        .mapInPandas(_copier(target_root), "blob_name string").count()
    copied = files.digests_of(to_copy.select(_target_uri(target_root, F.col("blob_name")).alias("path")))
    after = (to_copy.select("blob_name", _target_uri(target_root, F.col("blob_name")).alias("path"))
             .join(copied.select("path", F.col("md5").alias("_remote")), "path", "left").drop("path"))
    copying = F.col("success") & ~F.col("skipped")
    verified = write_table(
        ledger.join(after, "blob_name", "left")
        .withColumn("digest_match", F.when(copying, F.col("md5").eqNullSafe(F.col("_remote")) & F.col("md5").isNotNull())
                    .otherwise(F.col("digest_match")))
        .withColumn("message", F.when(copying & ~F.col("digest_match"), F.lit("target object is absent or differs"))
                    .otherwise(F.col("message")))
        .withColumn("success", F.col("success") & F.coalesce(F.col("digest_match"), F.lit(True)))
        .drop("_remote"))
    manifest = _manifests(spark, PB.manifest_entries(verified), manifest_root)
    loaded = spark.createDataFrame([], "blob_name string, md5 string")
    if warehouse_root:
        loaded = load_chunks(spark, verified.where("success"), schema, warehouse_root, load_ledger)
    return PublishResult(verified, manifest, loaded, PB.publish_summary(verified, loaded))
