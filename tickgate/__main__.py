"""Command line: ``python -m tickgate {download,validate,upload} ...`` (or via spark-submit).

Each command builds the same lazy plans as the library and prints its summary
frame. Paths are Hadoop-compatible (local, HDFS, object stores).
"""
from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tickgate import config as cfg
from tickgate.operators import planning as P
from tickgate.operators import publishing as PB
from tickgate.operators import verdict as V
from tickgate.plans import ingest as I
from tickgate.plans.publish import publish
from tickgate.plans.validate import validate_layout
from tickgate.sinks import writers as W
from tickgate.sources import dims, files, reports


def _session(args) -> SparkSession:
    b = SparkSession.builder.appName(f"tickgate-{args.command}")
    if args.master:
        b = b.master(args.master)
    spark = b.getOrCreate()
    if args.checkpoint_dir:
        spark.sparkContext.setCheckpointDir(args.checkpoint_dir)
    return spark


def _all(frames: list):
    """The result rows of all schemas as one frame; None without any."""
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else None


def _told(spark, args, logger: str, messages) -> None:
    """K9: one run-log row per message, appended to the day's folder."""
    if args.log:
        W.append_run_log(W.log_rows(spark, "INFO", logger, msgs=messages), args.log)


def cmd_download(spark, args) -> None:
    """Plan the chunks of each schema of the mode and ingest what is not cached from a landing table."""
    ledgers = []
    universe = I.check_universe(dims.read_universe(spark, args.tickers))
    landing = spark.read.parquet(args.landing) if args.landing else None
    for schema, venues in I.resolve_mode(args.mode):
        ledger_root = f"{args.cache.rstrip('/')}/_ledger/{schema}"
        prior = (spark.read.parquet(ledger_root) if _exists(spark, ledger_root) else
                 spark.createDataFrame([], "schema string, symbol string, venue string, year_month string, "
                                           "success boolean, rows bigint"))
        landed = None if args.force else P.landed_with_empties(
            files.chunk_probe(spark, args.cache, schema) if _exists(spark, f"{args.cache}/{schema}") else
            spark.createDataFrame([], "schema string, symbol string, venue string, year_month string, "
                                      "rows bigint, state string"), prior)
        if args.dry_run or landing is None:
            plan, status = I.plan_ingest(universe, schema, venues, args.start, args.end, landed)
            P.plan_estimate(status).show(truncate=False)
            continue
        res = I.ingest(landing.where(F.col("schema") == schema) if "schema" in landing.columns else landing,
                       universe, schema, args.cache, venues, args.start, args.end, landed,
                       force=args.force, layout="chunk")
        ledger = res.ledger.checkpoint(eager=True)
        # K2: the ledger keeps the empty-chunk markers (no file exists for them)
        ledger.write.mode("append").parquet(ledger_root)
        ledgers.append(ledger)
    if (done := _all(ledgers)) is not None:
        P.ingest_summary(done).show(truncate=False)
        P.ingest_totals(done).orderBy("schema").show(truncate=False)
        P.failures(done).show(1000, truncate=False)
        word = F.when(~F.col("success"), "FAILED").when(F.col("cached"), "CACHED").otherwise("DOWNLOADED")
        _told(spark, args, "download", done.select(F.concat_ws(" ", word, *P.CHUNK_KEY, F.lit("-"), "message").alias("msg")))


def cmd_validate(spark, args) -> None:
    seen = []
    for schema in dims.mode_schemas(args.mode):
        if not _exists(spark, f"{args.cache}/{schema}"):
            continue
        v = validate_layout(spark, args.cache, cfg.ValidationConfig(schema=schema), symbol=args.symbol,
                            reports_root=f"{args.reports}/{schema}" if args.reports else None,
                            quarantine_root=f"{args.quarantine}/{schema}" if args.quarantine else None)
        seen.append(v.report)
        V.corp_event_keys(v.check_results, ["symbol"]).orderBy("symbol").show(truncate=False)
        V.quarantine_preview(v.report, ["symbol"]).join(
            V.abort_reasons(v.check_results, ["symbol"]), "symbol", "left").orderBy("rank").show(truncate=False)
        if args.fix_quarantine and args.landing:
            q = v.report.where("quarantine").select("symbol")
            req = P.requeue(files.chunk_probe(spark, args.cache, schema), q)
            led = I.reingest(spark.read.parquet(args.landing), req, schema, args.cache)
            P.ingest_summary(led).show(truncate=False)
    if (done := _all(seen)) is not None:
        V.validation_totals(done).orderBy("schema").show(truncate=False)
        _told(spark, args, "validate", done.select(F.concat_ws(
            " ", F.when(F.col("quarantine"), "QUARANTINED").otherwise("CLEAN"), "schema", "symbol",
            F.array_join("warnings", ",")).alias("msg")))


def cmd_upload(spark, args) -> None:
    ledgers, loads = [], []
    for schema in dims.mode_schemas(args.mode):
        if not _exists(spark, f"{args.cache}/{schema}"):
            continue
        rep_root = f"{args.reports}/{schema}" if args.reports else None
        report = (reports.read_reports(spark, rep_root) if rep_root and _exists(spark, rep_root)
                  else spark.createDataFrame([], reports.REPORT_SCHEMA))
        chunks = files.chunk_probe(spark, args.cache, schema)
        res = publish(spark, args.cache, schema, chunks, report, args.target,
                      warehouse_root=None if args.no_warehouse else args.warehouse, overwrite=args.overwrite)
        ledgers.append(res.ledger)
        loads.append(res.loaded)
        files.storage_report(spark, f"{args.cache}/{schema}").show(truncate=False)
    if (done := _all(ledgers)) is not None:
        PB.publish_totals(done, _all(loads)).orderBy("schema").show(truncate=False)
        _told(spark, args, "upload", done.select(F.concat_ws(" ", *P.CHUNK_KEY, F.lit("-"), "message").alias("msg")))


def _exists(spark, path: str) -> bool:
    """True when ``path`` can be listed (any Hadoop-compatible file system)."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").schema
        return True
    except AnalysisException:
        return False


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tickgate")
    ap.add_argument("--master", default=None)
    ap.add_argument("--log", default=None, help="folder of the run log (JSON lines, a folder per day)")
    ap.add_argument("--checkpoint-dir", default=None, help="shared folder for lineage cuts")
    sub = ap.add_subparsers(dest="command", required=True)
    modes = list(cfg.MODE_SCHEMAS)

    d = sub.add_parser("download", help="plan chunks and ingest missing ones from a landing table")
    d.add_argument("--mode", choices=modes, default="all")
    d.add_argument("--tickers", required=True)
    d.add_argument("--cache", required=True)
    d.add_argument("--landing", default=None, help="Parquet landing table (symbol, venue, ts_event, ...)")
    d.add_argument("--start", default=cfg.START_DATE)
    d.add_argument("--end", default=cfg.END_DATE)
    d.add_argument("--dry-run", action="store_true")
    d.add_argument("--force", action="store_true")

    v = sub.add_parser("validate", help="validate the cached chunks per symbol")
    v.add_argument("--mode", choices=modes, default="all")
    v.add_argument("--cache", required=True)
    v.add_argument("--symbol", default=None)
    v.add_argument("--reports", default=None)
    v.add_argument("--quarantine", default=None)
    v.add_argument("--fix-quarantine", action="store_true")
    v.add_argument("--landing", default=None)

    u = sub.add_parser("upload", help="publish validated chunks")
    u.add_argument("--mode", choices=modes, default="all")
    u.add_argument("--cache", required=True)
    u.add_argument("--reports", default=None)
    u.add_argument("--target", required=True)
    u.add_argument("--warehouse", default=None)
    u.add_argument("--no-warehouse", action="store_true")
    u.add_argument("--overwrite", action="store_true")
    return ap


def main(argv=None) -> int:
    args = build_parser().parse_args(argv)
    spark = _session(args)
    {"download": cmd_download, "validate": cmd_validate, "upload": cmd_upload}[args.command](spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
