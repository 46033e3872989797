"""Registered queries that run whole workflows over files: layouts written from the derived bars, read back, judged.

Each writes below the shared checkpoint folder and returns what the workflow's own readers see there.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickgate.config import ATS_SCHEMA, OHLCV_SCHEMA, ValidationConfig
from tickgate.functions import keys as K
from tickgate.functions.fmt import status_word
from tickgate.operators import planning as P
from tickgate.operators import publishing as PB
from tickgate.operators.normalize import normalize_bars
from tickgate.plans import ingest as I
from tickgate.plans.publish import publish, target_state
from tickgate.plans.validate import validate, validate_layout
from tickgate.session import ensure_checkpoint_dir, write_table
from tickgate.sinks import writers as W
from tickgate.sources import bars as B
from tickgate.sources import dims, files, reports

CFG = ValidationConfig()
# Defects of ``q_validate_defects``: a symbol landed backwards, one whose first venue has no volume, one with a damaged file.
BACKWARDS, NARROW, DAMAGED = "click", "view", "purchase"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.bars_from_events(_events(spark, sf_dir))


def _root(spark: SparkSession, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def _place(rows: DataFrame, root: str, rel: Column, order: Column, drop: tuple[str, ...] = ()) -> None:
    """One Parquet file ``{root}/{rel}.parquet`` per value of ``rel``, rows in ``order``; for landing zones as others leave them."""
    spark, parts = rows.sparkSession, _root(rows.sparkSession, "parts")
    (rows.withColumns({"_rel": rel, "_order": order}).repartition("_rel").sortWithinPartitions("_rel", "_order")
     .drop("_order", *drop).write.partitionBy("_rel").parquet(parts))
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = jpath(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.list_files(spark, parts).select(
        "path", F.url_decode(F.regexp_extract("path", r"/_rel=([^/]+)/", 1)).alias("rel"))
    for r in found.collect():      # a file per symbol or chunk
        to = jpath(f"{root}/{r['rel']}.parquet")
        fs.mkdirs(to.getParent())
        if not fs.rename(jpath(r["path"]), to):
            raise OSError(f"{r['path']} was not moved to {to}")


def _put(spark: SparkSession, path: str, data: bytes) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p)
    out.write(data)
    out.close()


def _report(report: DataFrame) -> DataFrame:
    return report.select("symbol", "schema", "quarantine", F.array_join("warnings", ",").alias("warnings"), "n_rows_in", "n_rows_out")


def q_validate_flat(spark, sf_dir):
    """VA: per-symbol files beside report files and a quarantine folder, judged; the stored reports read back."""
    bars, root = write_table(_bars(spark, sf_dir)), _root(spark, "flat")
    time = F.unix_micros(F.col("ts_event").cast("timestamp"))
    name = F.col("symbol")
    for folder, rel in ((root, name), (f"{root}/quarantine", name), (f"{root}/reports", F.concat(name, F.lit("_validation")))):
        _place(bars, folder, rel, time, drop=("symbol",))
    validate_layout(spark, root, CFG, layout="flat", reports_root=f"{root}_reports")
    return _report(reports.read_reports(spark, f"{root}_reports"))


def _chunk() -> Column:
    return F.concat_ws("/", F.lit(OHLCV_SCHEMA), F.col("symbol"), K.venue_safe(F.col("venue")), K.year_month_of(F.col("ts_event")))


def q_validate_defects(spark, sf_dir):
    """C and D inside verdicts: a symbol whose files run backwards, one without a column, one with a damaged file."""
    bars, root = write_table(_bars(spark, sf_dir)), _root(spark, "defects")
    time = F.unix_micros(F.col("ts_event").cast("timestamp"))
    narrow = (F.col("symbol") == NARROW) & (F.col("venue") == B.ADAPTER_VENUES[0])
    _place(bars.where(~narrow), root, _chunk(), F.when(F.col("symbol") == BACKWARDS, -time).otherwise(time))
    _place(bars.where(narrow).drop("volume"), root, _chunk(), time)
    _put(spark, f"{root}/{OHLCV_SCHEMA}/{DAMAGED}/{B.ADAPTER_VENUES[0].replace('.', '_')}/1999-01.parquet", b"no Parquet file")
    v = validate_layout(spark, root, CFG)
    held = v.report.select("symbol", "quarantine")
    return v.check_results.where(F.col("check").isin("C", "D")).join(held, "symbol").select(
        "symbol", "check", "status", "detail", "quarantine")


def q_validate_one(spark, sf_dir):
    """the chunk layout judged for one symbol only; files of others are not listed."""
    root = _root(spark, "one")
    W.write_chunk_files(_bars(spark, sf_dir).withColumn("schema", F.lit(OHLCV_SCHEMA)), root).count()
    return _report(validate_layout(spark, root, CFG, symbol="view").report)


def q_clean_bars(spark, sf_dir):
    """Session rows of the symbols that are not quarantined."""
    return validate(_bars(spark, sf_dir), CFG).clean.select("symbol", "venue", "ts_event", "close")


def q_universe_scan(spark, sf_dir):
    """A ticker file with blank lines and padding, read as the universe."""
    root, ids = _root(spark, "tickers"), _events(spark, sf_dir).select("user_id").distinct()
    lines = ids.select(F.concat(F.lit("  U"), F.col("user_id").cast("string"), F.lit(" ")).alias("value"))
    lines.unionByName(ids.select(F.lit("   ").alias("value"))).write.text(root)
    return I.check_universe(dims.read_universe(spark, root)).select("symbol")


def q_warehouse_rows(spark, sf_dir):
    """K7: rows in the table's declared shape by day, and those that it cannot take."""
    u, no = F.col("user_id"), F.lit(None)
    rows = _events(spark, sf_dir).select(
        F.when(u % 5 != 0, F.col("event_type")).alias("symbol"), F.lit(B.ADAPTER_VENUES[0]).alias("venue"),
        F.when(u % 7 != 0, F.col("ts")).alias("ts_event"),
        F.when(u % 11 == 0, F.lit("n/a")).when(u % 13 == 0, no).otherwise(F.col("value").cast("string")).alias("price"),
        (u % 10).cast("string").alias("size"))
    return W.warehouse_frame(rows).groupBy(F.coalesce(F.col("dt").cast("string"), F.lit("")).alias("dt"), F.col("_unfit").alias("unfit")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("price").alias("n_prices"), F.sum("size").alias("total_size"))


def q_run_log(spark, sf_dir):
    """K9: the messages of a run's ledger appended to the log, twice, and read back."""
    landed, root = P.landed_from_rows(_bars(spark, sf_dir), OHLCV_SCHEMA), _root(spark, "log")
    universe = dims.universe_from(_events(spark, sf_dir), "event_type")
    ledger = write_table(P.ingest_ledger(P.chunk_status(P.chunk_plan(universe, OHLCV_SCHEMA), landed), landed, force=True))
    for level in ("INFO", "WARNING"):
        W.append_run_log(W.log_rows(spark, level, "ingest", msgs=ledger.select(F.col("message").alias("msg"))), root)
    return spark.read.schema("ts timestamp, level string, logger string, msg string, exc string, run_date date").json(root) \
        .groupBy("level", "logger", "msg").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("run_date").isNotNull()).alias("dated"))


def q_ingest_rerun(spark, sf_dir):
    """A cache filled from landing rows, then a second run that finds every chunk cached, empty ones too (K2)."""
    bars, root = write_table(_bars(spark, sf_dir)), _root(spark, "cache")
    universe = dims.universe_from(_events(spark, sf_dir), "event_type")
    first = write_table(I.ingest(bars, universe, OHLCV_SCHEMA, root).ledger)
    landed = P.landed_with_empties(I.probe_landed(spark, root, OHLCV_SCHEMA, "hive"), first)
    again = write_table(I.ingest(bars, universe, OHLCV_SCHEMA, root, landed=landed).ledger)
    runs = first.withColumn("run", F.lit(1)).unionByName(again.withColumn("run", F.lit(2)))
    return runs.select("run", *P.CHUNK_KEY, "success", "message", "rows", "cached")


def q_target_state(spark, sf_dir):
    """What a target holds of the wanted objects, from its manifests and from listed prefixes alone."""
    bars, root = write_table(_bars(spark, sf_dir).withColumn("schema", F.lit(OHLCV_SCHEMA))), _root(spark, "cache")
    W.write_chunk_files(bars, root).count()
    chunks, target = write_table(files.chunk_probe(spark, root, OHLCV_SCHEMA)), f"{root}_target"
    published = chunks.where(F.col("symbol") != "click")
    publish(spark, root, OHLCV_SCHEMA, published, spark.createDataFrame([], reports.REPORT_SCHEMA), target)
    wanted = PB.with_blob_name(chunks, "raw")
    by_manifest = target_state(spark, target, wanted, f"{target}/_manifests").select("blob_name", "md5")
    listed = target_state(spark, target, wanted).select("blob_name", F.col("size_bytes").alias("_listed"))
    return wanted.join(by_manifest, "blob_name", "left").join(listed, "blob_name", "left").select(
        "blob_name", F.col("md5").isNotNull().alias("in_manifest"), F.coalesce(F.col("_listed") > 0, F.lit(False)).alias("listed"))


def q_mode_plan(spark, sf_dir):
    """The chunks that every schema of a mode plans, per venue."""
    universe, out = dims.universe_from(_events(spark, sf_dir), "event_type"), None
    for mode in ("lit", "ats", "all"):
        for schema, venues in I.resolve_mode(mode):
            n = P.chunk_plan(universe, schema, venues=list(venues)).groupBy("schema", "venue").agg(
                F.count(F.lit(1)).alias("n_chunks"), F.min("year_month").alias("first_month")).withColumn("mode", F.lit(mode))
            out = n if out is None else out.unionByName(n)
    return out.select("mode", "schema", "venue", "n_chunks", "first_month")


def q_time_axis(spark, sf_dir):
    """The same bars with time as an instant, as text and as nanoseconds, each under another axis name."""
    bars, t = _bars(spark, sf_dir), F.col("ts_event")
    instant = F.expr("convert_timezone('UTC', current_timezone(), ts_event)").cast("timestamp")
    shapes = {"Datetime": instant, "datetime": t.cast("string"), "timestamp": F.unix_micros(instant) * 1000}
    out = None
    for axis, value in shapes.items():
        # ``index`` is a later candidate that must lose
        norm = normalize_bars(bars.withColumns({axis: value, "index": F.lit("1999-01-01 00:00:00")}).drop("ts_event"), CFG).df
        n = norm.groupBy("symbol").agg(F.count_if("in_session").alias("n_kept"), F.min("et_date").alias("first_day"),
                                       F.max("ts_event").alias("last_ts")).withColumn("axis", F.lit(axis))
        out = n if out is None else out.unionByName(n)
    return out.select("axis", "symbol", "n_kept", "first_day", "last_ts")


def q_publish_status(spark, sf_dir):
    """Status words of a first publish, of one that finds some objects there, and of an overwrite."""
    chunks = PB.with_blob_name(P.landed_from_rows(_bars(spark, sf_dir), ATS_SCHEMA), "raw")
    gated = PB.publish_gate(chunks, spark.createDataFrame([], reports.REPORT_SCHEMA)).withColumns(
        {"size_bytes": F.lit(None).cast("bigint"), "md5": F.lit(None).cast("string")})
    there = chunks.where(F.col("venue") == B.ADAPTER_VENUES[0]).select(
        "blob_name", F.lit(1).cast("bigint").alias("size_bytes"), F.lit(None).cast("string").alias("md5"))
    out = None
    for run, existing, overwrite in (("first", there.where("false"), False), ("again", there, False), ("overwrite", there, True)):
        led = PB.publish_ledger(gated, existing, "target", overwrite=overwrite, uploaded_at=F.lit(None).cast("timestamp"))
        led = led.select(F.lit(run).alias("run"), "schema", "symbol", "venue", "year_month", status_word(led["skipped"]).alias("status"))
        out = led if out is None else out.unionByName(led)
    return out


WORKFLOWS = {
    "validate_flat": q_validate_flat,
    "validate_defects": q_validate_defects,
    "validate_one": q_validate_one,
    "clean_bars": q_clean_bars,
    "universe_scan": q_universe_scan,
    "warehouse_rows": q_warehouse_rows,
    "run_log": q_run_log,
    "ingest_rerun": q_ingest_rerun,
    "target_state": q_target_state,
    "mode_plan": q_mode_plan,
    "time_axis": q_time_axis,
    "publish_status": q_publish_status,
}
