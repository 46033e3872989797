"""Ingest workflow (C1, C2, C3): plan -> status -> fetch from landing -> write -> ledger.

The vendor download is re-aimed at a landing frame (any DataFrame with
symbol, venue and a time column): ``read_range`` semantics per chunk become one
semi-join of the landing rows with the chunks to fetch.
"""
from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tickgate import config as cfg
from tickgate.functions import keys as K
from tickgate.operators import planning as P
from tickgate.session import write_table
from tickgate.sinks import writers as W
from tickgate.sources import dims, files


@dataclass
class IngestResult:
    plan: DataFrame
    status: DataFrame
    ledger: DataFrame
    estimate: DataFrame


def plan_ingest(universe: DataFrame, schema: str, venues=None, start_date: str = cfg.START_DATE,
                end_date: str = cfg.END_DATE, landed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Plan and status. ``landed``: a chunk probe (``sources.files.chunk_probe``) or row counts."""
    plan = P.chunk_plan(universe, schema, start_date, end_date, venues=venues)
    if landed is None:
        landed = plan.sparkSession.createDataFrame([], "schema string, symbol string, venue string, "
                                                       "year_month string, rows bigint, state string")
    return plan, P.chunk_status(plan, landed)


def landing_rows(landing: DataFrame, chunks: DataFrame, schema: str, ts: str = "ts_event") -> DataFrame:
    """The landing rows belonging to ``chunks`` (S11 for many chunks at once)."""
    if "schema" in landing.columns:   # a landing table of several schemas
        landing = landing.where(F.col("schema") == schema)
    rows = landing.withColumn("schema", F.lit(schema)).withColumn("year_month", K.year_month_of(F.col(ts)))
    return rows.join(chunks.select(*P.CHUNK_KEY), P.CHUNK_KEY, "left_semi")


def ingest(landing: DataFrame, universe: DataFrame, schema: str, cache_root: str | None = None,
           venues=None, start_date: str = cfg.START_DATE, end_date: str = cfg.END_DATE,
           landed: DataFrame | None = None, force: bool = False, dry_run: bool = False,
           layout: str = "hive", ts: str = "ts_event") -> IngestResult:
    """Fetch every planned chunk that is not cached (all when ``force``) from ``landing``.

    With ``dry_run`` nothing is written and the ledger only reports the plan.
    ``layout``: 'hive' (Spark partitioned writer) or 'chunk' (one file per chunk).
    """
    plan, status = plan_ingest(universe, schema, venues, start_date, end_date, landed)
    status = write_table(status)   # fixed before this run's own output exists
    todo = P.to_fetch(status, force)
    rows = landing_rows(landing, todo, schema, ts)
    if dry_run or not cache_root:
        counts = rows.groupBy(*P.CHUNK_KEY).agg(F.count(F.lit(1)).alias("rows"))
    else:
        counts = _fetched(rows, todo, schema, cache_root, layout, ts)
    ledger = P.ingest_ledger(status, counts, force)
    return IngestResult(plan, status, ledger, P.plan_estimate(status))


def _fetched(rows: DataFrame, todo: DataFrame, schema: str, cache_root: str, layout: str, ts: str) -> DataFrame:
    """Writes the rows of the chunks ``todo`` and tells what became of each; the landing zone is scanned once."""
    if layout == "chunk":
        # the outcome of each chunk as its writer saw it
        return write_table(W.write_chunk_files(rows, cache_root, ts))
    counted, start = Observation(), time.monotonic()
    W.write_chunks(rows.observe(counted, F.count(F.lit(1)).alias("n")), cache_root, ts=ts)
    took, seen = time.monotonic() - start, counted._jo.getRow()
    n = seen.getLong(0) if seen.length() else 0     # Spark observes nothing where it finds the plan empty
    if not n:
        return rows.sparkSession.createDataFrame([], W.LEDGER_SCHEMA)
    # the rows of each chunk from the footers of its new files; chunks without rows have no folder
    there = probe_landed(rows.sparkSession, cache_root, schema, "hive")
    there = write_table(there.join(todo.select(*P.CHUNK_KEY), P.CHUNK_KEY, "left_semi"))
    got = there.agg(F.sum("rows")).first()[0] or 0
    good = F.col("state") != "corrupt"
    message = F.when(good, F.format_string("%,d rows", "rows")).otherwise(F.lit("corrupt: a file cannot be read"))
    if got != n and there.where(~good).isEmpty():
        raise RuntimeError(f"{got} rows landed of {n}")
    return there.select(*P.CHUNK_KEY, F.when(good, F.col("rows")).otherwise(F.lit(0)).alias("rows"), good.alias("success"),
                        message.alias("message"), F.lit(took).alias("elapsed"))   # one job writes them all


def probe_landed(spark, cache_root: str, schema: str, layout: str = "chunk") -> DataFrame:
    """Landed chunks with state and rows, from the files' footers."""
    if layout == "chunk":
        return files.chunk_probe(spark, cache_root, schema)
    probe = files.file_probe(spark, f"{cache_root.rstrip('/')}/schema={schema}")
    part = F.regexp_extract
    p = F.col("path")
    return probe.select(
        F.lit(schema).alias("schema"),
        part(p, r"/symbol=([^/]+)/", 1).alias("symbol"),
        K.venue_unsafe(part(p, r"/venue_safe=([^/]+)/", 1)).alias("venue"),
        part(p, r"/year_month=([^/]+)/", 1).alias("year_month"),
        "rows", "size_bytes", "path", "state").groupBy(*P.CHUNK_KEY).agg(
        F.sum("rows").cast("bigint").alias("rows"), F.sum("size_bytes").cast("bigint").alias("size_bytes"),
        F.min("path").alias("path"),
        F.when(F.count_if(F.col("state") == "corrupt") > 0, "corrupt")
         .when(F.sum("rows") > 0, "ok").otherwise("empty").alias("state"))


def resolve_mode(mode: str) -> list[tuple[str, tuple[str, ...]]]:
    """mode -> [(schema, venues)]."""
    return [(s, cfg.SCHEMA_VENUES[s]) for s in dims.mode_schemas(mode)]


def check_universe(universe: DataFrame) -> DataFrame:
    """refuse to plan over an empty universe (the reference exits when no tickers are found)."""
    if universe.isEmpty():
        raise ValueError("no symbols in the universe")
    return universe


def reingest(landing: DataFrame, requeued: DataFrame, schema: str, cache_root: str,
             layout: str = "chunk", ts: str = "ts_event") -> DataFrame:
    """J11 + C4 ``--fix-quarantine``: rewrite the requeued chunks from landing (force).

    Returns the ingest ledger of those chunks (rows per chunk; 0 when landing has none).
    """
    rows = landing_rows(landing, requeued, schema, ts)
    counts = _fetched(rows, requeued, schema, cache_root, layout, ts)
    st = requeued.select(*P.CHUNK_KEY).withColumn("cached", F.lit(False)).withColumn("rows", F.lit(0).cast("bigint"))
    return P.ingest_ledger(st, counts, force=True)
