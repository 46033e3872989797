"""Chunk planning and reconciliation.

A chunk is (schema, symbol, venue, year_month). The plan is the expected set;
status and ledger frames say what has landed and what an ingest did.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickgate import config as cfg
from tickgate.functions import keys as K
from tickgate.functions.fmt import truncate
from tickgate.sources import dims

CHUNK_KEY = ["schema", "symbol", "venue", "year_month"]


def chunk_plan(universe: DataFrame, schema: str, start_date: str = cfg.START_DATE,
               end_date: str = cfg.END_DATE, venues=None) -> DataFrame:
    """Every (symbol, venue, month) from ``max(start, venue earliest start)`` to ``end``.

    Each symbol row is expanded by a literal venue array (fixed config, at most
    19 entries) and a month ``sequence``: a generator per row, not a join.
    """
    u = universe.select(F.col("symbol").cast("string").alias("symbol"))
    v = u.select("symbol", F.explode(dims.venue_array(schema, venues)).alias("_v"))
    start = F.to_date(F.lit(start_date))
    venue_start = F.greatest(start, F.coalesce(F.to_date("_v.earliest_start"), start))
    first = F.trunc(venue_start, "month")
    last = F.trunc(F.to_date(F.lit(end_date)), "month")
    months = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))) \
              .otherwise(F.array().cast("array<date>"))
    p = v.select("symbol", F.col("_v.venue").alias("venue"), F.explode(months).alias("_m"))
    ym = F.date_format("_m", "yyyy-MM")
    s, e = K.month_bounds(ym)
    return p.select(F.lit(schema).alias("schema"), "symbol", "venue", ym.alias("year_month"),
                    s.alias("start"), e.alias("end"))


def landed_from_rows(df: DataFrame, schema: str, ts: str = "ts_event") -> DataFrame:
    """Landed chunk row counts from the rows themselves (when no file probe is at hand)."""
    return (df.select(F.lit(schema).alias("schema"), "symbol", "venue", K.year_month_of(F.col(ts)).alias("year_month"))
            .groupBy(*CHUNK_KEY).agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("state", F.when(F.col("rows") > 0, "ok").otherwise("empty")))


def chunk_status(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Plan left-joined with what landed; ``state`` in missing/corrupt/empty/ok, ``cached`` = readable."""
    cols = [c for c in ("rows", "size_bytes", "path", "state") if c in landed.columns]
    st = plan.join(landed.select(*CHUNK_KEY, *cols), CHUNK_KEY, "left")
    state = F.coalesce(F.col("state"), F.lit("missing"))
    out = st.withColumn("state", state).withColumn("cached", state.isin("ok", "empty"))
    if "rows" in cols:
        out = out.withColumn("rows", F.coalesce("rows", F.lit(0)).cast("bigint"))
    return out


def landed_with_empties(probe: DataFrame, ledger: DataFrame) -> DataFrame:
    """K2: a chunk that came back empty leaves no file in Spark's layout; its
    ledger row (rows = 0) stands in as the 'empty' marker so it is not fetched again."""
    empties = (ledger.where(F.col("success") & (F.col("rows") == 0))
               .select(*CHUNK_KEY, F.lit(0).cast("bigint").alias("rows"), F.lit("empty").alias("state")))
    files_ = probe.select(*CHUNK_KEY, F.col("rows").cast("bigint"), "state")
    return files_.unionByName(empties.join(files_.select(*CHUNK_KEY), CHUNK_KEY, "left_anti"))


def to_fetch(status: DataFrame, force: bool = False) -> DataFrame:
    """F8: chunks to (re)ingest: everything when ``force``, else those not cached."""
    return status if force else status.where(~F.col("cached"))


def plan_estimate(status: DataFrame) -> DataFrame:
    """Dry-run numbers per schema.

    The estimate constants come from a three-row config table, broadcast;
    unknown schemas take the defaults.
    """
    est = dims.estimates_dim(status.sparkSession)
    st = (status.join(F.broadcast(est), "schema", "left")
          .withColumn("_recs", F.coalesce("records_per_chunk", F.lit(cfg.DEFAULT_RECORDS_PER_CHUNK)))
          .withColumn("_mb", F.coalesce("mb_per_chunk", F.lit(cfg.DEFAULT_MB_PER_CHUNK)))
          .withColumn("_usd", F.coalesce("usd_per_gb", F.lit(cfg.DEFAULT_USD_PER_GB)))
          .drop("records_per_chunk", "mb_per_chunk", "usd_per_gb"))
    return estimate_from(st)


def estimate_from(st: DataFrame) -> DataFrame:
    g = st.groupBy("schema").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if("cached").alias("n_cached"),
        F.first("_recs").alias("records_per_chunk"),
        F.first("_mb").alias("mb_per_chunk"),
        F.first("_usd").alias("usd_per_gb"),
        F.count_distinct("symbol").alias("n_tickers"),
        F.count_distinct("venue").alias("n_venues"),
        F.count_distinct("year_month").alias("n_months"),
        F.min("year_month").alias("first_month"),
        F.max("year_month").alias("last_month"))
    todo = F.col("n_total") - F.col("n_cached")
    gb = todo * F.col("mb_per_chunk") / 1024.0
    return g.select(
        "schema", "n_total", "n_cached", todo.alias("n_todo"),
        (todo * F.col("records_per_chunk")).alias("est_records"),
        gb.alias("est_gb"), (gb * F.col("usd_per_gb")).alias("est_usd"),
        (todo / F.lit(cfg.CHUNKS_PER_HOUR)).alias("est_hours"),
        F.try_divide(F.col("n_cached") * 100.0, F.col("n_total")).alias("cached_pct"),
        "n_tickers", "n_venues", "n_months", "first_month", "last_month")


def requeue(chunks: DataFrame, quarantined: DataFrame, keys=("symbol",)) -> DataFrame:
    """Chunks of quarantined keys, with fresh month bounds, to re-ingest with ``force``."""
    k = list(keys)
    q = chunks.join(quarantined.select(*k).distinct(), k, "left_semi")
    s, e = K.month_bounds(F.col("year_month"))
    return q.select(*CHUNK_KEY, s.alias("start"), e.alias("end"), F.lit(True).alias("force"))


def ingest_ledger(status: DataFrame, landing_counts: DataFrame, force: bool = False) -> DataFrame:
    """C1/C2 result rows: cached chunks are reported as such; the rest take their outcome from the writer.

    ``landing_counts``: (chunk key..., rows) of the landing zone or, from a writer, with ``success``, ``message``
    and ``elapsed`` too. A chunk absent from it is an empty chunk (symbol not traded there that month), which
    is a success with 0 rows.
    """
    cached = F.col("cached") & F.lit(not force)
    told = {c: F.col(c) if c in landing_counts.columns else F.lit(None).cast(t)
            for c, t in (("success", "boolean"), ("message", "string"), ("elapsed", "double"))}
    lc = landing_counts.select(*CHUNK_KEY, F.col("rows").alias("_lrows"), *[c.alias(f"_{n}") for n, c in told.items()])
    j = status.join(lc, CHUNK_KEY, "left")
    rows = F.when(cached, F.col("rows")).otherwise(F.coalesce(F.col("_lrows"), F.lit(0))).cast("bigint")
    success = cached | F.coalesce(F.col("_success"), F.lit(True))
    msg = (F.when(cached, F.format_string("cached (%,d rows)", F.col("rows")))
           .when(~success, truncate(F.col("_message")))
           .when(rows > 0, F.format_string("%,d rows", rows))
           .otherwise(F.lit("0 rows (symbol absent at venue)")))
    return j.select(*CHUNK_KEY, success.alias("success"), msg.alias("message"), rows.alias("rows"),
                    F.when(cached, 0.0).otherwise(F.coalesce("_elapsed", F.lit(0.0))).alias("elapsed"), cached.alias("cached"))


def _ingest_totals() -> list:
    ok, c = F.col("success"), F.col("cached")
    return [F.count(F.lit(1)).alias("total"),
            F.count_if(ok & ~c).alias("downloaded"),
            F.count_if(c).alias("cached"),
            F.count_if(~ok).alias("failed"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_rows")]


def ingest_summary(ledger: DataFrame) -> DataFrame:
    """Totals of an ingest ledger."""
    return ledger.agg(*_ingest_totals())


def by_schema(rows: DataFrame, totals: list) -> DataFrame:
    """The totals of every schema and, as ``all``, of the whole run, in one pass over the rows."""
    r = rows.rollup("schema").agg(F.grouping("schema").alias("_all"), *totals)
    return r.withColumn("schema", F.when(F.col("_all") == 1, "all").otherwise(F.col("schema"))).drop("_all")


def ingest_totals(ledger: DataFrame) -> DataFrame:
    """G9 over the ledgers of all schemas of a run."""
    return by_schema(ledger, _ingest_totals())


def failures(ledger: DataFrame) -> DataFrame:
    """The failed chunks with their messages, in key order."""
    return ledger.where(~F.col("success")).select(*CHUNK_KEY, "message").orderBy(*CHUNK_KEY)
