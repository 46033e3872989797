"""Chunk planning, status, estimates, key and path scalars."""
from __future__ import annotations

from pyspark.sql import functions as F

from tickgate import config as cfg
from tickgate.functions import keys as K
from tickgate.operators import planning as P
from tickgate.sources import dims


def _universe(spark, *symbols):
    return spark.createDataFrame([(s,) for s in symbols], "symbol string")


def test_late_start_venues_have_fewer_months(spark):
    plan = P.chunk_plan(_universe(spark, "AAA"), cfg.OHLCV_SCHEMA)
    months = {r["venue"]: r["n"] for r in plan.groupBy("venue").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert months["IEXG.TOPS"] == 33 and months["XNAS.ITCH"] == 48
    assert sum(months.values()) == 10 * 48 + 5 * 33
    first = plan.where("venue = 'IEXG.TOPS'").agg(F.min("year_month")).first()[0]
    assert first == "2023-04"


def test_plan_bounds_are_iso_and_exclusive(spark):
    r = P.chunk_plan(_universe(spark, "AAA"), cfg.ATS_SCHEMA, start_date="2024-01-15",
                     end_date="2024-02-10").orderBy("venue", "year_month").first()
    assert (r["year_month"], r["start"], r["end"]) == ("2024-01", "2024-01-01T00:00:00Z", "2024-02-01T00:00:00Z")


def test_empty_range_and_empty_universe(spark):
    assert P.chunk_plan(_universe(spark, "AAA"), cfg.OHLCV_SCHEMA, "2025-01-01", "2024-01-01").count() == 0
    empty = spark.createDataFrame([], "symbol string")
    st = P.chunk_status(P.chunk_plan(empty, cfg.OHLCV_SCHEMA),
                        spark.createDataFrame([], "schema string, symbol string, venue string, "
                                                  "year_month string, rows bigint, state string"))
    e = P.plan_estimate(st).collect()
    assert e == []   # no division by zero, no index error (D-20)


def test_status_and_estimate(spark):
    plan = P.chunk_plan(_universe(spark, "AAA"), cfg.OHLCV_SCHEMA, "2024-01-01", "2024-03-31")
    landed = spark.createDataFrame(
        [("ohlcv-1h", "AAA", "XNAS.ITCH", "2024-01", 10, "ok"),
         ("ohlcv-1h", "AAA", "XNAS.ITCH", "2024-02", 0, "empty"),
         ("ohlcv-1h", "AAA", "XNAS.ITCH", "2024-03", None, "corrupt")],
        "schema string, symbol string, venue string, year_month string, rows bigint, state string")
    st = P.chunk_status(plan, landed)
    states = {r["year_month"]: (r["state"], r["cached"]) for r in st.where("venue = 'XNAS.ITCH'").collect()}
    assert states == {"2024-01": ("ok", True), "2024-02": ("empty", True), "2024-03": ("corrupt", False)}
    e = P.plan_estimate(st).first()
    assert (e["n_total"], e["n_cached"], e["n_todo"]) == (45, 2, 43)
    assert e["est_records"] == 43 * 130
    assert abs(e["est_hours"] - 43 / 50) < 1e-12
    assert (e["n_tickers"], e["n_venues"], e["n_months"]) == (1, 15, 3)
    todo = P.to_fetch(st).count()
    assert todo == 43 and P.to_fetch(st, force=True).count() == 45


def test_ingest_ledger_messages(spark):
    plan = P.chunk_plan(_universe(spark, "AAA"), cfg.OHLCV_SCHEMA, "2024-01-01", "2024-01-31",)
    landed = spark.createDataFrame([("ohlcv-1h", "AAA", "XNAS.ITCH", "2024-01", 1234, "ok")],
                                   "schema string, symbol string, venue string, year_month string, "
                                   "rows bigint, state string")
    counts = spark.createDataFrame([("ohlcv-1h", "AAA", "ARCX.PILLAR", "2024-01", 5)],
                                   "schema string, symbol string, venue string, year_month string, rows bigint")
    led = {r["venue"]: r for r in P.ingest_ledger(P.chunk_status(plan, landed), counts).collect()}
    assert led["XNAS.ITCH"]["message"] == "cached (1,234 rows)" and led["XNAS.ITCH"]["cached"]
    assert led["ARCX.PILLAR"]["message"] == "5 rows"
    assert led["BATS.PITCH"]["message"] == "0 rows (symbol absent at venue)"
    s = P.ingest_summary(P.ingest_ledger(P.chunk_status(plan, landed), counts)).first()
    assert (s["total"], s["downloaded"], s["cached"], s["failed"], s["total_rows"]) == (15, 14, 1, 0, 1239)


def test_venue_codec_round_trip(spark):
    df = spark.createDataFrame([("XCIS.TRADESBBO",), ("XNAS.ITCH",)], "venue string")
    out = df.select(K.venue_safe(F.col("venue")).alias("s"), K.venue_unsafe(K.venue_safe(F.col("venue"))).alias("b"))
    got = sorted((r["s"], r["b"]) for r in out.collect())
    assert got == [("XCIS_TRADESBBO", "XCIS.TRADESBBO"), ("XNAS_ITCH", "XNAS.ITCH")]


def test_path_parsing_drops_short_paths(spark):
    df = spark.createDataFrame([("ohlcv-1h/AAA/XNAS_ITCH/2024-01.parquet",), ("ohlcv-1h/AAA.parquet",)], "p string")
    out = [r[0] for r in df.select(K.parse_chunk_relpath(F.col("p"))).collect()]
    assert out[0].asDict() == {"schema": "ohlcv-1h", "symbol": "AAA", "venue": "XNAS.ITCH", "year_month": "2024-01"}
    assert out[1] is None


def test_mode_resolution():
    assert dims.mode_schemas("lit") == ("mbp-10",)
    assert dims.mode_schemas("ohlcv") == ("ohlcv-1h",)
    assert dims.mode_schemas("all") == ("mbp-10", "trades", "ohlcv-1h")
    assert dims.mode_schemas("anything") == ("mbp-10", "trades", "ohlcv-1h")


def test_universe_file(spark, tmp_path):
    p = tmp_path / "tickers.txt"
    p.write_text(" AAA \n\nBBB\n   \nCCC\n")
    assert [r[0] for r in dims.read_universe(spark, str(p)).collect()] == ["AAA", "BBB", "CCC"]
    assert dims.read_universe(spark, str(tmp_path / "missing.txt")).count() == 0
