"""The streaming form re-validates exactly the keys whose files arrived."""
from __future__ import annotations

import os

import pytest

from tickgate.config import OHLCV_SCHEMA
from tickgate.plans.validate import validate
from tickgate.sinks import writers as W
from tickgate.sources import bars as B
from tickgate.sources import reports
from tickgate.streaming import landing as S

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_revalidate_on_arrival(spark, tmp_path):
    from pyspark.sql import functions as F
    bars = B.bars_from_events(spark.read.parquet(f"{SF}/events.parquet")).withColumn("volume", F.col("volume").cast("double"))
    land, rep, ck = str(tmp_path / "land"), str(tmp_path / "rep"), str(tmp_path / "ck")
    first = bars.where("symbol IN ('click', 'error')").withColumn("schema", F.lit(OHLCV_SCHEMA))
    W.write_chunk_files(first, land).count()
    q = S.revalidate_on_arrival(spark, land, rep, ck)
    q.awaitTermination(300)
    got = reports.read_reports(spark, rep)
    assert sorted(r["symbol"] for r in got.collect()) == ["click", "error"]

    rest = bars.where("symbol NOT IN ('click', 'error')").withColumn("schema", F.lit(OHLCV_SCHEMA))
    W.write_chunk_files(rest, land).count()
    q = S.revalidate_on_arrival(spark, land, rep, ck)
    q.awaitTermination(300)
    got = reports.read_reports(spark, rep).select("symbol", "quarantine", "n_rows_in")
    want = validate(bars).report.select("symbol", "quarantine", "n_rows_in")
    assert sorted(got.collect()) == sorted(want.collect())


def test_row_checks_stream(spark, tmp_path):
    from pyspark.sql import functions as F
    bars = B.bars_from_events(spark.read.parquet(f"{SF}/events.parquet")).withColumn("volume", F.col("volume").cast("double"))
    land, out, ck = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ck")
    W.write_chunk_files(bars.withColumn("schema", F.lit(OHLCV_SCHEMA)), land).count()
    S.start_row_checks(spark, land, out, ck).awaitTermination(300)
    tallies = spark.read.parquet(out)
    tot = tallies.groupBy("symbol").agg(F.sum("n_rows").alias("n"), F.sum("n_bad_ohlc").alias("b"))
    by = {r["symbol"]: (r["n"], r["b"]) for r in tot.collect()}
    v = validate(bars).wide
    want = {r["symbol"]: (r["n_rows"], r["n_bad_ohlc"]) for r in v.collect()}
    assert by == want


def test_revalidate_on_hive_landing_prunes(spark, tmp_path):
    from pyspark.sql import functions as F
    bars = B.bars_from_events(spark.read.parquet(f"{SF}/events.parquet")).withColumn("volume", F.col("volume").cast("double"))
    root, rep, ck = str(tmp_path / "hive"), str(tmp_path / "rep"), str(tmp_path / "ck")
    W.write_chunks(bars.withColumn("schema", F.lit(OHLCV_SCHEMA)), root)
    land = f"{root}/schema={OHLCV_SCHEMA}"
    S.revalidate_on_arrival(spark, land, rep, ck, layout="hive").awaitTermination(300)
    got = reports.read_reports(spark, rep).select("symbol", "quarantine", "n_rows_in")
    want = validate(bars).report.select("symbol", "quarantine", "n_rows_in")
    assert sorted(got.collect()) == sorted(want.collect())
    # the history read keeps only the touched symbols' rows
    schema = ("ts_event timestamp_ntz, open double, high double, low double, close double, volume double, "
              + S.HIVE_PARTITIONS)
    touched = F.broadcast(spark.createDataFrame([("click",)], "symbol string"))
    kept = S._history(spark, land, schema, "hive").join(touched, ["symbol"], "left_semi")
    assert kept.count() == bars.where("symbol = 'click'").count()
