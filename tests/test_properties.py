"""Properties that hold for any input, plus file-level cross-checks."""
from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import bar, bars, checks_of
from tickgate.operators import verdict as V
from tickgate.plans.validate import validate
from tickgate.sources import bars as B
from tickgate.sources import files

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def ev_bars(spark):
    return B.bars_from_events(spark.read.parquet(f"{SF}/events.parquet"))


def _statuses(v):
    return {(r["symbol"], r["check"]): (r["status"], r["detail"]) for r in v.check_results.collect()}


def test_row_order_only_moves_check_c(spark, ev_bars):
    ordered = ev_bars.withColumn("file_path", F.lit("f")).withColumn(
        "row_index", F.row_number().over(Window.orderBy("symbol", "ts_event", "venue")) - 1)
    shuffled = ev_bars.withColumn("file_path", F.lit("f")).withColumn(
        "row_index", F.row_number().over(Window.orderBy(F.xxhash64("symbol", "ts_event", "venue"))) - 1)
    a, b = _statuses(validate(ordered)), _statuses(validate(shuffled))
    assert {k: v for k, v in a.items() if k[1] != "C"} == {k: v for k, v in b.items() if k[1] != "C"}
    assert {v[0] for k, v in a.items() if k[1] == "C"} == {"PASS"}
    assert "ABORT" in {v[0] for k, v in b.items() if k[1] == "C"}


def test_price_scaling_keeps_vwap_shifts(spark, ev_bars):
    doubled = ev_bars.select("symbol", "venue", "ts_event", *[(F.col(c) * 2).alias(c) for c in
                                                              ("open", "high", "low", "close")], "volume")
    a = {r["symbol"]: (r["status"], r["samples"]) for r in validate(ev_bars).check_results.where("check = 'H'").collect()}
    b = {r["symbol"]: (r["status"], r["samples"]) for r in validate(doubled).check_results.where("check = 'H'").collect()}
    assert a == b


def test_deleting_an_inner_bar_adds_one_gap(spark):
    hours = [15, 16, 17, 18]   # 10:00-13:00 ET in January
    full = [bar(f"2024-01-03 {h}:00:00") for h in hours]
    assert checks_of(validate(bars(spark, full)))["I"]["status"] == "PASS"
    cut = [r for r in full if r[2].hour != 16]
    assert checks_of(validate(bars(spark, cut)))["I"]["metrics"]["n_missing_bars"] == 1


def test_summary_classes_partition_the_total(spark, ev_bars):
    wide_bars = B.bars_from_events(spark.read.parquet(f"{SF}/events.parquet"), wide=True)
    s = V.validation_summary(validate(wide_bars).report).first()
    assert s["passed"] + s["warned"] + s["quarantined"] == s["total"] > 0


def test_digests_match_hashlib(spark):
    got = {os.path.basename(r["path"]): r["md5"] for r in files.file_digests(spark, SF).collect()}
    for name, md5 in got.items():
        with open(os.path.join(SF, name), "rb") as fh:
            assert hashlib.md5(fh.read()).hexdigest() == md5
    assert len(got) == len([f for f in os.listdir(SF) if f.endswith(".parquet")])


def test_footer_counts_match_scans(spark):
    probe = {r["path"].rsplit("/", 1)[-1]: r["rows"] for r in files.file_probe(spark, SF).collect()}
    for name in ("orders.parquet", "events.parquet"):
        assert probe[name] == spark.read.parquet(f"{SF}/{name}").count()
