"""Validation from stored partial aggregates equals a full one, and reads only what is new."""
from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import bar, bars
from tickgate.config import OHLCV_SCHEMA
from tickgate.plans import incremental as I
from tickgate.plans.validate import validate, validate_layout
from tickgate.sinks import writers as W
from tickgate.sources import reports
from tickgate.streaming import landing as S

DAYS = ["2024-01-03", "2024-02-06"]


def _landing(spark, symbols, **kw):
    rows = [bar(f"{d}T{h}:30:00", symbol=s, v=100.0 + i, venue=v, **kw) for s in symbols for d in DAYS
            for v in ("XNAS.ITCH", "ARCX.PILLAR") for i, h in enumerate((15, 16, 18))]
    return bars(spark, rows).withColumn("schema", F.lit(OHLCV_SCHEMA))


def _rows(v):
    return sorted((r["symbol"], r["check"], r["status"], r["detail"], tuple(r["samples"])) for r in v.check_results.collect())


def test_changed_chunks_only_are_read(spark, tmp_path, monkeypatch):
    root, state = str(tmp_path / "cache"), str(tmp_path / "state")
    W.write_chunk_files(_landing(spark, ("AAA", "BBB", "CCC")), root).count()
    run = lambda: I.validate_incremental(spark, root, state)
    one = run()
    assert (one.scanned, one.reused) == (12, 0) and _rows(one.validation) == _rows(validate_layout(spark, root))

    # nothing new: no chunk is scanned, and no row of any is read
    with monkeypatch.context() as m:
        m.setattr(I, "partial_aggregates", None)
        m.setattr(I.files, "parquet_footers", None)
        two = run()
    assert (two.scanned, two.reused) == (0, 12) and _rows(two.validation) == _rows(one.validation)

    # a chunk rewritten with bad prices, one damaged, one gone, one that lacks a column, one new symbol
    time.sleep(1.1)
    W.write_chunk_files(_landing(spark, ("AAA",), lo=-1.0).where("venue = 'XNAS.ITCH' AND month(ts_event) = 1"), root).count()
    folder = tmp_path / "cache" / OHLCV_SCHEMA
    (folder / "BBB" / "XNAS_ITCH" / "2024-01.parquet").write_bytes(b"damaged")
    os.remove(folder / "CCC" / "XNAS_ITCH" / "2024-02.parquet")
    W.write_chunk_files(_landing(spark, ("DDD",)), root).count()
    W.write_chunk_files(_landing(spark, ("EEE",)).drop("volume"), root).count()
    three = run()
    assert (three.scanned, three.reused) == (10, 9)
    got, want = _rows(three.validation), _rows(validate_layout(spark, root))
    assert got == want
    status = {(s, c): st for s, c, st, _, _ in got}
    assert (status["AAA", "B"], status["BBB", "D"], status["EEE", "D"], status["DDD", "B"]) == ("ABORT", "ERROR", "ABORT", "PASS")
    with pytest.raises(ValueError):
        three.validation.clean  # noqa: B018


def test_a_run_that_dies_before_its_commit_is_read_again(spark, tmp_path, monkeypatch):
    root, state = str(tmp_path / "cache"), str(tmp_path / "state")
    W.write_chunk_files(_landing(spark, ("AAA",)), root).count()

    def kill(*a, **k):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(I.SnapshotTable, "commit", kill)
        with pytest.raises(KeyboardInterrupt):
            I.validate_incremental(spark, root, state)
    again = I.validate_incremental(spark, root, state)
    assert again.scanned == 4 and again.validation.report.first().n_rows_in == 12


def test_stream_folds_each_file_once(spark, tmp_path, monkeypatch):
    land, rep, ck, state = (str(tmp_path / n) for n in ("land", "rep", "ck", "state"))
    go = lambda: S.revalidate_on_arrival(spark, land, rep, ck, state_root=state).awaitTermination(300)
    monkeypatch.setattr(S, "_history", None)          # the landing folder is not read again
    W.write_chunk_files(_landing(spark, ("AAA", "BBB")), land).count()
    go()
    W.write_chunk_files(_landing(spark, ("BBB", "CCC"), lo=-1.0).withColumn("ts_event", F.expr("ts_event + INTERVAL 60 DAY")), land).count()
    go()
    got = {r.symbol: (r.quarantine, r.n_rows_in) for r in reports.read_reports(spark, rep).collect()}
    files_ = spark.read.schema(S.BAR_STREAM_SCHEMA).option("recursiveFileLookup", "true").parquet(land)
    want = {r.symbol: (r.quarantine, r.n_rows_in) for r in validate(files_).report.collect()}
    assert got == want and got["BBB"] == (True, 24) and got["AAA"] == (False, 12)
