"""Order folded in the scan, and gaps and duplicates on bitmaps, against brute force."""
from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickgate.config import ValidationConfig
from tickgate.operators import checks as C
from tickgate.operators.normalize import normalize_bars
from tickgate.sources import bars as B

T0 = dt.datetime(2024, 1, 3, 15)


def _files(spark, root, n_files=3, n=400, seed=1):
    """Files with interleaved keys, NULL keys and NULL times; returns their frame and the expected counts."""
    rng = random.Random(seed)
    want: dict = {}
    for f in range(n_files):
        rows, last = [], {}
        for _ in range(n):
            key = (rng.choice(["A", "B", None]), rng.choice(["V", "W"]))
            t = None if rng.random() < 0.05 else T0 + dt.timedelta(seconds=rng.randrange(40))
            prev = last.get(key)
            want.setdefault(key, 0)
            want[key] += prev is not None and t is not None and t < prev
            last[key] = t
            rows.append((*key, t))
        spark.createDataFrame(rows, "symbol string, venue string, ts_event timestamp_ntz").coalesce(1) \
            .write.option("parquet.block.row.count.limit", "37").parquet(f"{root}/f{f}")
    df = B.with_file_order(spark.read.option("recursiveFileLookup", "true").parquet(str(root)))
    return df, want


def _got(df):
    return {tuple(r)[:-1]: r["n_violations"] for r in df.collect()}


def test_order_states_against_brute_force(spark, tmp_path, monkeypatch):
    df, want = _files(spark, tmp_path)
    assert _got(C.order_violations(df, ["symbol", "venue"])) == want
    assert _got(C.order_violations_blocked(df, ["symbol", "venue"], block_rows=7)) == want
    monkeypatch.setattr(C, "RUNS", 1)              # states emitted after every batch
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "23")
    try:
        assert _got(C.order_violations(df, ["symbol", "venue"])) == want
        states = C.order_runs(df, ["symbol", "venue"])
        assert states.count() > 18
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_rows_out_of_file_order_are_sorted(spark, tmp_path):
    df, want = _files(spark, tmp_path, seed=2)
    mixed = df.repartition(5, F.rand(3))
    assert _got(C.order_violations(mixed, ["symbol", "venue"])) == want
    dates = spark.createDataFrame([("f", 0, "b"), ("f", 1, "a")], "file_path string, row_index bigint, ts_event string")
    assert _got(C.order_violations(dates.withColumn("k", F.lit(1)), ["k"])) == {(1,): 1}
    assert C.order_violations(df.limit(0), ["symbol", "venue"]).count() == 0


def test_order_check_neither_shuffles_nor_sorts_rows(spark, tmp_path):
    df, _ = _files(spark, tmp_path, n_files=1, n=20)
    plan = C.order_runs(df, ["symbol"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def _brute_gaps(rows, grid):
    days: dict = {}
    for key, t in rows:
        days.setdefault((key, t.date()), []).append(t)
    out = {}
    for k, ts in days.items():
        first, last = min(ts), max(ts)
        n = int((last - first) / dt.timedelta(seconds=grid)) + 1
        filled = {int((t - first) / dt.timedelta(seconds=grid)) for t in ts if not ((t - first) % dt.timedelta(seconds=grid))}
        out[k] = (len(ts) - len(set(ts)), n - len(filled), [s for s in range(n) if s not in filled])
    return out


@pytest.mark.parametrize("grid", [1, 7, 3600])
def test_gaps_and_duplicates_on_any_grid(spark, grid):
    """One key's day holds most rows, on and off the grid; another day has seconds only."""
    rng = random.Random(grid)
    # session hours of one ET date are one UTC date in January
    at = lambda day, us: T0 + dt.timedelta(days=day, microseconds=us)
    rows = [("HOT", at(0, rng.randrange(21_000) * 1_000_000 + rng.choice([0, 0, 0, rng.randrange(1_000_000)]))) for _ in range(6000)]
    rows += [(rng.choice(["A", None]), at(rng.randrange(3), rng.randrange(6) * 3600 * 1_000_000)) for _ in range(60)]
    rows += [("ONE", at(1, 5))] * 3
    cfg = ValidationConfig(grid_seconds=grid)
    df = spark.createDataFrame([(k, "V", t, 1.0, 1.0, 1.0, 1.0, 1.0) for k, t in rows],
                               "symbol string, venue string, ts_event timestamp_ntz, open double, high double, low double, "
                               "close double, volume double")
    norm = normalize_bars(df, cfg).df
    got = {(r.symbol, r.et_date): (r.n_dups, r.n_missing, r.missing_slots)
           for r in C.gaps_and_duplicates(norm, C.daily_table(norm, cfg), cfg).collect()}
    assert got == _brute_gaps(rows, grid)


def test_bracketed_median_is_exact(spark):
    """A hot key of distinct prices, ties, two rows, infinities and a bracket that misses the middle."""
    import statistics
    rng = random.Random(4)
    vals = {"HOT": [rng.lognormvariate(3, 2) for _ in range(20_000)], "TIES": [1.0] * 500 + [2.0] * 501, "TWO": [1.0, 4.0],
            "INF": [float("inf")] * 3 + [1.0] * 3, None: [5.0, -1.0, 7.0]}
    df = spark.createDataFrame([(k, v) for k, vs in vals.items() for v in vs] + [("NONE", None)], "symbol string, close double")
    want = {k: statistics.median(v) for k, v in vals.items()}
    for how in ({}, {"sketch": 8, "margin": 0.0001}):
        assert {r.symbol: r.median_close for r in C.median_close_bracketed(df, **how).collect()} == want


def test_validation_with_a_bracketed_median(spark):
    from tickgate.plans.validate import validate
    df = B.bars_from_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    key = lambda v: sorted((r["symbol"], r["check"], r["status"], r["detail"]) for r in v.check_results.collect())
    assert key(validate(df, ValidationConfig(a_method="bracket"))) == key(validate(df))


def test_universe_of_an_absent_file_is_empty(spark, tmp_path):
    from tickgate.sources import dims
    assert dims.read_universe(spark, str(tmp_path / "none.txt")).count() == 0
    with pytest.raises(Exception):
        dims.read_universe(spark, "nosuchscheme://x/y")
