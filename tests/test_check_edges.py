"""Hand-made edge frames, one behaviour each (FIXTURES.md §4)."""
from __future__ import annotations

import math

from pyspark.sql import functions as F

from conftest import bar, bars, checks_of, ts
from tickgate.config import ValidationConfig
from tickgate.plans.validate import validate

JAN = "2024-01-03"   # a winter weekday: ET = UTC-5
JUL = "2024-07-03"   # a summer weekday: ET = UTC-4


def utc(day: str, hm: str) -> str:
    return f"{day} {hm}"


# ---------------------------------------------------------------- A


def test_a_threshold_is_strict(spark):
    at = validate(bars(spark, [bar(utc(JAN, "15:00:00"), 10000, 10000, 10000, 10000)]))
    above = validate(bars(spark, [bar(utc(JAN, "15:00:00"), 10000.01, 10000.01, 10000.01, 10000.01)]))
    assert checks_of(at)["A"]["status"] == "PASS"
    a = checks_of(above)["A"]
    assert a["status"] == "ABORT"
    assert a["detail"] == "median close = 10,000 > 10000 (fixed-point not converted)"


def test_a_nan_is_skipped(spark):
    nan = float("nan")
    all_nan = validate(bars(spark, [bar(utc(JAN, "15:00:00"), c=nan), bar(utc(JAN, "16:00:00"), c=nan)]))
    assert checks_of(all_nan)["A"]["status"] == "PASS"
    assert checks_of(all_nan)["A"]["detail"] == "median close = nan"
    half = validate(bars(spark, [bar(utc(JAN, "15:00:00"), c=nan), bar(utc(JAN, "16:00:00"), c=4.0),
                                 bar(utc(JAN, "17:00:00"), c=8.0)]))
    assert math.isclose(half.wide.first()["median_close"], 6.0)


def test_a_median_even_and_odd(spark):
    rows = [bar(utc(JAN, f"{h:02d}:00:00"), c=c) for h, c in zip(range(10, 14), [5.0, 1.0, 3.0, 3.0])]
    v = validate(bars(spark, rows))
    assert v.wide.first()["median_close"] == 3.0
    rows = [bar(utc(JAN, f"{h:02d}:00:00"), c=c) for h, c in zip(range(10, 14), [5.0, 1.0, 2.0, 4.0])]
    assert validate(bars(spark, rows)).wide.first()["median_close"] == 3.0


# ---------------------------------------------------------------- B


def test_b_volume_and_prices(spark):
    zero = checks_of(validate(bars(spark, [bar(utc(JAN, "15:00:00"), v=0.0)])))["B"]
    assert zero["status"] == "PASS" and zero["metrics"]["n_zero_volume"] == 1
    neg = checks_of(validate(bars(spark, [bar(utc(JAN, "15:00:00"), v=-1.0)])))["B"]
    assert neg["status"] == "ABORT" and neg["metrics"]["n_neg_volume"] == 1
    low0 = checks_of(validate(bars(spark, [bar(utc(JAN, "15:00:00"), lo=0.0)])))["B"]
    assert low0["status"] == "ABORT"


def test_b_counts_cells_not_rows(spark):
    b = checks_of(validate(bars(spark, [bar(utc(JAN, "15:00:00"), o=-1.0, lo=-2.0)])))["B"]
    assert b["metrics"]["n_bad_ohlc"] == 2
    assert b["detail"] == "2 rows with OHLC ≤ 0; 0 rows with volume < 0"


# ---------------------------------------------------------------- C


def _ordered(spark, times):
    rows = [("S", "XNAS.ITCH", ts(t) if t else None, 1.0, 1.0, 1.0, 1.0, 1.0, "f1", i)
            for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "symbol string, venue string, ts_event timestamp_ntz, open double, "
                                       "high double, low double, close double, volume double, "
                                       "file_path string, row_index bigint")


def test_c_equal_steps_pass_back_step_aborts(spark):
    eq = validate(_ordered(spark, [utc(JAN, "15:00:00"), utc(JAN, "15:00:00"), utc(JAN, "16:00:00")]))
    assert checks_of(eq)["C"]["status"] == "PASS"
    back = validate(_ordered(spark, [utc(JAN, "15:00:00"), utc(JAN, "17:00:00"), utc(JAN, "16:00:00")]))
    c = checks_of(back)["C"]
    assert c["status"] == "ABORT" and c["metrics"]["n_violations"] == 1


def test_c_null_timestamp_aborts(spark):
    v = validate(_ordered(spark, [utc(JAN, "15:00:00"), None, utc(JAN, "16:00:00")]))
    c = checks_of(v)["C"]
    assert c["status"] == "ABORT" and c["metrics"]["n_null_ts"] == 1


def test_c_block_boundaries(spark):
    times = [utc(JAN, f"{h:02d}:00:00") for h in range(0, 20)]
    times[10], times[11] = times[11], times[10]   # one back step across the 5-row block edge at 10
    times[15], times[14] = times[14], times[15]
    for block in (1, 2, 3, 5, 7, 100):
        cfg = ValidationConfig(c_block_rows=block)
        c = checks_of(validate(_ordered(spark, times), cfg))["C"]
        assert c["metrics"]["n_violations"] == 2, block


def test_c_sorted_mode_passes(spark):
    v = validate(_ordered(spark, [utc(JAN, "17:00:00"), utc(JAN, "16:00:00")]), ValidationConfig(c_order="sorted"))
    assert checks_of(v)["C"]["status"] == "PASS"


# ---------------------------------------------------------------- D


def test_d_missing_column(spark):
    df = bars(spark, [bar(utc(JAN, "15:00:00"))]).drop("volume")
    c = checks_of(validate(df))
    assert c["D"]["status"] == "ABORT"
    assert c["D"]["samples"] == ["volume"]
    assert c["D"]["detail"] == "missing columns: ['volume']"
    assert c["H"]["status"] == "PASS" and c["H"]["detail"] == "required columns absent for check H"
    assert c["J"]["status"] == "PASS"


def test_d_no_time_axis(spark):
    df = bars(spark, [bar(utc(JAN, "15:00:00"))]).drop("ts_event")
    c = checks_of(validate(df))
    assert c["D"]["status"] == "ABORT" and "ts_event" in c["D"]["samples"]
    assert c["C"]["detail"] == "no datetime index or empty"


def test_time_axis_candidates(spark):
    df = bars(spark, [bar(utc(JAN, "15:00:00"))]).withColumnRenamed("ts_event", "Datetime")
    v = validate(df)
    assert v.norm.time_axis == "Datetime"
    assert checks_of(v)["D"]["status"] == "PASS"


# ---------------------------------------------------------------- E


def test_e_session_bounds_winter(spark):
    # 09:29:59, 09:30:00, 15:59:59, 16:00:00 ET in January = UTC + 5h
    rows = [bar(utc(JAN, t)) for t in ("14:29:59", "14:30:00", "20:59:59", "21:00:00")]
    v = validate(bars(spark, rows))
    e = checks_of(v)["E"]
    assert e["metrics"]["n_kept"] == 2 and e["metrics"]["n_dropped"] == 2
    kept = sorted(r["ts_event"].strftime("%H:%M:%S") for r in v.clean.collect())
    assert kept == ["14:30:00", "20:59:59"]


def test_e_daylight_saving(spark):
    rows = [bar(utc(JUL, "13:30:00")), bar(utc(JAN, "14:30:00"))]
    v = validate(bars(spark, rows))
    assert checks_of(v)["E"]["metrics"]["n_kept"] == 2


def test_e_dst_switch_days(spark):
    # 2024-03-10 (spring forward) and 2024-11-03 (fall back): 10:00 ET is 14:00 UTC and 15:00 UTC
    rows = [bar("2024-03-10 14:00:00"), bar("2024-11-03 15:00:00"), bar("2024-03-10 13:00:00")]
    v = validate(bars(spark, rows))
    assert checks_of(v)["E"]["metrics"]["n_kept"] == 2


# ---------------------------------------------------------------- F


def test_f_three_copies(spark):
    rows = [bar(utc(JAN, "15:00:00"), venue=v) for v in ("A.X", "B.X", "C.X")]
    f = checks_of(validate(bars(spark, rows)))["F"]
    assert f["status"] == "WARNING" and f["metrics"]["n_dups"] == 2


def test_f_venue_grain_has_no_cross_venue_copies(spark):
    rows = [bar(utc(JAN, "15:00:00"), venue=v) for v in ("A.X", "B.X")]
    v = validate(bars(spark, rows), ValidationConfig(keys=("symbol", "venue")))
    assert {r["status"] for r in v.check_results.where("check = 'F'").collect()} == {"PASS"}


# ---------------------------------------------------------------- H


def _two_days(spark, p1, p2, v1=100.0, v2=100.0):
    return bars(spark, [bar("2024-01-03 15:00:00", c=p1, v=v1, o=p1, h=p1, lo=p1),
                        bar("2024-01-04 15:00:00", c=p2, v=v2, o=p2, h=p2, lo=p2)])


def test_h_threshold(spark):
    assert checks_of(validate(_two_days(spark, 100, 129)))["H"]["status"] == "PASS"
    assert checks_of(validate(_two_days(spark, 100, 131)))["H"]["status"] == "WARNING"
    # 130/100 - 1 is 0.30000000000000004 in doubles: flagged, as in the reference
    h = checks_of(validate(_two_days(spark, 100, 130)))["H"]
    assert h["status"] == "WARNING" and h["samples"] == ["2024-01-04"]


def test_h_zero_volume_day_is_skipped(spark):
    rows = [bar("2024-01-03 15:00:00", c=100, o=100, h=100, lo=100),
            bar("2024-01-04 15:00:00", c=500, o=500, h=500, lo=500, v=0.0),
            bar("2024-01-05 15:00:00", c=140, o=140, h=140, lo=140)]
    v = validate(bars(spark, rows))
    h = checks_of(v)["H"]
    assert h["status"] == "WARNING" and h["samples"] == ["2024-01-05"]
    assert v.wide.first()["n_vwap_days"] == 2


def test_h_zero_base_is_flagged(spark):
    h = checks_of(validate(_two_days(spark, 0.0, 5.0)))["H"]
    assert h["status"] == "WARNING"


def test_h_fractional_volume_divides_by_one(spark):
    v = validate(bars(spark, [bar("2024-01-03 15:00:00", c=10.0, v=0.5)]))
    assert v.vwap_days.first()["vwap"] == 5.0


# ---------------------------------------------------------------- I


def _hours(spark, day, hours_et):
    # winter: ET hour h is UTC h+5
    return bars(spark, [bar(f"{day} {h + 5:02d}:{m:02d}:00") for h, m in hours_et])


def test_i_gaps(spark):
    assert checks_of(validate(_hours(spark, JAN, [(10, 0), (11, 0), (13, 0)])))["I"]["metrics"]["n_missing_bars"] == 1
    assert checks_of(validate(_hours(spark, JAN, [(11, 0), (12, 0)])))["I"]["status"] == "PASS"
    assert checks_of(validate(_hours(spark, JAN, [(11, 0)])))["I"]["status"] == "PASS"


def test_i_off_grid_bars_do_not_fill(spark):
    v = validate(_hours(spark, JAN, [(10, 10), (12, 5)]))
    i = checks_of(v)["I"]
    assert i["metrics"]["n_missing_bars"] == 1
    assert i["samples"] == ["2024-01-03: ['2024-01-03 11:10:00-05:00']"]


def test_i_samples_are_capped(spark):
    rows = []
    for d in range(1, 9):
        day = f"2024-01-{d + 1:02d}"
        rows += [bar(f"{day} 15:00:00"), bar(f"{day} 19:00:00")]   # 10:00 and 14:00 ET: 3 missing
    i = checks_of(validate(bars(spark, rows)))["I"]
    assert i["metrics"]["n_missing_bars"] == 24 and i["metrics"]["n_days_gappy"] == 8
    assert len(i["samples"]) == 5
    assert i["samples"][0].startswith("2024-01-02: ['2024-01-02 11:00:00-05:00'")
    assert i["samples"][0].count("-05:00") == 3


# ---------------------------------------------------------------- J


def test_j_high_below_low(spark):
    j = checks_of(validate(bars(spark, [bar(utc(JAN, "15:00:00"), o=10, h=9, lo=11, c=10)])))["J"]
    m = j["metrics"]
    assert j["status"] == "ABORT" and m["n_bad_high_low"] == 1
    assert m["n_bad_high"] + m["n_bad_low"] >= 1


# ---------------------------------------------------------------- empty frames, verdict


def test_empty_frame_with_expected_key(spark):
    empty = bars(spark, [])
    keys = spark.createDataFrame([("S",)], "symbol string")
    v = validate(empty, expected_keys=keys)
    c = checks_of(v)
    assert {k: r["status"] for k, r in c.items()} == {k: "PASS" for k in "ABCDJEFHI"}
    assert v.report.first()["n_rows_in"] == 0


def test_verdict_and_warning_order(spark):
    rows = [bar(utc(JAN, "15:00:00"), venue="A.X"), bar(utc(JAN, "15:00:00"), venue="B.X"),
            bar(utc(JAN, "17:00:00"), v=-1.0)]
    r = validate(bars(spark, rows)).report.first()
    assert r["quarantine"] is True
    assert r["warnings"] == ["F", "I"]
    assert set(r["checks"].keys()) == set("ABCDJEFHI")


def test_clean_frame_excludes_quarantined(spark):
    rows = [bar(utc(JAN, "15:00:00"), symbol="OK"), bar(utc(JAN, "15:00:00"), symbol="BAD", lo=-1.0)]
    v = validate(bars(spark, rows))
    assert [r["symbol"] for r in v.clean.collect()] == ["OK"]
    assert v.report.where(F.col("quarantine")).count() == 1


def test_median_buckets_agree_with_pandas(spark):
    import random

    import pandas as pd

    from tickgate.operators import checks as C
    from tickgate.operators.normalize import normalize_bars
    rnd = random.Random(7)
    rows = []
    for sym, n in (("X", 1001), ("Y", 1000), ("Z", 1), ("W", 2)):
        for i in range(n):
            price = round(rnd.choice([rnd.uniform(1, 5), rnd.uniform(100, 101), 3.25]), 2)
            rows.append(bar(f"2024-01-03 15:{i % 60:02d}:00", c=price, symbol=sym))
    df = bars(spark, rows)
    want = pd.DataFrame([(r[0], r[6]) for r in rows], columns=["s", "c"]).groupby("s")["c"].median().to_dict()
    norm = normalize_bars(df).df
    for nb in (1, 2, 7, 1024):
        got = {r["symbol"]: r["median_close"] for r in C.median_close(norm, buckets=nb).collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert math.isclose(got[k], want[k], rel_tol=0, abs_tol=1e-12), (nb, k)


def test_quarantine_preview_first_20_and_remainder(spark):
    from tickgate.operators import verdict as V
    rows = [bar(utc(JAN, "15:00:00"), symbol=f"S{i:02d}", lo=-1.0) for i in range(25)]
    rows.append(bar(utc(JAN, "15:00:00"), symbol="OK"))
    rep = validate(bars(spark, rows)).report
    p = V.quarantine_preview(rep, ["symbol"]).orderBy("rank").collect()
    assert [r["symbol"] for r in p] == [f"S{i:02d}" for i in range(20)]
    assert {(r["n_quarantined"], r["n_more"]) for r in p} == {(25, 5)}
    s = V.validation_summary(rep).first()
    assert (s["total"], s["quarantined"], s["passed"] + s["warned"]) == (26, 25, 1)


def test_approx_median_is_close_to_exact(spark):
    import random

    from tickgate.operators import checks as C
    from tickgate.operators.normalize import normalize_bars
    rnd = random.Random(3)
    rows = [bar(f"2024-01-03 15:{i % 60:02d}:00", c=round(rnd.uniform(10, 20), 2), symbol="X") for i in range(2001)]
    norm = normalize_bars(bars(spark, rows)).df
    exact = C.median_close(norm).first()["median_close"]
    approx = C.median_close_approx(norm, accuracy=10_000).first()["median_close"]
    closes = sorted(r[6] for r in rows)
    rank = sum(1 for c in closes if c <= approx)
    assert abs(rank - 1001) <= 2001 / 10_000 * 2 + 1
    assert abs(approx - exact) < 0.05
