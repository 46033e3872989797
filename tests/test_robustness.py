"""Workflows over awkward inputs: roots of any form, NULL keys, damaged files, failing copies, reruns."""
from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import bar, bars
from tickgate.config import OHLCV_SCHEMA, ValidationConfig
from tickgate.operators import planning as PL
from tickgate.operators import publishing as PB
from tickgate.plans import publish as PU
from tickgate.sinks.snapshots import ConflictingLoad, SnapshotTable
from tickgate.plans.ingest import ingest, probe_landed
from tickgate.plans.validate import validate, validate_layout
from tickgate.sinks import writers as W
from tickgate.sinks.chunk_source import ChunkFile, ChunkWriter
from tickgate.sources import bars as B
from tickgate.sources import files, reports

DAY = [f"2024-01-03T{h}:30:00" for h in range(15, 20)]


def _landing(spark, symbols=("AAA", "BBB"), **kw):
    rows = [bar(t, symbol=s, v=100.0 + i, **kw) for s in symbols for i, t in enumerate(DAY)]
    return bars(spark, rows).withColumn("schema", F.lit(OHLCV_SCHEMA))


def test_roots_of_any_form(spark, tmp_path, monkeypatch):
    W.write_chunk_files(_landing(spark), str(tmp_path / "cache")).count()
    monkeypatch.chdir(tmp_path)
    for root in (str(tmp_path / "cache"), f"file://{tmp_path}/cache", f"file:{tmp_path}/cache/", "cache"):
        if root == "cache":      # relative to the JVM's folder, which does not follow chdir
            root = os.path.relpath(tmp_path / "cache", spark._jvm.java.lang.System.getProperty("user.dir"))
        assert files.chunk_probe(spark, root, OHLCV_SCHEMA).count() == 2, root
        assert B.read_chunks(spark, root).count() == 10, root


def test_a_path_outside_the_root_is_an_error(spark):
    from tickgate.functions import keys as K
    df = spark.createDataFrame([("file:/a/b/c.parquet",)], "path string")
    assert df.select(K.relpath_under(F.col("path"), "file:///a/").alias("r")).first().r == "b/c.parquet"
    with pytest.raises(Exception, match="is not under"):
        df.select(K.relpath_under(F.col("path"), "file:/other")).collect()


def test_null_keys_are_judged_and_routed(spark):
    rows = [bar(t, symbol=None, o=20000.0, h=20001.0, lo=19999.0, c=20000.0) for t in DAY + DAY[:1]]
    rows += [bar(t, symbol="OK") for t in DAY]
    df = bars(spark, rows)
    v = validate(df)
    got = {r["check"]: r.status for r in v.check_results.where("symbol IS NULL").collect()}
    assert got["A"] == "ABORT" and got["F"] == "WARNING"
    clean, bad = PB.quarantine_split(df, v.report)
    assert clean.count() == 5 and bad.count() == 6
    assert {r.route for r in PB.route(df, v.report).where("symbol IS NULL").collect()} == {"quarantine"}


def test_a_damaged_report_rejects(spark, tmp_path):
    v = validate(_landing(spark))
    W.write_reports(v.report, str(tmp_path / "r"))
    path = next(p for p in (tmp_path / "r").rglob("*.json") if "_symbol=AAA" in str(p))
    path.write_text(path.read_text()[:40])
    (path.parent / f".{path.name}.crc").unlink()
    rep = reports.read_reports(spark, str(tmp_path / "r"))
    chunks = spark.createDataFrame([(OHLCV_SCHEMA, s) for s in ("AAA", "BBB", "CCC")], "schema string, symbol string")
    got = {r.symbol: (r.decision, r.validation_ok) for r in PB.publish_gate(chunks, rep).collect()}
    assert got == {"AAA": ("reject", False), "BBB": ("publish", True), "CCC": ("publish", None)}


def test_chunks_with_nulls_over_many_batches(spark, tmp_path):
    n = 60_000
    base = spark.range(n).select(
        F.when(F.col("id") < n // 2, "AAA").when(F.col("id") < n - 10, "BBB").alias("symbol"), F.lit("XNAS.ITCH").alias("venue"),
        (F.lit("2024-01-03T15:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("ts_event"),
        *[F.lit(10.0).alias(c) for c in ("open", "high", "low", "close")],
        F.when((F.col("id") % 7919 != 0) | (F.col("id") < n // 2), F.col("id")).alias("volume"))
    root = str(tmp_path / "cache")
    led = W.write_chunk_files(base.withColumn("schema", F.lit(OHLCV_SCHEMA)), root, row_group=20_000).collect()
    assert sum(r.rows for r in led) == n and {r.symbol for r in led} == {"AAA", "BBB", None}
    back = B.read_chunks(spark, root)
    assert back.count() == n and dict(back.dtypes)["volume"] == "double"
    assert back.where("volume IS NULL").count() == base.where("volume IS NULL").count()
    import pyarrow.parquet as pq
    md = pq.ParquetFile(next(r.path for r in led if r.symbol == "AAA")).metadata
    assert [md.row_group(i).num_rows for i in range(md.num_row_groups)] == [20_000, 10_000]
    assert not list((tmp_path / "cache").rglob("*.tmp"))


def test_columns_are_judged_per_file(spark, tmp_path):
    flat = tmp_path / "flat"
    flat.mkdir()
    df = _landing(spark).drop("schema").toPandas()
    for s in ("AAA", "BBB"):
        part = df[df.symbol == s].drop(columns=["symbol"])
        part = part.drop(columns=["volume"]) if s == "BBB" else part
        part.to_parquet(flat / f"{s}.parquet", coerce_timestamps="us")
    v = validate_layout(spark, str(flat), layout="flat")
    got = {r.symbol: (r.status, r.samples) for r in v.check_results.where("check = 'D'").collect()}
    assert got["AAA"][0] == "PASS" and got["BBB"] == ("ABORT", ["volume"])
    hive = str(tmp_path / "hive")
    W.write_chunks(_landing(spark), hive)
    W.write_chunks(_landing(spark, symbols=("CCC",)).drop("volume"), hive)
    v = validate_layout(spark, hive, layout="hive")
    got = {r.symbol: r.status for r in v.check_results.where("check = 'D'").collect()}
    assert got == {"AAA": "PASS", "BBB": "PASS", "CCC": "ABORT"}


def test_one_unreadable_file_holds_up_its_key_only(spark, tmp_path):
    root = str(tmp_path / "cache")
    led = W.write_chunk_files(_landing(spark, symbols=("AAA", "BBB", "CCC")), root).collect()
    for s in ("BBB",):
        path = next(r.path for r in led if r.symbol == s)
        open(path, "wb").write(b"not parquet")
    v = validate_layout(spark, root)
    rep = {r.symbol: (r.quarantine, r.n_rows_in) for r in v.report.collect()}
    assert rep == {"AAA": (False, 5), "BBB": (True, 0), "CCC": (False, 5)}
    d = v.check_results.where("check = 'D' AND symbol = 'BBB'").first()
    assert (d.status, d.detail) == ("ERROR", "1 unreadable files")


def _publish(spark, tmp_path, **kw):
    root = str(tmp_path / "cache")
    if not os.path.isdir(root):
        W.write_chunk_files(_landing(spark), root).count()
    rep = validate(_landing(spark)).report
    return PU.publish(spark, root, OHLCV_SCHEMA, files.chunk_probe(spark, root, OHLCV_SCHEMA), rep, str(tmp_path / "t"),
                      warehouse_root=str(tmp_path / "wh"), **kw)


def test_publishing_twice_loads_once(spark, tmp_path):
    rows = lambda: spark.read.parquet(str(tmp_path / "wh" / "ohlcv_1h")).count()
    one = _publish(spark, tmp_path)
    s = one.summary.first()
    assert (s.uploaded, s.skipped, s.failed, s.table_loaded) == (2, 0, 0, 2) and s.bytes > 0
    assert rows() == 10
    two = _publish(spark, tmp_path)
    s = two.summary.first()
    assert (s.uploaded, s.skipped, s.failed, s.table_loaded) == (0, 2, 0, 0)
    assert rows() == 10
    kept = reports.manifest_entries(reports.read_manifests(spark, str(tmp_path / "t" / "_manifests")))
    assert kept.count() == 2 and kept.where("md5 IS NULL").count() == 0


def _warehouse_rows(spark, root):
    rows = PU.warehouse_table(spark, str(root), OHLCV_SCHEMA).read()
    return [] if rows is None else sorted((r.symbol, r.ts_event, r.close) for r in rows.collect())


def test_a_killed_load_gives_the_same_table_when_rerun(spark, tmp_path, monkeypatch):
    class Killed(Exception):
        pass

    def kill(*a, **k):
        raise Killed

    def partly(self, rows, loads, run, *layout):
        loads.write.parquet(f"{self.log}/loads/load_run={run}")
        rows.limit(3).write.partitionBy("dt").parquet(f"{self.path}/load_run={run}")
        raise Killed

    led = W.write_chunk_files(_landing(spark), str(tmp_path / "cache")).collect()
    ok = spark.createDataFrame([(f"b/{r.symbol}", f"m{r.symbol}", r.path, r.rows) for r in led],
                               "blob_name string, md5 string, path string, row_count bigint")
    for at in ("before", "during", "after", "marker"):
        root = tmp_path / at
        load = lambda: PU.load_chunks(spark, ok, OHLCV_SCHEMA, str(root)).count()  # noqa: E731, B023
        with monkeypatch.context() as m:
            if at == "marker":          # the whole run but the rename that commits it
                whole = SnapshotTable.commit

                def unrenamed(self, run, rows, seen):
                    m.setattr(SnapshotTable, "loads", kill)  # noqa: B023
                    return whole(self, run, rows, seen)  # noqa: B023
                m.setattr(SnapshotTable, "commit", unrenamed)
            else:
                m.setattr(SnapshotTable, {"before": "append", "during": "stage", "after": "commit"}[at],
                          partly if at == "during" else kill)
            with pytest.raises(Killed):
                load()
        assert _warehouse_rows(spark, root) == []
        assert load() == 2
        rows = _warehouse_rows(spark, root)
        assert len(rows) == len(set(rows)) == 10
        assert load() == 0 and _warehouse_rows(spark, root) == rows


def test_two_runs_do_not_load_the_same_chunks(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    rows = lambda s: spark.createDataFrame([(s, "V", "2024-01-02")], "symbol string, venue string, dt string")
    loads = lambda b: spark.createDataFrame([(b, "m", 1)], "blob_name string, md5 string, rows bigint")
    assert table.append(rows("A"), loads("a")) == 1
    late, other = ("r1", rows("B"), loads("b")), ("r2", rows("C"), loads("c"))
    for run, r, ld in (late, other):
        table.stage(r, ld, run)
    assert table.append(rows("B"), loads("b")) == 2        # committed while r1 and r2 are under way
    with pytest.raises(ConflictingLoad):
        table.commit("r1", 1, seen=1)
    assert table.commit("r2", 1, seen=1) == 3
    assert sorted(r.symbol for r in table.read().collect()) == ["A", "B", "C"]
    assert sorted(r.blob_name for r in table.loads().collect()) == ["a", "b", "c"]
    with pytest.raises(RuntimeError):                      # fewer rows than the chunk holds
        table.append(rows("D"), spark.createDataFrame([("d", "m", 2)], "blob_name string, md5 string, rows bigint"))
    assert table.read().count() == 3


def test_chunks_that_the_warehouse_cannot_take_are_left_out(spark, tmp_path):
    root = str(tmp_path / "cache")
    good = _landing(spark)
    bad = _landing(spark, symbols=("CCC",)).withColumn("ts_event", F.expr("IF(close > 0, NULL, ts_event)"))
    W.write_chunk_files(good.unionByName(bad).withColumn("year_month", F.lit("2024-01")), root).count()
    s = _publish(spark, tmp_path).summary.first()
    assert (s.uploaded, s.table_loaded) == (3, 2)
    assert {r[0] for r in _warehouse_rows(spark, tmp_path / "wh")} == {"AAA", "BBB"}
    f = W.warehouse_frame(spark.createDataFrame([("A", "V", "2024-01-02 10:00:00", "x"), ("A", "V", "2024-01-02 10:00:00", "1.5"),
                                                 (None, "V", "2024-01-02 10:00:00", "1")],
                                                "symbol string, venue string, ts_recv string, price string"))
    assert [r._unfit for r in f.collect()] == [True, False, True] and dict(f.dtypes)["price"] == "double"


def _events(spark, tmp_path, rows):
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string") \
        .write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_roundtrip_of_chunks_that_are_all_rejected(spark, tmp_path):
    import datetime as dt
    from tickgate.plans.catalog import q_publish_roundtrip
    at = dt.datetime(2024, 1, 3, 15)
    sf = _events(spark, tmp_path, [(i, at + dt.timedelta(hours=i), 3 * i, s, -1.0 - i, None)
                                   for s in ("AAA", "BBB") for i in range(4)])
    got = sorted((r.symbol, r.success, r.row_count, r.table_rows, r.arrived) for r in q_publish_roundtrip(spark, sf).collect())
    assert got == [("AAA", False, 4, 0, False), ("BBB", False, 4, 0, False)]


def test_rerun_of_a_warehouse_load_that_takes_no_chunk(spark, tmp_path):
    import datetime as dt
    from tickgate.plans.catalog import q_warehouse_rerun
    sf = _events(spark, tmp_path, [(1, dt.datetime(2024, 1, 3, 15), 3, None, 5.0, None)])   # no symbol: unfit
    assert q_warehouse_rerun(spark, sf).collect() == []


def test_publishing_lists_only_prefixes_that_no_manifest_covers(spark, tmp_path):
    _publish(spark, tmp_path)
    target, manifests = str(tmp_path / "t"), str(tmp_path / "t" / "_manifests")
    known = reports.manifest_entries(reports.read_manifests(spark, manifests))
    wanted = known.select("blob_name", "schema", "symbol").unionByName(spark.createDataFrame(
        [("raw/ohlcv-1h/AAA/XNAS_ITCH/2030-01.parquet", OHLCV_SCHEMA, "AAA")], "blob_name string, schema string, symbol string"))
    assert [r.prefix for r in PU.prefixes_to_list(wanted, known).collect()] == ["raw/ohlcv-1h/AAA/XNAS_ITCH"]
    state = {r.blob_name: r.md5 for r in PU.target_state(spark, target, wanted, manifests).collect()}
    assert state == {r.blob_name: r.md5 for r in known.collect()}
    fresh = {r.blob_name: r.md5 for r in PU.target_state(spark, target, wanted, None).collect()}
    assert set(fresh) == set(state) and set(fresh.values()) == {None}


def test_an_object_that_did_not_arrive_fails(spark, tmp_path, monkeypatch):
    import pandas as pd

    def no_copier(target_root):
        def copy(batches):
            for pdf in batches:
                yield pd.DataFrame({"blob_name": pdf["blob_name"]})
        return copy
    monkeypatch.setattr(PU, "_copier", no_copier)
    s = _publish(spark, tmp_path).summary.first()
    assert (s.uploaded, s.failed, s.table_loaded) == (0, 2, 0)


def test_ingest_reports_what_it_did(spark, tmp_path):
    root = str(tmp_path / "cache")
    landing = _landing(spark).unionByName(_landing(spark, symbols=("AAA",)).withColumn("schema", F.lit("trades")))
    universe = spark.createDataFrame([("AAA",), ("BBB",)], "symbol string")
    args = dict(venues=["XNAS.ITCH"], start_date="2024-01-01", end_date="2024-01-31", layout="chunk")
    one = ingest(landing, universe, OHLCV_SCHEMA, root, **args).ledger
    assert {(r.symbol, r.rows, r.cached) for r in one.collect()} == {("AAA", 5, False), ("BBB", 5, False)}
    path = next(p for p in (tmp_path / "cache").rglob("*.parquet") if "BBB" in str(p))
    path.write_bytes(b"damaged")
    two = ingest(landing, universe, OHLCV_SCHEMA, root, landed=probe_landed(spark, root, OHLCV_SCHEMA), **args).ledger
    assert {(r.symbol, r.rows, r.cached) for r in two.collect()} == {("AAA", 5, True), ("BBB", 5, False)}


def test_median_text_rounds_ties_to_even(spark):
    rows = [bar(t, symbol="HI", o=1e4, h=2e4, lo=1.0, c=10000.5) for t in DAY] + [bar(t, symbol="LO", o=.02, h=1.0, lo=.01, c=0.03125) for t in DAY]
    got = {r.symbol: r.detail for r in validate(bars(spark, rows), ValidationConfig()).check_results.where("check = 'A'").collect()}
    assert got == {"HI": "median close = 10,000 > 10000 (fixed-point not converted)", "LO": "median close = 0.0312"}


def test_median_with_one_extreme_value(spark):
    """The extreme value leaves the others spread over many buckets, and the median exact."""
    import statistics
    from tickgate.operators.checks import median_close
    vals = [30 + i / 1000 for i in range(5000)] + [1e9]
    df = spark.createDataFrame([("S", v) for v in vals] + [(None, 1.0), (None, 4.0)], "symbol string, close double")
    got = {r.symbol: r.median_close for r in median_close(df).collect()}
    assert got == {"S": statistics.median(vals), None: 2.5}


def test_a_chunk_that_fails_holds_up_no_other(spark, tmp_path):
    """One folder that cannot be made, one file that does not hold its rows; messages are cut."""
    import pyarrow.parquet as pq
    root = tmp_path / "cache"
    (root / OHLCV_SCHEMA).mkdir(parents=True)
    (root / OHLCV_SCHEMA / "AAA").write_text("no folder")
    landing = _landing(spark, symbols=("AAA", "BBB", "CCC"))
    universe = spark.createDataFrame([("AAA",), ("BBB",), ("CCC",), ("DDD",)], "symbol string")
    res = ingest(landing, universe, OHLCV_SCHEMA, str(root), venues=["XNAS.ITCH"], start_date="2024-01-01",
                 end_date="2024-01-31", layout="chunk")
    led = {r.symbol: r for r in res.ledger.collect()}
    assert {s: (r.success, r.rows) for s, r in led.items()} == {
        "AAA": (False, 0), "BBB": (True, 5), "CCC": (True, 5), "DDD": (True, 0)}
    assert 0 < len(led["AAA"].message) <= 200 and led["AAA"].elapsed > 0 and led["DDD"].elapsed == 0
    assert PL.ingest_summary(res.ledger).first().failed == 1
    assert [r.symbol for r in PL.failures(res.ledger).collect()] == ["AAA"]
    assert not [p for p in root.rglob("*.tmp")] and not [p for p in root.rglob(".*.tmp")]

    import pyarrow as pa
    import pyarrow.fs as pafs
    fs = pafs.LocalFileSystem()
    rows = pa.RecordBatch.from_pydict({"x": [1, 2, 3]})
    ok, short = (ChunkFile(fs, str(tmp_path / "w"), ("s", n, "v", "2024-01"), rows.schema, 2) for n in ("ok", "short"))
    ok.add(rows)
    short.add(rows)
    short.n += 1
    assert ok.outcome()[5:9] == (3, os.path.getsize(tmp_path / "w/s/ok/v/2024-01.parquet"), True, "3 rows")
    assert short.outcome()[4:9] == (None, 0, None, False, "corrupt: 3 rows of 4 in the file")
    assert pq.read_metadata(tmp_path / "w/s/ok/v/2024-01.parquet").num_row_groups == 2
    assert os.listdir(tmp_path / "w/s/short/v") == []


def test_hive_ingest_scans_landing_once(spark, tmp_path):
    """Counts come from the written files' footers, checked against what the write job observed."""
    land = str(tmp_path / "landing")
    _landing(spark).write.parquet(land)
    scans = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b
    landing = spark.read.parquet(land)
    counted = landing.mapInArrow(seen, landing.schema)
    universe = spark.createDataFrame([("AAA",), ("BBB",), ("DDD",)], "symbol string")
    res = ingest(counted, universe, OHLCV_SCHEMA, str(tmp_path / "cache"), venues=["XNAS.ITCH"],
                 start_date="2024-01-01", end_date="2024-01-31", layout="hive")
    got = {r.symbol: (r.success, r.rows, r.message) for r in res.ledger.collect()}
    assert got == {"AAA": (True, 5, "5 rows"), "BBB": (True, 5, "5 rows"), "DDD": (True, 0, "0 rows (symbol absent at venue)")}
    assert scans.value == 10


def test_totals_over_schemas(spark):
    cols = "schema string, symbol string, venue string, year_month string, success boolean, message string, rows bigint, cached boolean"
    led = spark.createDataFrame([("a", "S", "V", "2024-01", True, "", 5, False), ("a", "S", "V", "2024-02", False, "x", 0, False),
                                 ("b", "S", "V", "2024-01", True, "", 7, True)], cols)
    got = {r.schema: tuple(r)[1:] for r in PL.ingest_totals(led).collect()}
    assert got == {"a": (2, 1, 0, 1, 5), "b": (1, 0, 1, 0, 7), "all": (3, 1, 1, 1, 12)}
    assert PL.ingest_totals(led.limit(0)).collect() in ([], [("all", 0, 0, 0, 0, 0)])


def _batch(symbol, n):
    import pyarrow as pa
    return pa.RecordBatch.from_pydict({"schema": ["s"] * n, "symbol": [symbol] * n, "venue": ["X.Y"] * n,
                                       "year_month": ["2024-01"] * n, "x": list(range(n))})


def test_lost_and_speculative_attempts_leave_nothing(tmp_path):
    """Two attempts of one task and one that dies half-way: only the chosen attempt's files are there, once."""
    import pyarrow.parquet as pq
    root, ledger = tmp_path / "cache", tmp_path / "ledger"
    w = ChunkWriter({"path": f"file:{root}", "ledger": f"file:{ledger}", "run": "r1", "row_group": "2"})
    chosen = w.write(iter([_batch("A", 3), _batch("B", 2)]))
    w.write(iter([_batch("A", 3), _batch("B", 2)]))

    def dies():
        yield _batch("C", 5)
        raise OSError("executor lost")
    with pytest.raises(OSError):
        w.write(dies())
    nothing = w.write(iter([]))
    assert len(list((root / "_staging-r1").iterdir())) == 3 and not (root / "s").exists()
    w.commit([chosen, nothing, None])
    assert sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file()) == [
        "s/A/X_Y/2024-01.parquet", "s/B/X_Y/2024-01.parquet"]
    got = {r["symbol"]: (r["rows"], r["success"], r["path"]) for r in pq.read_table(ledger).to_pylist()}
    assert got == {"A": (3, True, f"{root}/s/A/X_Y/2024-01.parquet"), "B": (2, True, f"{root}/s/B/X_Y/2024-01.parquet")}


def test_an_aborted_job_changes_no_chunk(spark, tmp_path):
    root = tmp_path / "cache"
    led = W.write_chunk_files(_landing(spark), str(root)).collect()
    before = {r.path: open(r.path, "rb").read() for r in led}
    broken = _landing(spark, symbols=("AAA", "BBB", "CCC"), c=99.0).withColumn(
        "close", F.when(F.col("symbol") == "CCC", F.raise_error(F.lit("broken row")).cast("double")).otherwise(F.col("close")))
    with pytest.raises(Exception, match="broken row"):
        W.write_chunk_files(broken, str(root))
    after = {str(p): p.read_bytes() for p in root.rglob("*") if p.is_file()}
    assert after == before and [p.name for p in root.iterdir()] == [OHLCV_SCHEMA]
    probe = files.chunk_probe(spark, str(root), OHLCV_SCHEMA)
    assert {(r.symbol, r.rows, r.state) for r in probe.collect()} == {("AAA", 5, "ok"), ("BBB", 5, "ok")}
    assert [r.symbol for r in files.chunk_probe(spark, str(root), OHLCV_SCHEMA, "BBB").collect()] == ["BBB"]


def test_a_rerun_replaces_chunks_and_their_own_only(spark, tmp_path):
    root = str(tmp_path / "cache")
    W.write_chunk_files(_landing(spark), root)
    led = W.write_chunk_files(_landing(spark, symbols=("AAA",), c=10.25), root)
    assert [(r.symbol, r.rows, r.success) for r in led.collect()] == [("AAA", 5, True)]
    got = {(r.symbol, r.close) for r in B.read_chunks(spark, root).select("symbol", "close").distinct().collect()}
    assert got == {("AAA", 10.25), ("BBB", 10.5)}
    assert W.write_chunk_files(_landing(spark).limit(0), root).count() == 0
