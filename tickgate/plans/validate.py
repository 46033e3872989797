"""Validation of a bar frame: all nine checks, per grain key, as one lazy plan (V, VA, VS).

``validate(df)`` returns a ``Validation`` whose members are lazy DataFrames:

* ``wide``          one row per key with the ``checks`` array (A B C D J E F H I)
* ``check_results`` one row per (key, check): status, detail, metrics, samples
* ``report``        one row per key: quarantine, warnings, row counts, check map
* ``clean``         session-filtered bars of keys that are not quarantined (K10)
* ``daily`` / ``per_day`` / ``vwap_days``  the intermediate tables, for reuse
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickgate.config import ABORT, CHECK_ORDER, ERROR, PASS, WARNING, ValidationConfig
from tickgate.operators import checks as C
from tickgate.operators import verdict as V
from tickgate.operators.nulls import join_same
from tickgate.operators.normalize import Normalized, normalize_bars
from tickgate.session import write_table


@dataclass
class Validation:
    cfg: ValidationConfig
    norm: Normalized | None      # None when only partial aggregates were read
    daily: DataFrame
    per_day: DataFrame
    vwap_days: DataFrame
    wide: DataFrame

    # derived frames are built on first use (each costs a plan analysis)
    @cached_property
    def check_results(self) -> DataFrame:
        return V.checks_long(self.wide, list(self.cfg.keys))

    @cached_property
    def report(self) -> DataFrame:
        return V.report(self.wide, list(self.cfg.keys), self.cfg.schema)

    @cached_property
    def clean(self) -> DataFrame:
        if self.norm is None:
            raise ValueError("verdicts from stored aggregates come without rows; read the layout for clean rows")
        keys = list(self.cfg.keys)
        ok_keys = self.report.where(~F.col("quarantine")).select(*keys)
        return join_same(self.norm.df.where(F.col("in_session")), ok_keys, keys, "left_semi")


def _fmt_num(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else repr(x)


def _lit_str_array(items: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in items]).cast("array<string>") if items else \
        F.array().cast("array<string>")


def validate(df: DataFrame, cfg: ValidationConfig = ValidationConfig(), *,
             missing_by_key: DataFrame | None = None, unreadable: DataFrame | None = None,
             expected_keys: DataFrame | None = None, materialize: bool = True) -> Validation:
    """Run the checks on ``df`` (raw bars; see ``normalize_bars`` for accepted shapes).

    ``missing_by_key``: (keys..., missing array<string>) from the files' footers
    (layout reads); when absent, D compares the frame's own columns.
    ``unreadable``: (keys..., n_unreadable) files of the key that could not be read: D is ERROR.
    ``expected_keys``: keys to report even when they have no rows (empty frame).
    """
    norm = normalize_bars(df, cfg)
    keys = list(cfg.keys)
    # one scan for the aggregates per timestamp, one of prices alone for the histogram; written once to the
    # shared checkpoint folder
    base = C.base_aggregates(norm.df, cfg, histogram=cfg.a_method == "histogram")
    if materialize:
        base = write_table(base, ("level",))
    viol = None
    if cfg.c_order == "file" and norm.has_file_order:
        viol = C.order_violations(norm.df, keys, block_rows=cfg.c_block_rows)
    med = C.median_close_bracketed(norm.df, cfg) if cfg.a_method == "bracket" else None
    return judge(base, viol, cfg, norm.present_columns, norm.time_axis is not None, norm=norm, med=med,
                 missing_by_key=missing_by_key, unreadable=unreadable, expected_keys=expected_keys)


def judge(base: DataFrame, viol: DataFrame | None, cfg: ValidationConfig, present_columns, has_axis: bool, *,
          norm: Normalized | None = None, med: DataFrame | None = None, missing_by_key: DataFrame | None = None, unreadable: DataFrame | None = None,
          expected_keys: DataFrame | None = None) -> Validation:
    """The verdicts that follow from the base aggregates and, per key, ``n_violations`` of the file order."""
    keys = list(cfg.keys)
    present = set(present_columns)
    daily, per_ts, hist = C.split_base(base, cfg)
    per_day = C.gaps_and_duplicates(None, daily, cfg, per_ts=per_ts)
    day = C.day_table(daily, per_day, cfg)
    wide = C.key_table(day, cfg)
    if expected_keys is not None:
        wide = join_same(expected_keys.select(*keys).distinct(), wide, keys, "left").na.fill(0)
    med = C.median_close(None, cfg, hist=hist) if med is None else med
    wide = join_same(wide, med, keys, "left")
    vwap_days = day.where(F.col("vwap").isNotNull()).select(
        *keys, "et_date", F.coalesce("dv", F.lit(0.0)).alias("dv"), F.coalesce("v", F.lit(0.0)).alias("v"), "vwap")
    if viol is not None:
        wide = join_same(wide, viol, keys, "left")
    else:
        wide = wide.withColumn("n_violations", F.lit(0).cast("bigint"))

    missing_static = C.missing_columns(tuple(present_columns), cfg.required())
    if not has_axis:
        missing_static = missing_static + ["ts_event"]
    if missing_by_key is not None:
        wide = join_same(wide, missing_by_key.select(*keys, F.col("missing").alias("_missing")), keys, "left")
        missing = F.coalesce(F.col("_missing"), _lit_str_array(missing_static))
    else:
        missing = _lit_str_array(missing_static)

    wide = wide.withColumn("missing", missing)
    if unreadable is not None:
        wide = join_same(wide, unreadable, keys, "left")
    else:
        wide = wide.withColumn("n_unreadable", F.lit(None).cast("bigint"))
    checks = _check_structs(cfg, present, has_axis)
    wide = wide.selectExpr("*", "n_rows AS n_rows_in",
                           ("n_kept" if has_axis else "n_rows") + " AS n_rows_out",
                           "array(" + ", ".join(checks) + ") AS checks")

    return Validation(cfg, norm, daily, per_day, vwap_days, wide)


def _q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _struct_sql(name: str, status: str, detail: str, metrics: dict[str, str] | None = None,
                samples: str | None = None) -> str:
    """named_struct(...) text of one check result; ``detail`` and values are SQL expressions."""
    m = ("map(" + ", ".join(f"{_q(k)}, CAST({v} AS DOUBLE)" for k, v in metrics.items()) + ")"
         if metrics else "CAST(map() AS MAP<STRING, DOUBLE>)")
    smp = samples if samples is not None else "CAST(array() AS ARRAY<STRING>)"
    return (f"named_struct('check', {_q(name)}, 'severity_rank', {CHECK_ORDER.index(name)}, "
            f"'status', {_q(status)}, 'detail', {detail}, 'metrics', {m}, 'samples', {smp})")


def _case(*cases: tuple[str, str], otherwise: str) -> str:
    if not cases:
        return otherwise
    body = " ".join(f"WHEN {c} THEN {v}" for c, v in cases)
    return f"CASE {body} ELSE {otherwise} END"


def _check_structs(cfg: ValidationConfig, present: set[str], has_axis: bool) -> list[str]:
    """The nine check structs as SQL expressions over the wide per-key row.

    Written as SQL text so that the whole array is one expression for the
    planner (and one call from Python), rather than hundreds of Column calls.
    """
    lim = _fmt_num(cfg.price_median_max)
    pct = f"{cfg.corp_event_thresh * 100:.0f}"
    empty = "n_rows = 0"
    st = _struct_sql

    # A
    if "close" not in present:
        a = st("A", PASS, _q("no close column or empty df"))
    else:
        a = _case(
            (empty, st("A", PASS, _q("no close column or empty df"))),
            ("median_close IS NULL", st("A", PASS, _q("median close = nan"))),
            (f"median_close > {cfg.price_median_max!r}",
             st("A", ABORT, f"format_string({_q(f'median close = %,.0f > {lim} (fixed-point not converted)')}, bround(median_close, 0))",
                {"median_close": "median_close"})),
            otherwise=st("A", PASS, "format_string('median close = %.4f', bround(median_close, 4))",
                         {"median_close": "median_close"}))
    # B
    b = _case(
        (empty, st("B", PASS, _q("empty df"))),
        ("n_bad_ohlc > 0 OR n_neg_volume > 0",
         st("B", ABORT, "format_string('%d rows with OHLC ≤ 0; %d rows with volume < 0', n_bad_ohlc, n_neg_volume)",
            {"n_bad_ohlc": "n_bad_ohlc", "n_neg_volume": "n_neg_volume"})),
        otherwise=st("B", PASS, "format_string('all OHLC positive; %d bars with volume=0 (valid)', n_zero_volume)",
                     {"n_zero_volume": "n_zero_volume"}))
    # C
    if not has_axis:
        c = st("C", PASS, _q("no datetime index or empty"))
    else:
        viol = "coalesce(n_violations, 0)"
        c = _case(
            (empty, st("C", PASS, _q("no datetime index or empty"))),
            (f"{viol} > 0 OR n_null_ts > 0",
             st("C", ABORT, f"concat(format_string('%d index ordering violations', {viol}), "
                            f"IF(n_null_ts > 0, format_string('; %d null timestamps', n_null_ts), ''))",
                {"n_violations": viol, "n_null_ts": "n_null_ts"})),
            otherwise=st("C", PASS, _q("index monotonically non-decreasing")))
    # D
    req = cfg.required()
    d = _case(
        ("n_unreadable > 0", st("D", ERROR, "format_string('%d unreadable files', n_unreadable)",
                                {"n_unreadable": "n_unreadable"})),
        ("size(missing) > 0",
         st("D", ABORT, "concat('missing columns: [', array_join(transform(missing, x -> concat('\\'', x, '\\'')), ', '), ']')",
            {"n_missing": "size(missing)"}, "missing")),
        otherwise=st("D", PASS, _q(f"all {len(req)} expected columns present")))
    # J
    if not all(x in present for x in ("open", "high", "low", "close")):
        j = st("J", PASS, _q("OHLC columns absent or empty"))
    else:
        j = _case(
            (empty, st("J", PASS, _q("OHLC columns absent or empty"))),
            ("n_bad_high + n_bad_low + n_bad_high_low > 0",
             st("J", ABORT, "format_string('%d high<open|close; %d low>open|close; %d high<low', "
                            "n_bad_high, n_bad_low, n_bad_high_low)",
                {"n_bad_high": "n_bad_high", "n_bad_low": "n_bad_low", "n_bad_high_low": "n_bad_high_low"})),
            otherwise=st("J", PASS, _q("OHLC relations consistent")))
    # E
    if not has_axis:
        e = st("E", PASS, _q("no datetime index or empty"))
    else:
        e = _case(
            (empty, st("E", PASS, _q("no datetime index or empty"))),
            otherwise=st("E", PASS, "format_string('kept %,d rows; dropped %,d outside session', n_kept, n_rows - n_kept)",
                         {"n_kept": "n_kept", "n_dropped": "n_rows - n_kept"}))
    f_empty = "n_kept = 0" if has_axis else "true"
    # F
    dups = "coalesce(n_dups, 0)"
    f = _case(
        (f_empty, st("F", PASS, _q("no datetime index or empty"))),
        (f"{dups} > 0", st("F", WARNING, f"format_string('%d duplicate timestamps', {dups})", {"n_dups": dups})),
        otherwise=st("F", PASS, _q("no duplicate timestamps")))
    # H
    nd = "coalesce(n_corp_event_days, 0)"
    if not {"close", "volume"} <= present:
        h = st("H", PASS, _q("required columns absent for check H"))
    else:
        h = _case(
            (f_empty, st("H", PASS, _q("required columns absent for check H"))),
            (f"{nd} > 0",
             st("H", WARNING, f"format_string({_q(f'%d days with VWAP shift > {pct}%%')}, {nd})",
                {"n_corp_event_days": nd}, "corp_event_dates")),
            otherwise=st("H", PASS, _q(f"no VWAP shift > {pct}% detected")))
    # I
    nm, ng = "coalesce(n_missing_bars, 0)", "coalesce(n_days_gappy, 0)"
    i = _case(
        (f_empty, st("I", PASS, _q("no datetime index or empty"))),
        (f"{nm} > 0",
         st("I", WARNING, f"format_string('%d missing hourly bars across %d days', {nm}, {ng})",
            {"n_missing_bars": nm, "n_days_gappy": ng},
            "coalesce(sample_gaps, CAST(array() AS ARRAY<STRING>))")),
        otherwise=st("I", PASS, _q("no intra-day hourly gaps")))
    return [a, b, c, d, j, e, f, h, i]


# ---------------------------------------------------------------------------
# Layout workflows (VA: flat per-symbol files; VS: the chunk layout)
# ---------------------------------------------------------------------------

def validate_layout(spark, root: str, cfg: ValidationConfig = ValidationConfig(), *, layout: str = "chunk",
                    symbol: str | None = None, reports_root: str | None = None,
                    quarantine_root: str | None = None) -> Validation:
    """VS / VA: scan a layout with file order, validate per key, persist verdicts, route quarantine.

    D is judged on the columns of each file (footers).

    * ``layout='chunk'``: ``{root}/{schema}/{symbol}/{venue_safe}/{YYYY-MM}.parquet``;
    * ``layout='flat'``: ``{root}/{SYMBOL}.parquet``.
    * ``layout='hive'``: the partitioned layout written by ``sinks.writers.write_chunks``.

    ``reports_root``: one JSON report per key (K4). ``quarantine_root``: the rows of
    quarantined keys are copied there, partitioned by key (K5); the source is
    left untouched (a move would lose data if the job failed half-way).
    """
    from tickgate.sinks import writers as W
    from tickgate.sources import bars as B
    from tickgate.sources import files

    keys = list(cfg.keys)
    # footers first: they name the columns of every file, and the files that cannot be read, which
    # the scan then leaves out; a key with such a file is an ERROR, other keys are not held up
    probe = write_table(files.layout_probe(spark, root, cfg.schema, layout))
    if symbol:
        probe = probe.where(F.col("symbol") == symbol)
    fc = files.file_columns(spark, root, cfg.schema, layout, probe=probe)
    missing = C.file_missing_columns(fc, cfg.required(), keys)
    bad = probe.where("state = 'corrupt'").groupBy(*keys).agg(F.count("*").alias("n_unreadable"))
    if layout == "flat":
        df = B.read_flat(spark, root, symbol, skip_unreadable=True)
    else:
        df = B.read_chunks(spark, root, cfg.schema, symbol=symbol, layout=layout, skip_unreadable=True)
    drop = [c for c in ("schema", "year_month") if c in df.columns and c not in keys]
    v = validate(df.drop(*drop), cfg, missing_by_key=missing, unreadable=bad, expected_keys=probe.select(*keys))
    v.wide = write_table(v.wide)   # one row per key, read by every summary below and by the caller's
    if reports_root:
        W.write_reports(v.report, reports_root)
    if quarantine_root:
        from tickgate.operators.publishing import quarantine_split
        _, bad = quarantine_split(df, v.report, keys)
        (bad.drop(*[c for c in ("file_path", "row_index") if c in bad.columns])
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*keys).parquet(quarantine_root))
    return v
