"""The quality checks A B C D J E F H I as DataFrame operators.

Every function takes a normalised bar frame (``operators.normalize``) and
returns one row per grain key. Shapes are chosen so that a key holding a
large share of all rows never lands whole in one task:

* ``base_aggregates`` scans the bars once for counts, sums and extremes per
  (key, date, ts), and keys and prices once for the (key, close) histogram; both
  are partial (map-side) aggregates. Days merge from the first, and the per-key
  numbers of B, J, E and H roll up from the small daily table.
* A's exact median first collapses the rows to a (key, close) histogram,
  shuffled on (key, close), then walks cumulative counts of value buckets of
  equal distinct count and, inside the one or two buckets holding the middle, the values.
* F and I group by (key, date, ts) first (spreads a hot key over its
  timestamps); days are sums and extremes of that, and only timestamps on a
  day's grid go on, into bitmaps of its filled slots.
* C folds each file's rows to one state per key and split as the scan yields
  them, and merges the states in file order; no raw row is shuffled or sorted.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StructField, StructType, TimestampNTZType,
                               TimestampType)

from tickgate.config import ValidationConfig
from tickgate.functions import timez
from tickgate.operators.nulls import join_same, on_same
from tickgate.session import ship_package, write_table


def _k(cfg: ValidationConfig) -> list[str]:
    return list(cfg.keys)


# ---------------------------------------------------------------------------
# Daily table: one row per (key, ET date); feeds B, J, E, H, I and the counts.
# ---------------------------------------------------------------------------

def _row_aggregates() -> list[Column]:
    """The mergeable aggregates of bars: counts, sums and extremes, in the order of ``DAILY_COLUMNS``."""
    o, h, lo, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    s = F.col("in_session")
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("ts_event").isNull()).alias("n_null_ts"),
        F.count(c).alias("n_close"),
        (F.count_if(o <= 0) + F.count_if(h <= 0) + F.count_if(lo <= 0) + F.count_if(c <= 0))
        .alias("n_bad_ohlc"),
        F.count_if(v < 0).alias("n_neg_volume"),
        F.count_if(v == 0).alias("n_zero_volume"),
        F.count_if((h < o) | (h < c)).alias("n_bad_high"),
        F.count_if((lo > o) | (lo > c)).alias("n_bad_low"),
        F.count_if(h < lo).alias("n_bad_high_low"),
        F.count_if(s).alias("n_kept"),
        F.sum(F.when(s, c * v)).alias("dv"),
        F.sum(F.when(s, v)).alias("v"),
        F.min(F.when(s, F.col("ts_event"))).alias("t_first"),
        F.max(F.when(s, F.col("ts_event"))).alias("t_last"),
    ]


DAILY_COLUMNS = ["n_rows", "n_null_ts", "n_close", "n_bad_ohlc", "n_neg_volume", "n_zero_volume",
                 "n_bad_high", "n_bad_low", "n_bad_high_low", "n_kept", "dv", "v", "t_first", "t_last"]


def merged_aggregates() -> list[Column]:
    """``_row_aggregates`` of parts merged to those of the whole."""
    extremes = {"t_first": F.min, "t_last": F.max}
    kinds = {"dv": "double", "v": "double"}
    return [extremes[x](x).alias(x) if x in extremes else F.sum(x).cast(kinds.get(x, "bigint")).alias(x)
            for x in DAILY_COLUMNS]


def daily_table(norm: DataFrame, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    return norm.groupBy(*_k(cfg), "et_date").agg(*_row_aggregates())


def base_aggregates(norm: DataFrame, cfg: ValidationConfig = ValidationConfig(), histogram: bool = True) -> DataFrame:
    """The row-level aggregates every check starts from, two levels in one table:

    * ``level = 'ts'``: the counts, sums and extremes per (key, day, timestamp), from one scan (F copies, I slots;
      merged to days in ``split_base``: B, J, E counts, H sums, first and last session bar);
    * ``level = 'px'``: rows per (key, close value), from a second scan of the keys and prices alone (A's histogram).

    No row is expanded, and both are combined in the tasks that scan before anything is shuffled. Without
    ``histogram`` there is no ``px`` level, for prices that hardly repeat (``median_close_bracketed``).
    """
    keys = _k(cfg)
    ts = norm.groupBy(*keys, "et_date", "ts_event").agg(*_row_aggregates()).withColumns(
        {"close": F.lit(None).cast("double"), "level": F.lit("ts")})
    if not histogram:
        return ts
    px = norm.where(F.col("close").isNotNull()).groupBy(*keys, "close").agg(F.count(F.lit(1)).alias("n_close"))
    return ts.unionByName(px.withColumn("level", F.lit("px")), allowMissingColumns=True)


def split_base(base: DataFrame, cfg: ValidationConfig = ValidationConfig()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(daily, per_ts, hist) from ``base_aggregates``."""
    keys = _k(cfg)
    ts = base.where(F.col("level") == "ts")
    daily = ts.groupBy(*keys, "et_date").agg(*merged_aggregates())
    per_ts = ts.where(F.col("n_kept") > 0).select(*keys, "et_date", "ts_event", F.col("n_kept").alias("cnt"))
    hist = base.where((F.col("level") == "px") & F.col("close").isNotNull()).select(*keys, "close", F.col("n_close").alias("cnt"))
    return daily, per_ts, hist


def key_counts(daily: DataFrame, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    """Per-key roll-up of the daily table (B, J, E, row counts)."""
    names = ["n_rows", "n_null_ts", "n_close", "n_bad_ohlc", "n_neg_volume", "n_zero_volume",
             "n_bad_high", "n_bad_low", "n_bad_high_low", "n_kept"]
    return daily.groupBy(*_k(cfg)).agg(*[F.sum(x).cast("bigint").alias(x) for x in names])


# ---------------------------------------------------------------------------
# A: exact median of close per key.
# ---------------------------------------------------------------------------

def median_close(norm: DataFrame | None, cfg: ValidationConfig = ValidationConfig(),
                 value: str = "close", buckets: int = 64, hist: DataFrame | None = None) -> DataFrame:
    """Exact median per key (pandas semantics: NULL skipped, mean of the two middle values).

    1. rows collapse to a (key, value) -> count histogram, shuffled on (key, value);
    2. each key's distinct values are cut into ``buckets`` buckets of about equal
       count at approximate percentiles (so an extreme value cannot crowd the
       others into one bucket), and the bucket counts are accumulated;
    3. only the one or two buckets holding the middle ranks are walked value by
       value, partitioned by (key, bucket).

    No step puts all rows of one key, or more than about a ``buckets``-th of its
    distinct values, into one task.
    Written as one SQL statement over the histogram (one analysis of the plan).
    """
    keys = _k(cfg)
    if hist is None:
        hist = (norm.where(F.col(value).isNotNull())
                .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt")))
    k = ", ".join(f"`{c}`" for c in keys)
    k_of = lambda t: ", ".join(f"{t}.`{c}`" for c in keys)
    nb = int(buckets)
    cuts = "array(" + ", ".join(f"{(i + 1) / nb!r}D" for i in range(max(1, nb - 1))) + ")"
    covers = "({c} - {n} < {r} AND {c} >= {r})"
    lo_b, hi_b = covers.format(c="bcum", n="bcnt", r="lo_rank"), covers.format(c="bcum", n="bcnt", r="hi_rank")
    lo_v, hi_v = covers.format(c="cum", n="cnt", r="lo_rank"), covers.format(c="cum", n="cnt", r="hi_rank")
    sql = f"""
    WITH h AS (SELECT {k}, `{value}` AS v, cnt FROM {{hist}}),
    s AS (SELECT {k}, sum(cnt) AS n, percentile_approx(v, {cuts}, {20 * nb}) AS bounds FROM h GROUP BY {k}),
    hb AS (SELECT {k_of('h')}, v, cnt,
                  size(filter(bounds, b -> b < v)) AS bucket
           FROM h JOIN s ON {on_same('h', 's', keys)}),
    pb AS (SELECT {k}, bucket, sum(cnt) AS bcnt FROM hb GROUP BY {k}, bucket),
    cb AS (SELECT pb.*, floor((s.n - 1) / 2) + 1 AS lo_rank, floor(s.n / 2) + 1 AS hi_rank,
                  sum(bcnt) OVER (PARTITION BY {', '.join(f'pb.`{c}`' for c in keys)} ORDER BY bucket
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bcum
           FROM pb JOIN s ON {on_same('pb', 's', keys)}),
    tg AS (SELECT {k}, bucket, bcum - bcnt AS before, lo_rank, hi_rank FROM cb WHERE {lo_b} OR {hi_b}),
    rk AS (SELECT {k_of('hb')}, hb.bucket, v, cnt, lo_rank, hi_rank,
                  before + sum(cnt) OVER (PARTITION BY {k_of('hb')}, hb.bucket ORDER BY v
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
           FROM hb JOIN tg ON {on_same('hb', 'tg', keys)} AND hb.bucket = tg.bucket)
    SELECT {k}, (max(CASE WHEN {lo_v} THEN v END) + max(CASE WHEN {hi_v} THEN v END)) / 2 AS median_close
    FROM rk WHERE {lo_v} OR {hi_v} GROUP BY {k}"""
    return hist.sparkSession.sql(sql, hist=hist)


SKETCH = 1024        # size of a quantile sketch; its rank error is well below MARGIN
MARGIN = 0.02        # share of a key's rows on either side of the middle that the bracket holds
BRACKETS = 1 << 20   # keys whose brackets are broadcast


def median_close_bracketed(norm: DataFrame, cfg: ValidationConfig = ValidationConfig(), value: str = "close",
                           sketch: int = SKETCH, margin: float = MARGIN) -> DataFrame:
    """``median_close`` for values that hardly repeat (ticks): exact, with a shuffle bounded by a bracket.

    1. One mergeable quantile sketch per key, partially aggregated, brackets the middle ranks.
    2. Rows below and above the bracket collapse to one count each, before any shuffle; only values
       inside it keep an entry, and ``median_close`` walks that histogram.
    3. A key whose middle is outside its bracket (the sketch erred, or values are infinite) is done over all its values.
    """
    keys = _k(cfg)
    rows = norm.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias(value))
    sk = rows.groupBy(*keys).agg(F.kll_sketch_agg_double(value, F.lit(sketch)).alias("_sk"))
    at = lambda q: F.kll_sketch_get_quantile_double("_sk", F.lit(q))
    bracket = write_table(sk.select(*keys, at(0.5 - margin).alias("_lo"), at(0.5 + margin).alias("_hi")))
    small = bracket.count() <= BRACKETS
    met = join_same(rows, F.broadcast(bracket) if small else bracket, keys, "left")
    inf = float("inf")
    clipped = F.when(F.col(value) < F.col("_lo"), -inf).when(F.col(value) > F.col("_hi"), inf).otherwise(F.col(value))
    hist = write_table(met.groupBy(*keys, clipped.alias(value)).agg(F.count(F.lit(1)).alias("cnt")))
    med = write_table(median_close(None, cfg, value, hist=hist))
    outside = med.where(F.col("median_close").isNull() | F.isnan("median_close") | (F.abs("median_close") == inf)).select(*keys)
    if outside.isEmpty():
        return med
    again = median_close(join_same(rows, outside, keys, "left_semi"), cfg, value)
    return join_same(med, outside, keys, "left_anti").unionByName(again)


def median_close_approx(norm: DataFrame, cfg: ValidationConfig = ValidationConfig(),
                        accuracy: int = 100_000) -> DataFrame:
    """Opt-in sketch for tick-scale data (bounded memory, rank error n/accuracy)."""
    return norm.groupBy(*_k(cfg)).agg(
        F.percentile_approx("close", 0.5, accuracy).alias("median_close"))


# ---------------------------------------------------------------------------
# C: ordering inside each file, by row index, in blocks.
# ---------------------------------------------------------------------------

RUNS = 100_000       # run states that a task holds at most


def _run_states(part: list[str]):
    """Folds rows, as the scan yields them, to one state per (key, file) and split."""
    def fold(batches):
        import numpy as np
        import pyarrow as pa

        def out(states: dict):
            cols = list(zip(*((*k, *s) for k, s in states.items())))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)
        states, kinds, names = {}, None, [*part, "first_idx", "last_idx", "first_ts", "last_ts", "steps"]
        for b in batches:
            if not b.num_rows:
                continue
            ts = b.column("_ts")
            kinds = [b.column(c).type for c in part] + [pa.int64()] * 2 + [ts.type] * 2 + [pa.int64()]
            code = np.zeros(b.num_rows, np.int64)
            for c in part:
                enc = b.column(c).dictionary_encode()
                place = enc.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
                code = np.unique(code * (len(enc.dictionary) + 1) + place, return_inverse=True)[1]
            idx = b.column("_idx").to_numpy()
            order = np.lexsort((idx, code))
            code, idx = code[order], idx[order]
            given = ts.is_valid().to_numpy(zero_copy_only=False)[order]
            number = ts.cast(pa.int32()).cast(pa.int64()) if pa.types.is_date32(ts.type) else (
                ts if pa.types.is_floating(ts.type) else ts.cast(pa.int64()))
            t = number.fill_null(0).to_numpy(zero_copy_only=False)[order]
            same = code[1:] == code[:-1]
            back = np.concatenate([[0], same & given[1:] & given[:-1] & (t[1:] < t[:-1])])
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            last = np.concatenate([first[1:], [len(code)]]) - 1
            steps = np.add.reduceat(back, first)
            ends = ts.take(pa.array(order[np.concatenate([first, last])])).to_pylist()
            for k, (lo, hi, n) in enumerate(zip(first, last, steps)):
                key = tuple(b.column(c)[int(order[lo])].as_py() for c in part)
                run = [int(idx[lo]), int(idx[hi]), ends[k], ends[len(first) + k], int(n)]
                have = states.get(key)
                if have is None:
                    states[key] = run
                elif have[1] < run[0]:          # goes on behind what is held
                    stepped = have[3] is not None and run[2] is not None and run[2] < have[3]
                    states[key] = [have[0], run[1], have[2], run[3], have[4] + run[4] + stepped]
                else:
                    yield out({key: have})
                    states[key] = run
            if len(states) > RUNS:
                yield out(states)
                states = {}
        if states:
            yield out(states)
    return fold


def order_runs(df: DataFrame, keys: list[str], ts: str = "ts_event", file_col: str = "file_path",
               idx_col: str = "row_index") -> DataFrame:
    """The order of each (key, file) as mergeable states: first and last row and time, and steps back in between.

    A scan yields a file's rows in order, so each task folds its splits as it reads them: no row is shuffled or
    sorted beyond its batch, and a task's result is one row per key and file. Files are told apart by two hashes of the path.
    """
    ship_package(df.sparkSession)
    src = df.select(*keys, F.xxhash64(file_col).alias("_fa"), F.hash(file_col).alias("_fb"),
                    F.col(idx_col).cast("bigint").alias("_idx"), F.col(ts).alias("_ts"))
    part = [*keys, "_fa", "_fb"]
    kind = src.schema["_ts"].dataType
    shape = StructType([src.schema[c] for c in part] + [StructField(n, t) for n, t in (
        ("first_idx", LongType()), ("last_idx", LongType()), ("first_ts", kind), ("last_ts", kind), ("steps", LongType()))])
    return src.where("_idx IS NOT NULL").mapInArrow(_run_states(part), shape)


def order_violations(df: DataFrame, keys: list[str], ts: str = "ts_event",
                     file_col: str = "file_path", idx_col: str = "row_index",
                     block_rows: int = 1 << 20) -> DataFrame:
    """Count steps back in time between consecutive rows of a key inside a file.

    The states of ``order_runs`` are merged in the order of their rows; a step between two states counts like one
    inside. A NULL on either side of a step is not a violation (same as a difference with a missing value). Rows that
    do not arrive in file order (states that overlap), or times that are no numbers, are compared by ``order_violations_blocked``.
    """
    numeric = (DateType, TimestampType, TimestampNTZType, LongType, IntegerType, DoubleType)
    if not isinstance(df.schema[ts].dataType, numeric):
        return order_violations_blocked(df, keys, ts, file_col, idx_col, block_rows)
    runs = write_table(order_runs(df, keys, ts, file_col, idx_col))
    w = Window.partitionBy(*keys, "_fa", "_fb").orderBy("first_idx", "last_idx")
    merged = runs.withColumns({"_before": F.lag("last_idx").over(w), "_prev": F.lag("last_ts").over(w)})
    if not merged.where("_before >= first_idx").isEmpty():
        return order_violations_blocked(df, keys, ts, file_col, idx_col, block_rows)
    return merged.groupBy(*keys).agg(
        (F.sum("steps") + F.count_if(F.col("first_ts") < F.col("_prev"))).cast("bigint").alias("n_violations"))


def order_violations_blocked(df: DataFrame, keys: list[str], ts: str = "ts_event",
                     file_col: str = "file_path", idx_col: str = "row_index",
                     block_rows: int = 1 << 20) -> DataFrame:
    """The same count for rows in any physical order, by sorting them.

    Rows of one (key, file) are cut into blocks of ``block_rows`` row indexes;
    a lag runs inside each block, and the first row of each block is compared
    with the last row of the previous non-empty block. A NULL on either side of
    a step is not a violation (same as a difference with a missing value).
    """
    part = keys + [file_col]
    b = df.select(*part, F.col(idx_col).alias("_idx"), F.col(ts).alias("_ts")) \
          .withColumn("_blk", F.floor(F.col("_idx") / F.lit(block_rows)))
    w_in = Window.partitionBy(*part, "_blk").orderBy("_idx")
    inner = (b.withColumn("_prev", F.lag("_ts").over(w_in))
             .groupBy(*part, "_blk").agg(
                 F.count_if(F.col("_ts") < F.col("_prev")).alias("n_inner"),
                 F.min_by("_ts", "_idx").alias("_first_ts"),
                 F.max_by("_ts", "_idx").alias("_last_ts")))
    w_blk = Window.partitionBy(*part).orderBy("_blk")
    edges = (inner.withColumn("_prev_last", F.lag("_last_ts").over(w_blk))
             .withColumn("n_edge", F.when(F.col("_first_ts") < F.col("_prev_last"), 1).otherwise(0)))
    return edges.groupBy(*keys).agg(
        (F.sum("n_inner") + F.sum("n_edge")).cast("bigint").alias("n_violations"))


# ---------------------------------------------------------------------------
# F + I: duplicates and hourly gaps on the session-filtered rows.
# ---------------------------------------------------------------------------

SLOTS = 32768       # slots of one bitmap


def gaps_and_duplicates(norm: DataFrame | None, daily: DataFrame,
                        cfg: ValidationConfig = ValidationConfig(), per_ts: DataFrame | None = None) -> DataFrame:
    """Per (key, ET date): extra copies of a timestamp (F) and missing grid slots (I).

    The grid of a day starts at its first in-session bar and steps by
    ``grid_seconds`` up to the last one; a slot is filled only by a bar stamped
    exactly on it. Copies and the day's ends are sums and extremes of ``per_ts`` (in-session rows counted per
    timestamp), aggregated before any (key, day) meets. Timestamps off the grid differ from the day's first one in their
    remainder by the grid step, so ``per_ts`` meets the days on (key, day, remainder): the ticks of a busy day spread
    over their remainders, and one remainder has no more timestamps than the day has slots. The slots that are left
    fill bitmaps, which tasks build and merge; they hold a day's slots for any ``grid_seconds``.
    """
    keys = _k(cfg)
    if per_ts is None:
        per_ts = (norm.where(F.col("in_session"))
                  .groupBy(*keys, "et_date", "ts_event").agg(F.count(F.lit(1)).alias("cnt")))
    k = ", ".join(f"`{c}`" for c in keys)
    k_of = lambda t: ", ".join(f"{t}.`{c}`" for c in keys)
    grid_us = int(cfg.grid_seconds) * 1_000_000
    micros = lambda c: f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST({c} AS TIMESTAMP_NTZ))"
    slots = f"CAST(timestampdiff(MICROSECOND, t_first, t_last) DIV {grid_us} AS INT) + 1"
    byte = f"CAST(conv(hex(substring(filled[CAST(s DIV {SLOTS} AS INT)], CAST(s % {SLOTS} DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    sql = f"""
    WITH p AS (SELECT {k}, et_date, ts_event, cnt, {micros('ts_event')} AS us FROM {{per_ts}}),
    d AS (
      SELECT {k}, et_date, CAST(sum(cnt - 1) AS BIGINT) AS n_dups, min(ts_event) AS t_first, max(ts_event) AS t_last,
             min(us) AS us_first, pmod(min(us), {grid_us}) AS phase
      FROM p GROUP BY {k}, et_date),
    q AS (SELECT *, pmod(us, {grid_us}) AS phase FROM p),
    b AS (
      SELECT {k_of('q')}, q.et_date, CAST((us - us_first) DIV {grid_us * SLOTS} AS INT) AS piece,
             bitmap_construct_agg((us - us_first) DIV {grid_us} % {SLOTS}) AS bits
      FROM q JOIN d ON {on_same('q', 'd', [*keys, 'et_date'])} AND q.phase = d.phase
      GROUP BY {k_of('q')}, q.et_date, CAST((us - us_first) DIV {grid_us * SLOTS} AS INT)),
    f AS (SELECT {k}, et_date, sum(bitmap_count(bits)) AS n_filled,
                 map_from_entries(collect_list(named_struct('piece', piece, 'bits', bits))) AS filled
          FROM b GROUP BY {k}, et_date),
    m AS (SELECT {k_of('d')}, d.et_date, n_dups, t_first, t_last, filled, {slots} AS n_slots,
                 CAST({slots} - n_filled AS BIGINT) AS n_missing
          FROM d JOIN f ON {on_same('d', 'f', [*keys, 'et_date'])})
    SELECT {k}, et_date, n_dups, t_first, t_last,
           CASE WHEN n_missing = 0 THEN CAST(array() AS ARRAY<INT>)
                ELSE filter(sequence(0, n_slots - 1), s -> coalesce({byte} & shiftleft(1, CAST(s % 8 AS INT)), 0) = 0) END AS missing_slots,
           n_missing
    FROM m"""
    return daily.sparkSession.sql(sql, daily=daily, per_ts=per_ts)


def _iso_local_sql(utc: str, tz: str) -> str:
    """SQL text of ``functions.timez.iso_local``: local wall clock plus '+hh:mm' offset."""
    loc = f"convert_timezone('UTC', '{tz}', {utc})"
    m = f"timestampdiff(MINUTE, {utc}, {loc})"
    return (f"concat(date_format({loc}, 'yyyy-MM-dd HH:mm:ss'), "
            f"format_string('%s%02d:%02d', IF({m} < 0, '-', '+'), CAST(abs({m}) DIV 60 AS INT), "
            f"CAST(abs({m}) % 60 AS INT)))")


def day_table(daily: DataFrame, per_day: DataFrame, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    """One row per (key, ET date) with everything the per-key roll-up needs.

    Both inputs are aggregates on (key, date), so the join needs no further
    shuffle. The VWAP of a day and the previous day *that has one* come from a
    lag that skips NULLs, over the key's days (a few thousand rows per key at
    most: the calendar bounds it, not the data).
    """
    keys = _k(cfg)
    k = ", ".join(f"`{c}`" for c in keys)
    slot_ts = f"t_first + make_dt_interval(0, 0, 0, CAST(x * {int(cfg.grid_seconds)} AS DECIMAL(18, 6)))"
    sql = f"""
    WITH j AS (
      SELECT d.*, n_dups, n_missing, missing_slots FROM {{daily}} d
      LEFT JOIN (SELECT {k}, et_date, n_dups, n_missing, missing_slots FROM {{per_day}}) p
             ON {on_same('d', 'p', [*keys, 'et_date'])}),
    w AS (
      SELECT *, CASE WHEN n_kept > 0 AND coalesce(v, 0D) > 0
                     THEN coalesce(dv, 0D) / greatest(coalesce(v, 0D), 1D) END AS vwap FROM j),
    l AS (
      SELECT *, lag(vwap, 1) IGNORE NULLS OVER (PARTITION BY {k} ORDER BY et_date) AS prev_vwap FROM w)
    SELECT *,
      vwap IS NOT NULL AND coalesce((prev_vwap = 0 AND vwap <> 0)
                                    OR abs(try_divide(vwap, prev_vwap) - 1) > {float(cfg.corp_event_thresh)!r},
                                    false) AS flagged,
      CASE WHEN n_missing > 0 THEN concat(
        date_format(et_date, 'yyyy-MM-dd'), ': [',
        array_join(transform(slice(missing_slots, 1, {int(cfg.i_sample_hours)}),
                             x -> concat("'", {_iso_local_sql(slot_ts, cfg.tz)}, "'")), ', '),
        ']') END AS gap_sample
    FROM l"""
    return daily.sparkSession.sql(sql, daily=daily, per_day=per_day)


def key_table(day: DataFrame, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    """Per-key roll-up of the day table: B, J, E counts, F, H, I numbers and their samples.

    Lists are bounded: corp-event dates by the key's calendar days, gap samples
    by ``i_sample_days``.
    """
    keys = _k(cfg)
    k = ", ".join(f"`{c}`" for c in keys)
    names = ["n_rows", "n_null_ts", "n_close", "n_bad_ohlc", "n_neg_volume", "n_zero_volume",
             "n_bad_high", "n_bad_low", "n_bad_high_low", "n_kept"]
    sums = ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in names)
    sql = f"""
    SELECT {k}, {sums},
      CAST(coalesce(sum(n_dups), 0) AS BIGINT) AS n_dups,
      CAST(coalesce(sum(n_missing), 0) AS BIGINT) AS n_missing_bars,
      CAST(count_if(n_missing > 0) AS BIGINT) AS n_days_gappy,
      CAST(count(vwap) AS BIGINT) AS n_vwap_days,
      CAST(count_if(flagged) AS BIGINT) AS n_corp_event_days,
      array_sort(collect_list(CASE WHEN flagged THEN date_format(et_date, 'yyyy-MM-dd') END)) AS corp_event_dates,
      transform(slice(array_sort(collect_list(
                  CASE WHEN n_missing > 0 THEN named_struct('et_date', et_date, 'gap_sample', gap_sample) END)),
                1, {int(cfg.i_sample_days)}), x -> x.gap_sample) AS sample_gaps
    FROM {{day}} GROUP BY {k}"""
    return day.sparkSession.sql(sql, day=day)


def duplicate_copies(norm: DataFrame, cfg: ValidationConfig = ValidationConfig(),
                     order: list[str] | None = None) -> DataFrame:
    """Row-level form of F (W4): each row with its copy number per (key, ts); > 1 is a later copy."""
    keys = _k(cfg)
    order = order or ["venue"]
    w = Window.partitionBy(*keys, "ts_event").orderBy(*order)
    return norm.withColumn("copy_no", F.row_number().over(w))


def gap_samples(per_day: DataFrame, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    """The first ``i_sample_days`` gappy days of each key with their first missing hours."""
    keys = _k(cfg)
    grid = cfg.grid_seconds
    gappy = per_day.where(F.col("n_missing") > 0)
    w = Window.partitionBy(*keys).orderBy("et_date")
    first = gappy.withColumn("day_no", F.row_number().over(w)).where(F.col("day_no") <= cfg.i_sample_days)
    hours = F.transform(
        F.slice("missing_slots", 1, cfg.i_sample_hours),
        lambda k: timez.iso_local(timez.plus_seconds(F.col("t_first"), k * grid), cfg.tz))
    return first.select(*keys, "et_date", "day_no", "n_missing", hours.alias("missing_hours"))


# ---------------------------------------------------------------------------
# H: day-over-day VWAP shift.
# ---------------------------------------------------------------------------

def daily_vwap(daily: DataFrame, keys: list[str], date_col: str = "et_date",
               dv: str = "dv", v: str = "v") -> DataFrame:
    """VWAP = dv / max(v, 1) where v > 0; days without a VWAP are dropped."""
    vv = F.coalesce(F.col(v), F.lit(0.0))
    dd = F.coalesce(F.col(dv), F.lit(0.0))
    vwap = F.when(vv > 0, dd / F.greatest(vv, F.lit(1.0)))
    return daily.select(*keys, date_col, dd.alias("dv"), vv.alias("v"), vwap.alias("vwap")) \
                .where(F.col("vwap").isNotNull())


def vwap_shift_days(vwap_days: DataFrame, keys: list[str], date_col: str = "et_date",
                    thresh: float = 0.30) -> DataFrame:
    """Each VWAP day with its change against the previous day that has a VWAP."""
    w = Window.partitionBy(*keys).orderBy(date_col)
    prev = F.lag("vwap").over(w)
    d = vwap_days.withColumn("prev_vwap", prev)
    change = F.abs(F.try_divide(F.col("vwap"), F.col("prev_vwap")) - 1)
    zero_base = (F.col("prev_vwap") == 0) & (F.col("vwap") != 0)   # pandas gives inf: flagged
    return (d.withColumn("abs_change", change)
            .withColumn("flagged", F.coalesce(zero_base | (change > F.lit(thresh)), F.lit(False))))


def vwap_shift(shift_days: DataFrame, keys: list[str], date_col: str = "et_date") -> DataFrame:
    """Per key: VWAP days, flagged days and their sorted dates."""
    return shift_days.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_vwap_days"),
        F.count_if("flagged").alias("n_corp_event_days"),
        F.array_sort(F.collect_list(F.when(F.col("flagged"), F.date_format(date_col, "yyyy-MM-dd"))))
        .alias("corp_event_dates"))


# ---------------------------------------------------------------------------
# D: required columns.
# ---------------------------------------------------------------------------

def missing_columns(present: tuple[str, ...], required: tuple[str, ...]) -> list[str]:
    """Schema-level difference, computed from metadata (no data is read)."""
    have = set(present)
    return [c for c in required if c not in have]


def frame_missing_columns(df: DataFrame, required: tuple[str, ...], keys: list[str]) -> DataFrame:
    """D per key of one frame: every key of ``df`` with the required columns the frame lacks.

    A DataFrame has one schema for all rows, so the list is the same for each
    key; per-file differences come from ``file_missing_columns``.
    """
    miss = missing_columns(tuple(df.columns), required)
    arr = F.array(*[F.lit(c) for c in miss]).cast("array<string>") if miss else F.array().cast("array<string>")
    return df.select(*keys).distinct().select(*keys, arr.alias("missing"))


def file_missing_columns(file_columns: DataFrame, required: tuple[str, ...],
                         keys: list[str]) -> DataFrame:
    """Per key, the required columns that any of the key's files lacks.

    ``file_columns`` is (keys..., path, column) from the Parquet footers. Each file is judged by
    itself, so a column present in one file does not hide its absence from another.
    """
    per_file = file_columns.groupBy(*keys, "path").agg(F.collect_set("column").alias("have"))
    req = F.array(*[F.lit(c) for c in required]).cast("array<string>")
    lacking = per_file.select(*keys, F.array_except(req, "have").alias("lacks"))
    # at most one entry per required column and file set; kept in catalogue order
    per_key = lacking.groupBy(*keys).agg(F.array_distinct(F.flatten(F.collect_set("lacks"))).alias("lacks"))
    return per_key.select(*keys, F.filter(req, lambda c: F.array_contains("lacks", c)).alias("missing"))
