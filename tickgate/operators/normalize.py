"""Normalisation of a bar frame (P7, P8, P9, P10, F4, NaN -> NULL).

Output columns: the grain keys, ``ts_event`` (UTC, TIMESTAMP_NTZ), ``et``
(exchange wall clock, TIMESTAMP_NTZ), ``et_date``, ``in_session``, the five bar
columns (NaN turned into NULL; absent ones added as NULL), plus ``file_path`` /
``row_index`` when the input carries file order.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickgate.config import ValidationConfig
from tickgate.functions import timez

BAR_PRICE_COLUMNS = ("open", "high", "low", "close")
BAR_COLUMNS = BAR_PRICE_COLUMNS + ("volume",)
ORDER_COLUMNS = ("file_path", "row_index")
# chunk-key attributes carried through when present (not part of the grain)
PASSTHROUGH_COLUMNS = ("schema", "venue", "year_month")


@dataclass(frozen=True)
class Normalized:
    df: DataFrame
    present_columns: tuple[str, ...]   # columns of the input, before conformance
    time_axis: str | None              # the column that became ts_event
    has_file_order: bool


def nan_to_null(col, dtype):
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(col, F.lit(None).cast(dtype))
    return col


def normalize_bars(df: DataFrame, cfg: ValidationConfig = ValidationConfig()) -> Normalized:
    cols = df.columns
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    axis = timez.pick_time_axis(cols)
    out = []
    for k in cfg.keys:
        out.append(F.col(k) if k in cols else F.lit(None).cast("string").alias(k))
    out += [F.col(c) for c in PASSTHROUGH_COLUMNS if c in cols and c not in cfg.keys]
    if axis is not None:
        ts = timez.to_utc_ntz(F.col(axis), dtypes[axis])
    else:
        ts = F.lit(None).cast("timestamp_ntz")
    out.append(ts.alias("ts_event"))
    for c in BAR_COLUMNS:
        if c in cols:
            out.append(nan_to_null(F.col(c), dtypes[c]).cast("double").alias(c))
        else:
            out.append(F.lit(None).cast("double").alias(c))
    has_order = all(c in cols for c in ORDER_COLUMNS)
    if has_order:
        out += [F.col("file_path"), F.col("row_index")]
    # one projection: the local view, its date and the session flag are derived
    # from the same expression (Catalyst evaluates the common part once)
    et = timez.utc_to_local(ts, cfg.tz)
    sod = timez.seconds_of_day(et)
    norm = df.select(*out, et.alias("et"), F.to_date(et).alias("et_date"),
                     F.coalesce((sod >= cfg.session_start_s) & (sod < cfg.session_end_s),
                                F.lit(False)).alias("in_session"))
    return Normalized(norm, tuple(cols), axis, has_order)
