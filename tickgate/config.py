"""Parameters of the pipeline: fixed reference values plus run-time settings.

Everything here is plain data. Operators take a ``ValidationConfig`` (or the
individual values) as arguments, so nothing is read from the environment.
"""
from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values. These must equal the values the reference pipeline uses for
# results to agree; they are listed here as plain text in their natural order.
# --------------------------------------------------------------------------

LIT_SCHEMA = "mbp-10"
ATS_SCHEMA = "trades"
OHLCV_SCHEMA = "ohlcv-1h"

# 15 lit (NMS) venues, in the reference order.
LIT_VENUES = (
    "XNAS.ITCH",
    "ARCX.PILLAR",
    "BATS.PITCH",
    "EDGX.PITCH",
    "XNYS.PILLAR",
    "BATY.PITCH",
    "EDGA.PITCH",
    "XBOS.ITCH",
    "XPSX.ITCH",
    "MEMX.MEMOIR",
    "EPRL.DOM",
    "IEXG.TOPS",
    "XCHI.PILLAR",
    "XASE.PILLAR",
    "XCIS.TRADESBBO",
)

# ATS / TRF venues (trade-only).
ATS_VENUES = (
    "FINN.NLS",
    "FNYX.NLS",
    "FINY.NLS",
    "OCEA.MEMOIR",
)

# schema -> venues
SCHEMA_VENUES = {
    LIT_SCHEMA: LIT_VENUES,
    ATS_SCHEMA: ATS_VENUES,
    OHLCV_SCHEMA: LIT_VENUES,
}

# Venues whose data starts later than the plan start.
VENUE_EARLIEST_START = {
    "IEXG.TOPS": "2023-04-01",
    "MEMX.MEMOIR": "2023-04-01",
    "XCIS.TRADESBBO": "2023-04-01",
    "EPRL.DOM": "2023-04-01",
    "XCHI.PILLAR": "2023-04-01",
}

# Required columns per schema (check D).
REQUIRED_COLUMNS = {
    "mbp-10": (
        "ts_recv", "ts_event", "symbol", "price", "size",
        "bid_px_00", "ask_px_00", "bid_sz_00", "ask_sz_00",
        "bid_px_01", "ask_px_01",
    ),
    "trades": ("ts_recv", "ts_event", "symbol", "price", "size"),
    "ohlcv-1h": ("open", "high", "low", "close", "volume"),
}

# Warehouse fields with a declared type; a row needs symbol, venue and a time (ts_recv, else ts_event).
WAREHOUSE_FIELDS = {
    "ts_recv": "timestamp", "ts_event": "timestamp", "symbol": "string", "venue": "string",
    "price": "double", "size": "bigint", "bid_px_00": "double", "ask_px_00": "double",
    "bid_sz_00": "bigint", "ask_sz_00": "bigint",
}

# Plan range.
START_DATE = "2022-01-01"
END_DATE = "2025-12-31"

# Session and thresholds.
ET_TZ = "America/New_York"
SESSION_START = "09:30:00"   # inclusive
SESSION_END = "16:00:00"     # exclusive
PRICE_MEDIAN_MAX = 10_000.0  # check A, strict '>'
CORP_EVENT_THRESH = 0.30     # check H, strict '>'
STALE_QUOTE_SECS = 60        # declared, not used by any check

# Dry-run estimates per schema, and the defaults for unknown schemas.
ESTIMATE_RECORDS_PER_CHUNK = {"mbp-10": 7_000, "trades": 15_000, "ohlcv-1h": 130}
ESTIMATE_MB_PER_CHUNK = {"mbp-10": 5.0, "trades": 0.5, "ohlcv-1h": 0.01}
ESTIMATE_USD_PER_GB = {"mbp-10": 2.00, "trades": 0.50, "ohlcv-1h": 0.30}
DEFAULT_RECORDS_PER_CHUNK = 7_000
DEFAULT_MB_PER_CHUNK = 1.0
DEFAULT_USD_PER_GB = 1.0
CHUNKS_PER_HOUR = 50.0

# Storage layout.
PARQUET_COMPRESSION = "snappy"
PARQUET_ROW_GROUP = 50_000
PUBLISH_PREFIX = "raw"
QUARANTINE_PART = "quarantine"

# Check order (A B C D J E F H I) and severity.
CHECK_ORDER = ("A", "B", "C", "D", "J", "E", "F", "H", "I")
CHECK_SEVERITY = {
    "A": "ABORT", "B": "ABORT", "C": "ABORT", "D": "ABORT", "J": "ABORT",
    "E": "PASS", "F": "WARNING", "H": "WARNING", "I": "WARNING",
}
ABORT, WARNING, PASS, ERROR = "ABORT", "WARNING", "PASS", "ERROR"

# Mode -> schemas, in the order the reference runs them for "all".
MODE_SCHEMAS = {
    "lit": (LIT_SCHEMA,),
    "ats": (ATS_SCHEMA,),
    "ohlcv": (OHLCV_SCHEMA,),
    "all": (LIT_SCHEMA, ATS_SCHEMA, OHLCV_SCHEMA),
}


def hms_seconds(hms: str) -> int:
    h, m, s = (int(x) for x in hms.split(":"))
    return h * 3600 + m * 60 + s


@dataclass(frozen=True)
class ValidationConfig:
    """Run-time settings of the validator."""

    schema: str = OHLCV_SCHEMA
    keys: tuple[str, ...] = ("symbol",)          # report grain
    tz: str = ET_TZ
    session_start: str = SESSION_START
    session_end: str = SESSION_END
    price_median_max: float = PRICE_MEDIAN_MAX
    corp_event_thresh: float = CORP_EVENT_THRESH
    # "file": check C judges ingest order inside each file (needs file_path and
    # row_index columns); "sorted": the data is taken as sorted, C passes.
    c_order: str = "file"
    # rows per block of the blocked order check; bounds per-task window state
    c_block_rows: int = 1 << 20
    # check A: "histogram" counts every price in the base aggregate; "bracket" only prices near the
    # middle, with a second pass (for ticks, whose prices hardly repeat)
    a_method: str = "histogram"
    # how many gappy days / missing hours check I lists
    i_sample_days: int = 5
    i_sample_hours: int = 3
    # bars grid step for check I, in seconds
    grid_seconds: int = 3600
    required_columns: tuple[str, ...] | None = None
    extra: dict = field(default_factory=dict)

    @property
    def session_start_s(self) -> int:
        return hms_seconds(self.session_start)

    @property
    def session_end_s(self) -> int:
        return hms_seconds(self.session_end)

    def required(self) -> tuple[str, ...]:
        if self.required_columns is not None:
            return tuple(self.required_columns)
        return REQUIRED_COLUMNS.get(self.schema, ())
