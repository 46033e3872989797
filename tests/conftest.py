from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickgate.session import local_session  # noqa: E402

BAR_SCHEMA = ("symbol string, venue string, ts_event timestamp_ntz, open double, high double, "
              "low double, close double, volume double")


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="tickgate-tests")
    yield s
    s.stop()


def ts(text: str):
    import datetime as dt
    return dt.datetime.fromisoformat(text)


def bar(t: str, o=10.0, h=11.0, lo=9.0, c=10.5, v=100.0, symbol="S", venue="XNAS.ITCH"):
    f = lambda x: None if x is None else float(x)
    return (symbol, venue, ts(t) if t else None, f(o), f(h), f(lo), f(c), f(v))


def bars(spark, rows, schema: str = BAR_SCHEMA):
    return spark.createDataFrame(rows, schema)


def checks_of(v, symbol="S") -> dict:
    return {r["check"]: r for r in v.check_results.where(f"symbol = '{symbol}'").collect()}
