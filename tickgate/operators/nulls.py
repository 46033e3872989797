"""Joins on keys in which NULL equals NULL: rows without a key are a key of their own."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def join_same(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``keys``, null-safe; one copy of the keys, as with a join on names."""
    other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"__{k}"]) for k in keys])
    out = left.join(other, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__{k}" for k in keys])


def on_same(left: str, right: str, keys) -> str:
    """The same condition as SQL text."""
    return " AND ".join(f"{left}.`{k}` <=> {right}.`{k}`" for k in keys)
