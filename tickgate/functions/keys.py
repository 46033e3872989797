"""Chunk-key and path scalars (P2-P6, P16). All are Column expressions."""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


# Path part that stands for a NULL key part. (Names with a leading underscore are hidden from scans.)
NO_KEY = "~null"


def venue_safe(venue: Column) -> Column:
    """'XNAS.ITCH' -> 'XNAS_ITCH' (every dot)."""
    return F.translate(venue, ".", "_")


def venue_unsafe(safe: Column) -> Column:
    """Inverse used when reading paths back: only the FIRST underscore becomes a dot."""
    return F.regexp_replace(safe, r"^([^_]*)_", "$1.")


def table_name(schema: Column) -> Column:
    """'ohlcv-1h' -> 'ohlcv_1h'."""
    return F.translate(schema, "-", "_")


def chunk_relpath(schema: Column, symbol: Column, venue: Column, year_month: Column) -> Column:
    """'{schema}/{symbol}/{venue_safe}/{YYYY-MM}.parquet'."""
    return F.concat_ws("/", schema, symbol, venue_safe(venue),
                       F.concat(year_month, F.lit(".parquet")))


def blob_name(prefix: str, schema: Column, symbol: Column, venue: Column,
              year_month: Column) -> Column:
    return F.concat(F.lit(prefix.rstrip("/") + "/"), chunk_relpath(schema, symbol, venue, year_month))


def report_name(prefix: str, schema: Column, symbol: Column) -> Column:
    return F.concat(F.lit(prefix.rstrip("/") + "/"), F.concat_ws("/", schema, symbol),
                    F.lit("/"), symbol, F.lit("_validation.json"))


def manifest_name(prefix: str, schema: Column, symbol: Column) -> Column:
    return F.concat(F.lit(prefix.rstrip("/") + "/"), F.concat_ws("/", schema, symbol),
                    F.lit("/"), symbol, F.lit("_manifest.json"))


def parse_chunk_relpath(rel: Column) -> Column:
    """'{schema}/{symbol}/{venue_safe}/{YYYY-MM}.parquet' -> struct; NULL when fewer than 4 parts."""
    parts = F.split(rel, "/")
    n = F.size(parts)
    fname = F.element_at(parts, 4)
    key = lambda part, name: F.nullif(part, F.lit(NO_KEY)).alias(name)
    return F.when(
        n >= 4,
        F.struct(
            key(F.element_at(parts, 1), "schema"),
            key(F.element_at(parts, 2), "symbol"),
            key(venue_unsafe(F.element_at(parts, 3)), "venue"),
            key(F.regexp_replace(fname, r"\.parquet$", ""), "year_month"),
        ),
    )


def relpath_under(path: Column, root: str) -> Column:
    """A listed path relative to ``root``, a qualified path (``session.qualified``).

    Local paths are listed with one or three slashes after ``file:``; both are compared with one.
    A path that is not under the root is an error: dropping it would lose its rows silently.
    """
    base = re.sub("^file:/+", "file:/", root.rstrip("/")) + "/"
    p = F.regexp_replace(path, "^file:/+", "file:/")
    return F.when(p.startswith(base), F.substring(p, len(base) + 1, 1 << 30)).when(
        p.isNotNull(), F.raise_error(F.concat(p, F.lit(f" is not under {base}"))).cast("string"))


def month_start(year_month: Column) -> Column:
    return F.to_date(F.concat(year_month, F.lit("-01")))


def month_bounds(year_month: Column) -> tuple[Column, Column]:
    """'2024-02' -> ('2024-02-01T00:00:00Z', '2024-03-01T00:00:00Z'); end exclusive."""
    first = month_start(year_month)
    fmt = "yyyy-MM-dd'T'00:00:00'Z'"
    return F.date_format(first, fmt), F.date_format(F.add_months(first, 1), fmt)


def year_month_of(ntz: Column) -> Column:
    return F.date_format(ntz, "yyyy-MM")
