"""File-level sources: listings, footers, digests.

* Listings use the ``binaryFile`` source with only path/length selected, which
  prunes the ``content`` column: no file bytes are read.
* Footers (row count, column names, readability) are read per file inside
  tasks with pyarrow (``mapInPandas``); only the Parquet footer is touched.
  Zero-row files are kept (a plain ``groupBy(file_path).count()`` over a scan
  would drop them), and unreadable files come back as ``corrupt`` instead of
  failing the job.
* Digests stream each file through MD5 inside a task (no whole-file rows).
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickgate.config import QUARANTINE_PART
from tickgate.functions import keys as K
from tickgate.session import arrow_uri, qualified, ship_package
from tickgate.sinks.chunk_source import ChunkSource

FOOTER_SCHEMA = ("path string, ok boolean, reason string, num_rows bigint, "
                 "columns array<string>")


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet", recursive: bool = True) -> DataFrame:
    """(path, size_bytes, modified) of every file under ``root`` matching ``glob``; no bytes read."""
    r = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
         .option("recursiveFileLookup", str(recursive).lower()).load(root))
    return r.select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))


def not_quarantined(path: Column) -> Column:
    """F2 as a path-part test (not a substring test)."""
    return ~F.array_contains(F.split(F.regexp_replace(path, r"^[a-z]+:", ""), "/"), QUARANTINE_PART)


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for pdf in batches:
        out = []
        for p in pdf["path"]:
            try:
                fs, rel = pafs.FileSystem.from_uri(arrow_uri(p))
                with fs.open_input_file(rel) as fh:
                    md = pq.ParquetFile(fh).metadata
                    names = [md.schema.column(i).path.split(".")[0] for i in range(md.num_columns)]
                    names = list(dict.fromkeys(names))
                    out.append((p, True, f"{md.num_rows:,} rows", int(md.num_rows), names))
            except Exception as e:  # noqa: BLE001 - an unreadable file is a result, not an error
                out.append((p, False, f"corrupt: {str(e)[:80]}", None, None))
        yield pd.DataFrame(out, columns=["path", "ok", "reason", "num_rows", "columns"])


def parquet_footers(files: DataFrame) -> DataFrame:
    """(path, ok, reason, num_rows, columns) for each listed path."""
    ship_package(files.sparkSession)
    return files.select("path").repartition(io_tasks(files.sparkSession), "path") \
        .mapInPandas(_read_footers, FOOTER_SCHEMA)


def file_probe(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Listing + footer per file: state ok / empty / corrupt with the row count and size."""
    files = list_files(spark, root, glob)
    foot = parquet_footers(files)
    j = files.join(foot, "path", "left")
    state = (F.when(~F.col("ok"), F.lit("corrupt"))
             .when(F.col("num_rows") == 0, F.lit("empty")).otherwise(F.lit("ok")))
    return j.select("path", "size_bytes", state.alias("state"),
                    F.col("num_rows").alias("rows"), "reason", "columns")


def chunk_probe(spark: SparkSession, cache_root: str, schema: str, symbol: str | None = None) -> DataFrame:
    """S6 on the chunk layout: probe rows keyed by (schema, symbol, venue, year_month).

    Files are listed and probed by the tasks that the chunk source plans over the symbol folders.
    """
    ship_package(spark)
    spark.dataSource.register(ChunkSource)
    root = qualified(spark, cache_root)
    read = spark.read.format(ChunkSource.name()).option("schema_name", schema).option("tasks", io_tasks(spark))
    probe = (read.option("symbol", symbol) if symbol else read).load(root)
    key = K.parse_chunk_relpath(K.relpath_under(F.col("path"), root))
    return (probe.where(not_quarantined(F.col("path"))).withColumn("_k", key).where(F.col("_k").isNotNull())
            .select("_k.*", "rows", "size_bytes", "path", "state", "columns"))


def _md5_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import hashlib

    import pyarrow.fs as pafs

    for pdf in batches:
        out = []
        for p in pdf["path"]:
            fs, rel = pafs.FileSystem.from_uri(arrow_uri(p))
            h = hashlib.md5()
            n = 0
            try:
                with fs.open_input_stream(rel) as fh:
                    while True:
                        block = fh.read(1 << 20)
                        if not block:
                            break
                        n += len(block)
                        h.update(block)
                out.append((p, n, h.hexdigest()))
            except FileNotFoundError:
                out.append((p, None, None))
        yield pd.DataFrame(out, columns=["path", "size_bytes", "md5"])


def digests_of(paths: DataFrame) -> DataFrame:
    """(path, size_bytes, md5) for the listed ``path`` values only (missing files give NULLs)."""
    ship_package(paths.sparkSession)
    return (paths.select("path").distinct().repartition(io_tasks(paths.sparkSession), "path")
            .mapInPandas(_md5_files, "path string, size_bytes bigint, md5 string"))


def io_tasks(spark: SparkSession) -> int:
    """Task count for per-file I/O work (footers, digests, copies)."""
    try:
        par = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        par = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, par * 4)


def file_digests(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """md5 (hex) and size of every file under ``root``.

    Each file is streamed through MD5 in 1 MiB blocks inside a task, so a file
    never has to fit in one row (the ``binaryFile`` content column is capped
    at 2 GiB and held in memory). The listing is spread over an explicit
    number of tasks: a list of paths is tiny, and adaptive coalescing would
    otherwise fold it into one serial task.
    """
    return digests_of(list_files(spark, root, glob))


def b64_to_hex(b64: Column) -> Column:
    """An object store's base64 MD5 -> lower-case hex."""
    return F.lower(F.hex(F.unbase64(b64)))


def hex_to_b64(hx: Column) -> Column:
    return F.base64(F.unhex(hx))


def storage_report(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """File count, bytes and GiB under ``root``, quarantine excluded; no bytes read."""
    files = list_files(spark, root, glob).where(not_quarantined(F.col("path")))
    return files.agg(F.count(F.lit(1)).alias("n_files"),
                     F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("total_bytes"),
                     (F.coalesce(F.sum("size_bytes"), F.lit(0)) / F.lit(float(1024 ** 3))).alias("total_gib"))


HIVE_COLUMNS = ("schema", "symbol", "venue_safe", "year_month")


def layout_probe(spark: SparkSession, root: str, schema: str, layout: str) -> DataFrame:
    """S6 on any layout: (schema, symbol, venue, year_month, path, state, columns) per file; flat files have no venue."""
    if layout == "chunk":
        return chunk_probe(spark, root, schema)
    path = F.col("path")
    if layout == "hive":
        part = lambda k: F.regexp_extract(path, rf"/{k}=([^/]+)/", 1)
        probe = file_probe(spark, f"{root.rstrip('/')}/schema={schema}")
        return probe.select(F.lit(schema).alias("schema"), part("symbol").alias("symbol"),
                            K.venue_unsafe(part("venue_safe")).alias("venue"), part("year_month").alias("year_month"),
                            "rows", "size_bytes", "path", "state", "columns")
    name = F.regexp_extract(path, r"([^/]+)\.parquet$", 1)
    none = F.lit(None).cast("string")
    return file_probe(spark, root).where(not_quarantined(path) & ~name.endswith("_validation")).select(
        F.lit(schema).alias("schema"), name.alias("symbol"), none.alias("venue"), none.alias("year_month"),
        "rows", "size_bytes", "path", "state", "columns")


def file_columns(spark: SparkSession, cache_root: str, schema: str, layout: str = "chunk",
                 probe: DataFrame | None = None) -> DataFrame:
    """(schema, symbol, venue, year_month, path, column): exploded footer columns for check D per file.

    A file's columns include what its layout puts into the path.
    """
    cp = probe if probe is not None else layout_probe(spark, cache_root, schema, layout)
    from_path = {"chunk": (), "hive": ("symbol", "venue"), "flat": ("symbol",)}[layout]
    cols = F.concat("columns", F.array(*[F.lit(c) for c in from_path]).cast("array<string>"))
    return cp.where(F.col("columns").isNotNull()).select(
        "schema", "symbol", "venue", "year_month", "path", F.explode(cols).alias("column"))
