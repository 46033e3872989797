"""Gating, routing and publishing operators (K5, J5-J8, U5, G12, G16, P24, D-10).

All are joins and aggregates on chunk keys; none moves data through the driver.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickgate.functions import keys as K
from tickgate.functions.fmt import status_word
from tickgate.operators.nulls import join_same
from tickgate.operators.planning import CHUNK_KEY, by_schema


def quarantine_split(rows: DataFrame, report: DataFrame, keys=("symbol",)) -> tuple[DataFrame, DataFrame]:
    """K5: rows of non-quarantined keys, and rows of quarantined keys (source untouched)."""
    k = list(keys)
    q = report.where(F.col("quarantine")).select(*k)
    return join_same(rows, q, k, "left_anti"), join_same(rows, q, k, "left_semi")


def route(rows: DataFrame, report: DataFrame, keys=("symbol",)) -> DataFrame:
    """K5 as one frame with a ``route`` column (clean / quarantine / unvalidated)."""
    k = list(keys)
    r = report.select(*k, F.col("quarantine").alias("_q"))
    j = join_same(rows, r, k, "left")
    rt = F.when(F.col("_q"), "quarantine").when(F.col("_q").isNull(), "unvalidated").otherwise("clean")
    return j.withColumn("route", rt).drop("_q")


def publish_gate(chunks: DataFrame, report: DataFrame, keys=("schema", "symbol"),
                 require_report: bool = False) -> DataFrame:
    """Each chunk against its key's verdict.

    quarantined -> reject; no report -> publish with a warning (or reject when
    ``require_report``); otherwise publish. ``validation_ok`` is tri-state:
    NULL when there is no report (D-25).
    """
    k = list(keys)
    r = report.select(*k, F.col("quarantine").alias("_q"), F.col("warnings").alias("_w"))
    j = join_same(chunks, r, k, "left")
    no_report = F.col("_q").isNull()
    decision = (F.when(F.col("_q"), "reject")
                .when(no_report & F.lit(require_report), "reject")
                .otherwise("publish"))
    message = (F.when(F.col("_q"), "quarantined — skipping upload")
               .when(no_report, "no validation report").otherwise(""))
    return (j.withColumn("decision", decision).withColumn("gate_message", message)
            .withColumn("validation_ok", F.when(no_report, F.lit(None).cast("boolean")).otherwise(~F.col("_q")))
            .withColumn("warnings", F.coalesce(F.col("_w"), F.array().cast("array<string>")))
            .drop("_q", "_w"))


def with_blob_name(chunks: DataFrame, prefix: str) -> DataFrame:
    return chunks.withColumn("blob_name", K.blob_name(prefix, F.col("schema"), F.col("symbol"),
                                                      F.col("venue"), F.col("year_month")))


def publish_ledger(gated: DataFrame, existing: DataFrame, target_uri: str, overwrite: bool = False,
                   uploaded_at: Column | None = None) -> DataFrame:
    """The outcome of publishing each gated chunk.

    ``gated``: publish_gate output with blob_name, rows, size_bytes, md5.
    ``existing``: (blob_name, size_bytes, md5) already at the target; an
    existing object is skipped unless ``overwrite``, and its digest is still
    compared (``digest_match``; D-09).
    """
    ts = uploaded_at if uploaded_at is not None else F.current_timestamp()
    ex = existing.select("blob_name", F.col("size_bytes").alias("_rsize"), F.col("md5").alias("_rmd5"))
    j = gated.join(ex, "blob_name", "left")
    exists = F.col("_rsize").isNotNull()
    reject = F.col("decision") == "reject"
    skipped = ~reject & exists & F.lit(not overwrite)
    word = status_word(skipped)
    rows = F.coalesce(F.col("rows"), F.lit(0))
    msg = F.when(reject, F.col("gate_message")).otherwise(
        F.format_string("%s (%,d rows)", F.lower(word), rows))
    # skipped: compared when the target's digest is known (NULL otherwise);
    # uploaded: verified after the copy by the workflow
    digest_match = F.when(skipped, F.col("md5") == F.col("_rmd5"))
    return j.select(
        *CHUNK_KEY, "blob_name", F.lit(target_uri.rstrip("/") + "/").alias("_u"),
        (~reject).alias("success"), msg.alias("message"),
        F.when(~reject, F.concat(F.lit(target_uri.rstrip("/") + "/"), "blob_name")).otherwise(F.lit(""))
        .alias("uri"),
        skipped.alias("skipped"), digest_match.alias("digest_match"),
        rows.cast("bigint").alias("row_count"), "size_bytes", "md5", "validation_ok", "warnings",
        ts.alias("uploaded_at")).drop("_u")


def manifest_entries(ledger: DataFrame) -> DataFrame:
    """Entries of successful publishes (uploaded or skipped)."""
    return ledger.where("success").select(
        "schema", "symbol", "blob_name", "year_month", "venue", "row_count", "size_bytes", "md5",
        "validation_ok", "warnings", "uploaded_at", "skipped")


def manifest_upsert(old_entries: DataFrame, new_entries: DataFrame) -> DataFrame:
    """Replace entries by ``blob_name`` (last writer wins), keep the others."""
    cols = new_entries.columns
    return old_entries.select(*cols).join(new_entries.select("blob_name"), "blob_name", "left_anti") \
        .select(*cols).unionByName(new_entries)


def manifest_build(entries: DataFrame) -> DataFrame:
    """One manifest per (schema, symbol), entries sorted by blob name.

    A manifest holds one entry per chunk of its symbol, so its size is bounded
    by the plan (venues x months), not by data volume.
    """
    fields = ["blob_name", "year_month", "venue", "row_count", "size_bytes", "md5", "validation_ok",
              "warnings", "uploaded_at", "skipped"]
    return entries.groupBy("schema", "symbol").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("files"),
        F.max("uploaded_at").alias("updated_at"))


def load_ledger(to_load: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """D-10: warehouse loads not yet in the ledger (by blob_name and md5), and the grown ledger.

    Re-running a publish therefore appends nothing twice.
    """
    new = to_load.join(ledger.select("blob_name", "md5"), ["blob_name", "md5"], "left_anti")
    grown = ledger.unionByName(new.select(*ledger.columns))
    return new, grown


def _publish_totals(loaded: Column) -> list:
    ok, sk = F.col("success"), F.col("skipped")
    return [F.count(F.lit(1)).alias("total"),
            F.count_if(ok & ~sk).alias("uploaded"),
            F.count_if(sk).alias("skipped"),
            F.count_if(~ok).alias("failed"),
            F.count_if(loaded).alias("table_loaded"),
            F.coalesce(F.sum(F.when(ok, F.col("size_bytes"))), F.lit(0)).cast("bigint").alias("bytes")]


def _with_loads(ledger: DataFrame, loaded: DataFrame | None) -> tuple[DataFrame, Column]:
    if loaded is None:
        return ledger, F.lit(False)
    marks = loaded.select("blob_name").distinct().withColumn("_l", F.lit(True))
    return ledger.join(marks, "blob_name", "left"), F.coalesce(F.col("_l"), F.lit(False))


def publish_summary(ledger: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """Totals of a publish ledger; ``table_loaded`` counts chunks appended to the warehouse."""
    rows, mark = _with_loads(ledger, loaded)
    return rows.agg(*_publish_totals(mark))


def publish_totals(ledger: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """G12 over the publish ledgers of all schemas of a run: a row per schema and one for all."""
    rows, mark = _with_loads(ledger, loaded)
    return by_schema(rows, _publish_totals(mark))
