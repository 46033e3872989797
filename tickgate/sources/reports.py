"""JSON report and manifest scans (S8, S9), with explicit schemas (no inference)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = (
    "symbol string, schema string, quarantine boolean, warnings array<string>, "
    "n_rows_in bigint, n_rows_out bigint, "
    "checks map<string, struct<status:string, detail:string, metrics:map<string,double>, "
    "samples:array<string>>>")

MANIFEST_ENTRY = ("struct<blob_name:string, year_month:string, venue:string, row_count:bigint, "
                  "size_bytes:bigint, md5:string, validation_ok:boolean, warnings:array<string>, "
                  "uploaded_at:timestamp, skipped:boolean>")
MANIFEST_SCHEMA = f"symbol string, schema string, updated_at timestamp, files array<{MANIFEST_ENTRY}>"


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    """Validation reports written by ``sinks.writers.write_reports`` (JSON lines, one per key).

    A report that cannot be parsed must not look like no report: its key is taken from its folder and
    it counts as quarantined, with the warning ``unreadable report``, so the publish gate rejects it.
    """
    raw = (spark.read.schema(REPORT_SCHEMA + ", _corrupt_record string").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record").option("recursiveFileLookup", "true").json(root)
           .select("*", F.col("_metadata.file_path").alias("_path")))
    bad = F.col("_corrupt_record").isNotNull() | F.col("quarantine").isNull()
    folder = lambda k: F.nullif(F.url_decode(F.regexp_extract("_path", rf"/_{k}=([^/]+)/", 1)), F.lit(""))
    names = [c.split()[0] for c in ("symbol string", "schema string")]
    return raw.withColumns({
        **{k: F.when(bad, F.coalesce(folder(k), F.col(k))).otherwise(F.col(k)) for k in names},
        "quarantine": F.when(bad, F.lit(True)).otherwise(F.col("quarantine")),
        "warnings": F.when(bad, F.array(F.lit("unreadable report"))).otherwise(F.col("warnings")),
    }).drop("_corrupt_record", "_path")


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Manifests; a corrupt file is dropped (the upsert then starts it fresh)."""
    return (spark.read.schema(MANIFEST_SCHEMA).option("mode", "DROPMALFORMED")
            .option("recursiveFileLookup", "true").json(root))


def manifest_entries(manifests: DataFrame) -> DataFrame:
    """Manifests flattened to one row per file entry."""
    return manifests.select("schema", "symbol", F.explode("files").alias("f")).select("schema", "symbol", "f.*")
