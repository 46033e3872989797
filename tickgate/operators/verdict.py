"""Check structs, verdict roll-up and the validation summaries (V, G7, G10, G11, J12, O5)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickgate.operators.planning import by_schema
from tickgate.config import ABORT, ERROR, WARNING

def checks_long(wide: DataFrame, keys: list[str]) -> DataFrame:
    """Wide per-key row with a ``checks`` array -> one row per (key, check)."""
    return wide.select(*keys, F.explode("checks").alias("c")).select(*keys, "c.*")


def report(wide: DataFrame, keys: list[str], schema: str) -> DataFrame:
    """Per-key report: quarantine on any ABORT or ERROR, warnings in check order, check map."""
    sch = schema.replace("'", "\\'")
    return wide.selectExpr(
        *[f"`{k}`" for k in keys],
        f"'{sch}' AS schema",
        "exists(checks, c -> c.status IN ('ABORT', 'ERROR')) AS quarantine",
        "transform(filter(checks, c -> c.status = 'WARNING'), c -> c.check) AS warnings",
        "n_rows_in", "n_rows_out",
        "map_from_arrays(transform(checks, c -> c.check), "
        "transform(checks, c -> named_struct('status', c.status, 'detail', c.detail, "
        "'metrics', c.metrics, 'samples', c.samples))) AS checks",
    )


def _validation_totals() -> list:
    q = F.col("quarantine")
    w = F.size("warnings") > 0
    return [F.count(F.lit(1)).alias("total"),
            F.count_if(~q & ~w).alias("passed"),
            F.count_if(~q & w).alias("warned"),
            F.count_if(q).alias("quarantined")]


def validation_summary(report_df: DataFrame) -> DataFrame:
    return report_df.agg(*_validation_totals())


def validation_totals(report_df: DataFrame) -> DataFrame:
    """G10 over the reports of all schemas of a run: a row per schema and one for all."""
    return by_schema(report_df, _validation_totals())


def corp_event_keys(check_long: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose check H warned (G11); one row each, sort by the caller when shown."""
    return (check_long.where((F.col("check") == "H") & (F.col("status") == WARNING))
            .select(*keys).distinct())


def abort_reasons(check_long: DataFrame, keys: list[str]) -> DataFrame:
    """Per quarantined key, the aborted checks in check order (at most five)."""
    return (check_long.where(F.col("status").isin(ABORT, ERROR))
            .groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct("severity_rank", "check"))).alias("_a"))
            .select(*keys, F.transform("_a", lambda s: s["check"]).alias("aborted_checks")))


def quarantine_preview(report_df: DataFrame, keys: list[str], n: int = 20) -> DataFrame:
    """The first ``n`` quarantined keys (by key order) and how many more there are."""
    from tickgate.session import cut_lineage
    # one row per quarantined key, written once: the top-n (a take-ordered, each
    # task keeps n rows) and the total (a scalar subquery) both read it
    q = cut_lineage(report_df.where(F.col("quarantine")).select(*keys))
    top = q.orderBy(*keys).limit(n)
    n_q = q.agg(F.count(F.lit(1))).scalar()
    return (top.withColumn("rank", F.row_number().over(Window.orderBy(*keys)))
            .withColumn("n_quarantined", n_q)
            .withColumn("n_more", F.greatest(F.col("n_quarantined") - n, F.lit(0))))
