"""Message formatting."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def truncate(msg: Column, n: int = 200) -> Column:
    return F.substring(msg, 1, n)


def status_word(skipped: Column) -> Column:
    return F.when(skipped, F.lit("SKIPPED")).otherwise(F.lit("UPLOADED"))
