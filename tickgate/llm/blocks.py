"""Written tables of wide rows (one row is a block of vectors or of tree nodes)."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tickgate.session import ensure_checkpoint_dir

ROW_GROUP = 16 << 20      # bytes of a Parquet row group: what a reader of such rows holds at once


def written_blocks(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder, in small row groups, and read back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", str(ROW_GROUP)).parquet(path)
    return spark.read.parquet(path)
