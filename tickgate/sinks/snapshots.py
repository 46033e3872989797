"""Append-only tables with a snapshot log (K8): a load is visible as a whole, once, or not at all.

A run writes its rows below ``{table}/load_run={run}`` and the list of chunks it loads below ``{table}/_log/loads``,
both in folders of its own, and then one marker ``_log/commits/{version}.json``. The marker is written under another name and
renamed to the next free version, never over an existing one; that rename is the commit. Readers follow the markers,
so folders of runs that died before it are never read, and the chunks they meant to load count as not loaded.

Two runs that load at the same time take different versions. The later one first looks at what was committed since it
planned its load, and gives up if any of its chunks is among that.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickgate.config import PARQUET_COMPRESSION, PARQUET_ROW_GROUP
from tickgate.session import qualified

LOADS = "blob_name string, md5 string, rows bigint"
MARKER = "run string, rows bigint, chunks bigint"


class ConflictingLoad(RuntimeError):
    """Another run has committed some of the same chunks in the meantime."""


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = qualified(spark, path).rstrip("/")
        self.log = f"{self.path}/_log"
        self.marks = f"{self.log}/commits"
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _present(self, text: str) -> bool:
        p = self._path(text)
        return p.getFileSystem(self._conf).exists(p)

    # ---- reading

    def committed(self) -> list:
        """(version, run, rows, chunks) of every commit in order; one row per run."""
        if not self._present(self.marks):
            return []
        marks = self.spark.read.schema(MARKER).option("pathGlobFilter", "*.json").json(self.marks)
        return marks.select(F.regexp_extract("_metadata.file_name", r"^(\d+)\.json$", 1).cast("bigint").alias("version"),
                            "run", "rows", "chunks").where("run IS NOT NULL").orderBy("version").collect()

    def loads(self, since: int = 0) -> DataFrame:
        """The chunks loaded by committed runs after version ``since``."""
        runs = [f"{self.log}/loads/load_run={r['run']}" for r in self.committed() if r["version"] > since]
        if not runs:
            return self.spark.createDataFrame([], LOADS)
        return self.spark.read.schema(LOADS).parquet(*runs)

    def read(self, schema: str | None = None) -> DataFrame | None:
        """The rows of the committed runs; while there are none, an empty frame of ``schema``, or None without it."""
        runs = [f"{self.path}/load_run={r['run']}" for r in self.committed() if r["rows"]]
        if not runs:
            return None if schema is None else self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", self.path).option("mergeSchema", "true").parquet(*runs)

    # ---- writing

    def stage(self, rows: DataFrame, loads: DataFrame, run: str, partition: str = "dt",
              cluster: tuple[str, ...] = ("symbol", "venue")) -> int:
        """Writes the run's rows, partitioned by ``partition``, and its list of chunks; returns the rows written."""
        counted = Observation()
        loads.select("blob_name", "md5", F.col("rows").cast("bigint")).write.parquet(f"{self.log}/loads/load_run={run}")
        # rebalance: clustered by day, but a heavy day is split over several tasks
        out = rows.hint("rebalance", partition).sortWithinPartitions(partition, *cluster)
        (out.observe(counted, F.count(F.lit(1)).alias("n")).write.partitionBy(partition)
         .option("compression", PARQUET_COMPRESSION).option("parquet.block.row.count.limit", str(PARQUET_ROW_GROUP))
         .parquet(f"{self.path}/load_run={run}"))
        return counted.get["n"]

    def commit(self, run: str, rows: int, seen: int) -> int:
        """Makes a staged run visible; ``seen`` is the last version its planner knew. Returns the new version."""
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.path).toUri(), self._conf)
        plain = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        loads = self.spark.read.schema(LOADS).parquet(f"{self.log}/loads/load_run={run}")
        mine = self._path(f"{self.marks}/.{run}.json")
        out = mine.getFileSystem(self._conf).create(mine, True)
        out.write(json.dumps({"run": run, "rows": rows, "chunks": loads.count()}).encode())
        out.close()
        version = seen
        while True:
            newer = self.loads(since=version)
            if not newer.join(loads, ["blob_name", "md5"], "left_semi").isEmpty():
                raise ConflictingLoad(f"chunks of run {run} were loaded by another run")
            version = max([version, *(r["version"] for r in self.committed())])
            target = self._path(f"{self.marks}/{version + 1:020d}.json")
            try:
                files.rename(mine, target, plain)
                return version + 1
            except Exception as e:  # noqa: BLE001 - the Java exception's class tells
                if "FileAlreadyExistsException" not in str(e):
                    raise

    def append(self, rows: DataFrame, loads: DataFrame, partition: str = "dt",
               cluster: tuple[str, ...] = ("symbol", "venue")) -> int:
        """Loads ``rows``, which are the chunks ``loads`` (blob_name, md5, rows), as one commit.

        A load whose written rows differ from what its chunks hold is not committed; chunks whose ``rows`` are all
        NULL are not counted.
        """
        done = self.committed()
        seen = done[-1]["version"] if done else 0
        run = uuid.uuid4().hex
        n = self.stage(rows, loads, run, partition, cluster)
        want = loads.agg(F.sum("rows")).first()[0]
        if want is not None and n != want:
            raise RuntimeError(f"wrote {n} rows of {want}; run {run} is not committed")
        return self.commit(run, n, seen)
