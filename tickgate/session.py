"""Session helpers: a local session for tests, checkpoint folder, written tables, qualified paths."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tickgate") -> SparkSession:
    """Session for tests and the bench. On a cluster, build your own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset (tests, local runs)
    a scratch folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the setting
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            conf_dir = tempfile.mkdtemp(prefix="tickgate-ckpt-")
            spark.conf.set("spark.checkpoint.dir", conf_dir)
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            # a driver-local folder is invisible to executors on a cluster
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) "
                               "for lineage cuts on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="tickgate-ckpt-")
        os.makedirs(conf_dir, exist_ok=True)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss).

    Used on aggregate or join outputs only: the checkpoint's write job then
    reuses the shuffle files of the first pass (the map stage is skipped), so
    the input is scanned once. For a plan without a shuffle use
    ``write_table``, which computes it exactly once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Materialise ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Later reads take only the columns and, with ``partition_by``, the partitions that they need.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if partition_by else spark.read.parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority that Spark resolves it to (metadata only).

    A scheme-less path belongs to the session's default file system, which on a cluster
    need not be the local one; a relative path is completed.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python tasks wherever the driver was started.

    Zips the package's sources and adds the file to the session once; executors fetch it
    from the driver, so neither PYTHONPATH nor an installed copy is needed there.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tickgate_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tickgate-src-"), "tickgate.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, dirs, names in os.walk(top):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("tickgate", os.path.relpath(full, top)))
    sc.addPyFile(path)
    sc._tickgate_shipped = True


def arrow_uri(path: str) -> str:
    """A path as pyarrow's filesystem layer wants it ('file:/x' and '/x' -> 'file:///x')."""
    if path.startswith("file:"):
        rest = path[len("file:"):]
        return "file:///" + rest.lstrip("/")
    if "://" in path:
        return path
    return "file://" + os.path.abspath(path)
