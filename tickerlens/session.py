"""Session helpers: building a session, shared scratch paths, stored intermediate tables."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_A_TASK = 50_000  # of rows that are blown up
BROADCAST_KEYS = 1_000_000  # short keys that every executor may hold


def build_session(master: str = "local[*]", app: str = "tickerlens", extra: dict | None = None) -> SparkSession:
    """A session with the defaults used here. The number of shuffle partitions is the
    cluster's setting (an upper bound that AQE merges below); pass it in ``extra``."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # AQE coalesces shuffle output toward this size and splits partitions
         # several times larger (skew)
         .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator (a shared filesystem path). Only when
    it is unset (local tests, the driver's smoke session) do we create one.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tickerlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage at a fan-out point: a reliable checkpoint written to the shared
    checkpoint folder. Later stages read it instead of recomputing the plan
    once per consumer, and a lost executor only costs the stages after it."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused directory path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "tickerlens", f"{name}-{uuid.uuid4().hex[:12]}")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame, rows: int = 0) -> DataFrame:
    """The rows dealt out evenly over the cluster's number of shuffle partitions, or over more of
    ``ROWS_A_TASK`` each if there may be so many ``rows``. A Parquet file of few bytes is one task,
    however much each of its rows is blown up later; AQE leaves this number as it is."""
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_TASK)))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: several consumers
    read it instead of computing it again, and its columns can be pruned."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_keys(df: DataFrame, name: str) -> DataFrame | None:
    """The distinct rows of ``df``, short keys, marked for broadcast; None if there are more than
    ``BROADCAST_KEYS``. Stored and counted first: left to AQE, the other side of a join may be
    made and shuffled whole before these are known to be few."""
    keys = stored(df.distinct(), name)
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else None


def ship_package(spark: SparkSession) -> str:
    """Make ``tickerlens`` importable on executors (the pandas-UDF and
    mapInPandas paths run package code there): zip the package in memory, write
    it into the shared checkpoint folder through the Hadoop FileSystem API (so a
    cluster URI works), and register it with ``addPyFile``. Not needed when the
    package is installed on the cluster image or passed with --py-files."""
    import io
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    target = os.path.join(checkpoint_root(spark), "tickerlens", f"pkg-{uuid.uuid4().hex[:8]}.zip")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    spark.sparkContext.addPyFile(target)
    return target


_SHIPPED: set = set()


def ensure_shipped(spark: SparkSession) -> None:
    """Ship the package once per application before a Python-worker path runs
    (a no-op when it is already importable there, e.g. installed on the image)."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        ship_package(spark)
        _SHIPPED.add(app)
