"""Session construction and shared-storage helpers."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job in the package relies on.  They are applied only when the
# caller has not set them, so a cluster's own configuration always wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "tidewatch",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local runs and tests) a private folder is created and registered.
    On a cluster an unset folder is an error: a machine-local one would not
    be visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once per context.

    Functions that run in workers are pickled by reference, so each executor
    must be able to import ``tidewatch`` whatever its working directory is.
    The zip travels through Spark's own file distribution.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tidewatch_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidewatch-pkg-"), "tidewatch.zip")
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    sc.addPyFile(path)
    sc._tidewatch_shipped = True


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the file system that its URI names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as compressed Parquet in the shared folder and read back.

    It cuts the lineage as a checkpoint does, for tables that grow with the records: a
    checkpoint holds its rows uncompressed and is read whole, Parquet by column.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()   # lets Spark's cleaner free the shuffle files behind it
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
