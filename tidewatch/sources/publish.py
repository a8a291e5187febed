"""A run's tables published as one unit.

The tables of a run are written under ``runs/<run>/<table>``; what makes them
visible is the run's manifest, a single Parquet file written last.  A run that
fails before that leaves the former run in place, and a repeated run replaces
what it had left.  A committed run is never written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.config import load_table_or_empty

MANIFEST = "run bigint, name string, folder string, row_count bigint, committed_at timestamp"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed run and table; empty where nothing is published."""
    return load_table_or_empty(spark, f"{path}/manifest", MANIFEST)


def last_run(spark: SparkSession, path: str) -> int | None:
    return manifest(spark, path).agg(F.max("run")).first()[0]


def publish(spark: SparkSession, path: str, run: int, tables: dict[str, DataFrame],
            partition_by: dict[str, str] | None = None) -> bool:
    """Write ``tables`` and commit them as ``run``; False if that run is already
    committed.  ``partition_by`` names the partition column of large tables."""
    if not manifest(spark, path).where(F.col("run") == run).isEmpty():
        return False
    rows = []
    for name, df in tables.items():
        folder = f"runs/{run}/{name}"
        writer = df.write.mode("overwrite")
        if partition_by and name in partition_by:
            writer = writer.partitionBy(partition_by[name])
        writer.parquet(f"{path}/{folder}")
        written = spark.read.schema(df.schema).parquet(f"{path}/{folder}")
        rows.append((run, name, folder, written.count()))   # from the files' footers
    done = spark.createDataFrame(rows, "run bigint, name string, folder string, row_count bigint")
    # one file: it appears whole or not at all
    (done.withColumn("committed_at", F.current_timestamp()).coalesce(1)
     .write.mode("overwrite").partitionBy("run").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/manifest"))
    return True


def read_published(spark: SparkSession, path: str, name: str, run: int | None = None) -> DataFrame:
    """Table ``name`` of a committed run (default: the last one)."""
    run = last_run(spark, path) if run is None else run
    row = manifest(spark, path).where((F.col("run") == run) & (F.col("name") == name)).first()
    if row is None:
        raise ValueError(f"{path}: no committed run has a table {name}")
    return spark.read.parquet(f"{path}/{row['folder']}")
