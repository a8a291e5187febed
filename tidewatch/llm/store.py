"""Tables written to the shared folder that the session names."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tidewatch.session import scratch_path


class Scratch:
    """Intermediate tables of one operator run.

    ``keep`` writes a frame as Parquet in the shared folder and reads it
    back, which cuts the lineage: a lost executor costs its tasks, not the
    stages before.  ``drop`` deletes a table that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        # the table stands alone: let Spark's cleaner free the shuffle files behind it
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(conf).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
