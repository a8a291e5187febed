import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewatch.sources import publish as P


def test_runs_appear_whole_or_not_at_all(spark, tmp_path):
    path = f"{tmp_path}/out"
    assert P.last_run(spark, path) is None and P.manifest(spark, path).count() == 0
    with pytest.raises(ValueError):
        P.read_published(spark, path, "a")
    one = spark.range(5).withColumn("source", F.when(F.col("id") > 2, "s").otherwise(F.lit(None).cast("string")))
    none = one.where("id < 0")
    assert P.publish(spark, path, 1, {"a": one, "empty": none}, {"a": "source", "empty": "source"})
    bad = spark.range(3).withColumn("source", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(PySparkException):
        P.publish(spark, path, 2, {"a": one.where("id = 0"), "empty": bad})
    assert P.last_run(spark, path) == 1 and P.read_published(spark, path, "a").count() == 5
    assert {r["name"]: r["row_count"] for r in P.manifest(spark, path).collect()} == {"a": 5, "empty": 0}
    assert P.publish(spark, path, 2, {"a": one.where("id < 2")})
    assert P.read_published(spark, path, "a").count() == 2 and P.read_published(spark, path, "a", 1).count() == 5
    # a committed run is left as it is
    assert not P.publish(spark, path, 2, {"a": one})
    assert P.read_published(spark, path, "a").count() == 2
