from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from pollweave import session


def test_written_table(spark):
    df = spark.range(5).withColumn("a b", F.lit("x"))
    got = session.written(df)
    assert got.dtypes == df.dtypes and sorted(got.collect()) == sorted(df.collect())
    assert session.written(df.limit(0)).count() == 0


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "k8s://h", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_folder(master):
    spark = SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError):
        session.checkpoint_dir(spark)


def test_broadcast_by_bytes(spark):
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    df = spark.createDataFrame([("x" * 1000,), (None,)], "v string")
    assert hinted(session.broadcast_if_small(df, 1100)) and not hinted(session.broadcast_if_small(df, 1000))
    assert hinted(session.broadcast_if_small(df.limit(0), 0))
