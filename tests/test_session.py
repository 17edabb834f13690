from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from twinledger.session import SETTINGS, materialize, scratch_root


def stub(master, folder=None):
    conf = SimpleNamespace(get=lambda name, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_cluster_needs_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(stub("yarn"))
    assert scratch_root(stub("yarn", "hdfs://shared/cp/")) == "hdfs://shared/cp"


def test_configured(spark):
    assert all(spark.conf.get(name) == value for name, value in SETTINGS.items())


def test_materialized_table_has_no_lineage_and_the_same_rows(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("k"), (F.col("id") % 2).cast("string").alias("p"))
    stored = materialize(df, "t", ["p"])
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "FileScan parquet" in plan
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))
    assert stored.schema["p"].dataType.simpleString() == "string"
