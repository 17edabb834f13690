"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# All windows and labels are UTC. Partition values such as month=01 are text:
# without type inference off, Spark would read them back as integers. The Arrow
# bound keeps batches of long rows (500 keys each) small in Python workers.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 * 1024 * 1024),
}

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc.applicationId not in _local_scratch:
        _local_scratch[sc.applicationId] = tempfile.mkdtemp(prefix="twinledger-")
    return _local_scratch[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/twinledger/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write once to the scratch area and read back.

    Cuts lineage, survives executor loss and keeps Parquet's column pruning,
    which an RDD checkpoint would not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
