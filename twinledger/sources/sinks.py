"""Writers. Every write is a directory dataset; no result passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger import schemas
from twinledger.functions import safe_error


def write_partitioned(df: DataFrame, path: str) -> None:
    """Dedup rows to year/quadrimester/month folders, replacing those written.

    The rebalance sizes files by partition value at run time: a month that holds
    most rows is split over many tasks, small months share one.
    """
    (
        df.select(*schemas.DEDUP.fieldNames())
        .hint("rebalance", *[F.col(c) for c in schemas.DEDUP_PARTITIONS])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*schemas.DEDUP_PARTITIONS)
        .parquet(path)
    )


def write_quadrimester(df: DataFrame, path: str, label: str) -> None:
    """Replace one quadrimester of the dedup table as a whole.

    Unlike a dynamic overwrite this also removes a month that no longer has rows.
    """
    (
        df.where(F.col("quadrimester") == label)
        .select(*schemas.DEDUP_COLUMNS, "month")
        .hint("rebalance", F.col("month"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "snappy")
        .partitionBy("month")
        .parquet(f"{path}/year={label.split('-T')[0]}/quadrimester={label}")
    )


def write_flat(df: DataFrame, path: str) -> None:
    """Publish rows without the partition columns."""
    df.select(*schemas.DEDUP_COLUMNS).write.mode("overwrite").option(
        "compression", "snappy"
    ).parquet(path)


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system and from its root, as tables record it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.makeQualified(place).toString().rstrip("/")


def create_dedup_table(spark: SparkSession, table: str, path: str) -> None:
    """External partitioned table over `path`, if absent.

    A table of that name over another folder is refused: its rows would be
    verified in place of those written to `path`.
    """
    if spark.catalog.tableExists(table):
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
        found = described.where(F.col("col_name") == "Location").first().data_type
        if _qualified(spark, found) != _qualified(spark, path):
            raise ValueError(f"table {table} exists over {found}, not {path}")
        return
    columns = ", ".join(f"{c} STRING" for c in schemas.DEDUP.fieldNames())
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(schemas.DEDUP_PARTITIONS)}) LOCATION '{location}'"
    )


def repair_table(spark: SparkSession, table: str) -> None:
    """Register partition folders written since, and forget removed ones."""
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def write_report(df: DataFrame, path: str) -> None:
    """Append rows as CSV; each part file carries the header."""
    df.write.mode("append").option("header", True).csv(path)


def write_routed(df: DataFrame, path: str) -> None:
    """One folder per outcome."""
    df.write.mode("append").partitionBy("outcome").parquet(path)


def _run_columns(outcomes: DataFrame) -> list[str]:
    return [c for c in ("feed", "run") if c in outcomes.columns]


def failed_batches(outcomes: DataFrame) -> DataFrame:
    """Failed work, one row per batch: stage, size, error, ;-joined keys.

    Batch names repeat from run to run, so rows of stored outcomes are told apart
    by `feed` and `run` too. Groups are batches, which `make_batches` bounds to
    its batch size.
    """
    return (
        outcomes.where(F.col("outcome") == "failed")
        .groupBy(*_run_columns(outcomes), "stage", "batch")
        .agg(
            F.count("*").alias("batch_size"),
            safe_error(F.max("error")).alias("error_message"),
            F.concat_ws(";", F.sort_array(F.collect_list("key"))).alias("keys"),
        )
    )


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Rows per outcome, and batches where the outcomes name them."""
    counts = [F.count("*").alias("n")]
    if "batch" in outcomes.columns:
        names = F.when(F.col("batch").isNotNull(), F.struct(*_run_columns(outcomes), "batch"))
        counts.append(F.count_distinct(names).alias("batches"))
    return outcomes.groupBy("outcome").agg(*counts)
