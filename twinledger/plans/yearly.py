"""Distinct keys (or any column) per year bucket and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import year_bucket_label, year_bucket_values
from twinledger.functions.calendar import OTHER_BUCKET
from twinledger.operators import aggregates, filters
from twinledger.sources import mark_done, params_hash, read_ledger
from twinledger.sources.ledger import read_if_present

JOB = "year_counts"


def year_counts(
    stage: DataFrame, entity: str, labels: list[str] | None = None, field: str = "key"
) -> DataFrame:
    """bucket, year, {field}_count for all requested buckets in one plan.

    Without labels every bucket present is counted, `other` for quadrimester
    values that belong to none. With labels a filter on the quadrimester alone
    prunes partitions; one aggregation serves all buckets, since a quadrimester
    value belongs to exactly one.
    """
    rows = filters.by_entity(stage, entity)
    if labels is not None:
        buckets = year_bucket_values(labels)
        wanted = F.col("quadrimester").isin(*(q for group in buckets.values() for q in group))
        if OTHER_BUCKET in buckets:
            wanted = F.coalesce(wanted, F.lit(False)) | (year_bucket_label(F.col("quadrimester")) == OTHER_BUCKET)
        rows = rows.where(wanted)
    return aggregates.distinct_by_bucket_year(rows, field)


def run_year_counts(
    stage: DataFrame,
    entity: str,
    root: str,
    labels: list[str] | None = None,
    field: str = "key",
) -> DataFrame:
    """Count the buckets not done yet, store them, record them, return all.

    Output is one folder per bucket, replaced as a whole, and recorded only
    after it is written: a run that stops in between is simply repeated. The
    ledger is kept per entity and field. A bucket without rows is done too.
    """
    spark = stage.sparkSession
    params = params_hash(entity=entity, field=field)
    out = f"{root}/{JOB}/params={params}"
    if labels is None:
        # At most a label per 4-digit year, and the special ones.
        present = filters.by_entity(stage, entity).select(year_bucket_label(F.col("quadrimester")).alias("b"))
        labels = sorted(row.b for row in present.distinct().collect())
    requested = year_bucket_values(labels)
    # At most one ledger row per requested label comes back.
    done = read_ledger(spark, root, JOB, params).where(F.col("unit").isin(*requested))
    finished = {row.unit for row in done.collect()}
    pending = [label for label in requested if label not in finished]
    if pending:
        year_counts(stage, entity, pending, field).repartition("bucket").write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(out)
        mark_done(spark.createDataFrame([(p,) for p in pending], "unit string"), root, JOB, params)
    columns = f"year int, {field}_count bigint, bucket string"
    return read_if_present(spark, out, T.StructType.fromDDL(columns))


def year_counts_report(counts: DataFrame, bucket: str, field: str = "key") -> DataFrame:
    """One bucket's rows under the report's column names, by year."""
    return counts.where(F.col("bucket") == bucket).select("year", f"{field}_count").orderBy(F.col("year").asc_nulls_last())
