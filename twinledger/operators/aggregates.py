"""Counts. Distinct counts are not additive over levels: each level counts rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions import bucket_start, epoch_ts, time_unit, year_bucket_label, year_month


def distinct_by_year(stage: DataFrame, field: str = "key") -> DataFrame:
    """Distinct values of a column per year of start_time."""
    return stage.groupBy(F.year(epoch_ts(F.col("start_time"))).alias("year")).agg(
        F.count_distinct(F.col(field)).alias(f"{field}_count")
    )


def distinct_by_bucket_year(stage: DataFrame, field: str = "key") -> DataFrame:
    """The same within each year bucket; a year can occur in two buckets."""
    return stage.groupBy(
        year_bucket_label(F.col("quadrimester")).alias("bucket"),
        F.year(epoch_ts(F.col("start_time"))).alias("year"),
    ).agg(F.count_distinct(F.col(field)).alias(f"{field}_count"))


def distinct_by_month(stage: DataFrame, field: str = "key") -> DataFrame:
    return stage.groupBy(year_month(epoch_ts(F.col("start_time"))).alias("year_month")).agg(
        F.count_distinct(F.col(field)).alias(f"{field}_count")
    )


def distinct_by_unit(stage: DataFrame, unit: str, field: str = "key") -> DataFrame:
    """Distinct values per day, hour, minute or second, for every parent window
    at once: `bucket` is the unit's start, `unit` its number in the parent."""
    ts = epoch_ts(F.col("start_time"))
    return (
        stage.where(ts.isNotNull())
        .groupBy("quadrimester", bucket_start(unit, ts).alias("bucket"))
        .agg(F.count_distinct(F.col(field)).alias(f"{field}_count"))
        .withColumn("unit", time_unit(unit, F.col("bucket")))
    )


def histogram(docs: DataFrame, level: str) -> DataFrame:
    """Documents per calendar bucket; empty buckets and undated documents do not
    appear."""
    return docs.where(F.col("start_ts").isNotNull()).groupBy(bucket_start(level, F.col("start_ts")).alias("bucket")).agg(
        F.count("*").alias("n")
    )


def count_filtered(docs: DataFrame, predicate: Column) -> DataFrame:
    """One row: documents meeting a predicate."""
    return docs.where(predicate).agg(F.count("*").alias("n"))


def count_by_key(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("key").isNotNull()).groupBy("key").agg(F.count("*").alias("n"))


def content_checksum(columns: list[str]) -> list[Column]:
    """Aggregates that tell two multisets of rows apart, whatever their order.

    Rows, and of two independent row hashes the sums of their halves and the xor: a
    changed, lost or doubled row changes them, save by a chance of about 2^-64. Nulls
    are told from empty texts and from nulls in other columns.
    """
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    hashes = [F.xxhash64(F.lit(seed), *parts) for seed in (0, 1)]
    sums = [F.sum(half) for h in hashes for half in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    return [F.count("*").alias("n"), *(x.alias(f"sum{i}") for i, x in enumerate(sums)), F.bit_xor(hashes[0]).alias("xor")]


def count_by_source(pairs: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Documents per source id. A document names an id once in `pairs`, so rows
    are documents and no distinct is needed.

    With `listed`: each listed id once, 0 if none names it. Both are combined in one
    aggregation, so that a task holds one table of ids and sorts nothing.
    """
    if listed is None:
        return pairs.groupBy("source_id").agg(F.count("*").alias("n"))

    def stacked(rows: DataFrame, n: int) -> DataFrame:
        return rows.select("source_id", F.lit(n).cast("bigint").alias("n"), F.lit(n == 0).alias("listed"))

    both = stacked(pairs.where(F.col("source_id").isNotNull()), 1).unionByName(stacked(listed, 0))
    counts = both.groupBy("source_id").agg(F.sum("n").alias("n"), F.bool_or("listed").alias("listed"))
    return counts.where("listed").drop("listed")


def stage_rows(stage: DataFrame) -> DataFrame:
    return stage.groupBy("reporting_entity", "quadrimester", "source_id").agg(
        F.count("*").alias("n")
    )


def verify_counts(df: DataFrame) -> DataFrame:
    """Rows and distinct source ids per quadrimester."""
    return df.groupBy("quadrimester").agg(
        F.count("*").alias("total_rows"), F.count_distinct("source_id").alias("distinct_sources")
    )


def level_stats(mismatches: DataFrame, outstanding: DataFrame) -> DataFrame:
    """Mismatched buckets per level and outstanding keys per side."""
    return (
        mismatches.groupBy(F.concat(F.lit("mismatched_"), F.col("level")).alias("counter"))
        .agg(F.count("*").alias("n"))
        .unionByName(
            outstanding.groupBy(F.concat(F.lit("keys_"), F.col("source")).alias("counter")).agg(
                F.count("*").alias("n")
            )
        )
    )


def duplicate_summary(counts: DataFrame) -> DataFrame:
    """One row: keys counted, and those counted more than once."""
    return counts.agg(
        F.count("*").alias("keys_counted"), F.count_if(F.col("count") > 1).alias("duplicate_keys")
    )
