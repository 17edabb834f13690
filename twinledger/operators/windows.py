"""Ranking and batching."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinledger.functions import key_month
from twinledger.session import materialize

# A task numbers about this many keys of a batch list.
PART_ROWS = 1_000_000

# Latest first; the two last columns make ties deterministic.
LATEST = ("time_stamp", "key", "message_id")


def rank_latest(
    df: DataFrame, by: list[str], order: tuple[str, ...] = LATEST, keep: int = 1
) -> DataFrame:
    """The `keep` latest rows of each group, numbered in `rn`.

    The bound is part of the operator: Spark turns it into a group limit that
    runs before the shuffle, so each map task sends at most `keep` rows of a
    group, however large the group is.
    """
    window = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("rn", F.row_number().over(window)).where(F.col("rn") <= keep)


def limit_per_id(pairs: DataFrame, n: int, on: str = "source_id") -> DataFrame:
    """At most n rows per id, smallest key first. No job does so unless asked to."""
    window = Window.partitionBy(on).orderBy(F.col("key").asc_nulls_last(), F.col("doc_id"))
    return pairs.withColumn("rn", F.row_number().over(window)).where(F.col("rn") <= n).drop("rn")


def make_batches(keys: DataFrame, n: int = 500, part_rows: int = PART_ROWS) -> DataFrame:
    """Number keys into batches of n within their index month; adds `key_month`, `batch_no`.

    Every batch but a month's last has n keys, in order of key. More than `part_rows`
    keys are dealt to tasks by ranges of (month, key) of about that size and stored so;
    the ranges' sizes, summed up in their order, tell where in its month each range
    begins, and a key's number is that plus its place in the range. The keys are read
    twice, so pass stored ones. The broadcast sizes have a row per range, and one more
    for each further month in it.
    """
    tagged = keys.withColumn("key_month", key_month(F.col("key")))
    parts = -(-tagged.count() // part_rows)
    in_order = Window.orderBy("key")
    if parts <= 1:
        place = F.row_number().over(in_order.partitionBy("key_month")) - 1
        return tagged.withColumn("batch_no", F.call_function("div", place.cast("bigint"), F.lit(n)))
    # Stored, which fixes what is in which range.
    ranged = tagged.repartitionByRange(parts, "key_month", "key").withColumn("slot", F.spark_partition_id())
    ranged = materialize(ranged, "key-ranges")
    sizes = ranged.groupBy("key_month", "slot").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("key_month").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("key_month", "slot", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("begin"))
    place = F.col("begin") + F.row_number().over(in_order.partitionBy("key_month", "slot")) - 1
    numbered = ranged.join(F.broadcast(begins), ["key_month", "slot"])
    return numbered.withColumn("batch_no", F.call_function("div", place, F.lit(n))).drop("slot", "begin")


def batch_payloads(batches: DataFrame) -> DataFrame:
    """One row per batch with its keys and the comma-joined body to deliver."""
    return (
        batches.groupBy("key_month", "batch_no")
        .agg(F.sort_array(F.collect_list("key")).alias("keys"))
        .select(
            F.concat_ws("/", "key_month", "batch_no").alias("batch"),
            F.size("keys").alias("batch_size"),
            F.array_join("keys", ",").alias("payload"),
            "keys",
        )
    )
