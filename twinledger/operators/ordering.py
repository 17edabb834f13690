"""Sorting and input limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinledger.operators.filters import not_done
from twinledger.session import materialize


def sort_buckets(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending, NULLs last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def sort_documents(docs: DataFrame) -> DataFrame:
    """Documents by time, then id; the id splits a time that many share."""
    return docs.orderBy(F.col("start_ts").asc_nulls_last(), F.col("doc_id"))


def limit_inputs(inputs: DataFrame, done: DataFrame | None, on: str, n: int | None) -> DataFrame:
    """The first n distinct inputs in list order, counted after dropping finished
    ones. An input listed many times is combined before any shuffle."""
    if n is None:
        listed = inputs.select(on).distinct()
        return listed if done is None else not_done(listed, done, on)
    place = F.min(F.struct("src_file", "src_block", "src_line")).alias("place")
    listed = inputs.groupBy(on).agg(place)
    pending = materialize(listed if done is None else not_done(listed, done, on), "pending-inputs")
    pending = pending.select(on, "place.src_file", "place.src_block", "place.src_line")
    # One row per file split: whole splits up to the cut, and part of the one it falls in.
    split = ["src_file", "src_block"]
    sizes = pending.groupBy(*split).agg(F.count("*").alias("held"))
    reach = sizes.withColumn("upto", F.sum("held").over(Window.orderBy(*split)))
    reach = reach.select(*split, "upto", (F.col("upto") - F.col("held")).alias("before")).where(F.col("before") < n)
    placed = pending.join(reach, split)
    last = placed.where(F.col("upto") > n).withColumn(
        "rank", F.row_number().over(Window.partitionBy(*split).orderBy("src_line"))
    )
    return placed.where(F.col("upto") <= n).select(on).union(
        last.where(F.col("rank") <= n - F.col("before")).select(on)
    )
