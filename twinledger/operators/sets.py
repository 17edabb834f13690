"""Set operations on keys, buckets and done-sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(stage: DataFrame) -> DataFrame:
    """Distinct keys; NULL counts as one value."""
    return stage.select("key").distinct()


def _only(mine: DataFrame, other: DataFrame) -> DataFrame:
    keys = mine.select("key").where(F.col("key").isNotNull()).distinct()
    return keys.join(other.select("key").distinct(), "key", "left_anti")


def index_only(index: DataFrame, lake: DataFrame) -> DataFrame:
    return _only(index, lake)


def lake_only(index: DataFrame, lake: DataFrame) -> DataFrame:
    return _only(lake, index)


def bucket_union(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("bucket").union(right.select("bucket")).distinct()
