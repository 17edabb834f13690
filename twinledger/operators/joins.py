"""Joins between lists, index documents and the lake.

Two rules keep them safe when one key holds a large share of all rows. Where only
keys or counts are wanted, each side is reduced to one row per key by a map-side
combine before it is joined. Where whole rows are wanted, they stream against a
stored list, and adaptive execution splits the hot partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.functions import SOURCE_MARKER, extract_marker, key_month
from twinledger.operators import aggregates, postings
from twinledger.operators.lists import NARROW_ROWS, keep_listed, keep_possible, narrow, prune
from twinledger.session import materialize


def searched(keys: DataFrame, docs: DataFrame, max_rows: int = NARROW_ROWS) -> DataFrame:
    """Keys of the documents that a list can match, repeats included.

    Index data stored by `key_month` is read for the listed months only. A list
    short enough to broadcast filters the documents in the scan, a longer one through a
    Bloom filter if it is much shorter than the index.
    """
    if "key_month" in docs.columns:
        docs = prune(docs, "key_month", keys.select(key_month(F.col("key"))))
    return keep_possible(docs.select("key").where(F.col("key").isNotNull()), keys, ["key"], max_rows, docs)


def index_keys(keys: DataFrame, docs: DataFrame, max_rows: int = NARROW_ROWS) -> DataFrame:
    """Distinct index keys, cut down to the listed ones where that is cheap."""
    return searched(keys, docs, max_rows).distinct()


def missing_keys(keys: DataFrame, docs: DataFrame, max_rows: int = NARROW_ROWS) -> DataFrame:
    """Listed keys absent from the index, each once."""
    listed = keys.select("key").distinct()
    return listed.join(index_keys(keys, docs, max_rows), "key", "left_anti")


def present_keys(keys: DataFrame, docs: DataFrame, max_rows: int = NARROW_ROWS) -> DataFrame:
    """Listed keys found in the index, each once."""
    listed = keys.select("key").distinct()
    return listed.join(index_keys(keys, docs, max_rows), "key", "left_semi")


def key_presence(keys: DataFrame, docs: DataFrame, max_rows: int = NARROW_ROWS) -> DataFrame:
    """Listed keys, each once, with a flag `present`: one pass over the index.

    List and index keys are stacked and combined by one aggregation, which sorts neither.
    """
    listed = keys.select("key", F.lit(True).alias("listed"), F.lit(False).alias("hit")).where(F.col("key").isNotNull())
    found = searched(keys, docs, max_rows).select("key", F.lit(False).alias("listed"), F.lit(True).alias("hit"))
    flags = listed.unionByName(found).groupBy("key").agg(F.bool_or("listed").alias("listed"), F.bool_or("hit").alias("present"))
    return flags.where("listed").select("key", "present")


def count_default_zero(keys: DataFrame, docs: DataFrame, max_rows: int = NARROW_ROWS) -> DataFrame:
    """Every listed key with its number of documents, 0 if none."""
    listed = keys.select("key").distinct()
    counts = aggregates.count_by_key(searched(keys, docs, max_rows))
    return listed.join(counts, "key", "left").select(
        "key", F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("count")
    )


def source_pairs(docs: DataFrame, marker: str = SOURCE_MARKER) -> DataFrame:
    """(source_id, document) for every id named in a text: one pass, all ids.

    `docs` may be stored postings (`sources.read_markers`) in place of texts.
    """
    if postings.are(docs):
        return postings.of_marker(docs, marker).withColumnRenamed("value", "source_id")
    return docs.withColumn("source_id", F.explode(extract_marker(F.col("content"), marker))).drop(
        "content"
    )


def phrase_pairs(
    ids: DataFrame, docs: DataFrame, marker: str = SOURCE_MARKER, max_rows: int = NARROW_ROWS
) -> DataFrame:
    """Listed source ids with the documents naming them, one row per pair.

    Document columns other than `content` are kept.
    """
    return keep_listed(source_pairs(docs, marker), ids, ["source_id"], max_rows)


def lake_counts(
    id_keys: DataFrame, stage: DataFrame, entity: str, max_rows: int = NARROW_ROWS
) -> DataFrame:
    """(source_id, quadrimester) rows with their number of lake rows, 0 if none.

    Only the lake partitions of the quadrimesters asked for are read; their rows
    are counted per pair. `id_keys` is read several times, so pass stored ones.
    The counts are stored before the join, so that an id with many rows on
    the left can be split over tasks (see `lists.keep_listed`).
    """
    rows = stage.where(F.col("reporting_entity") == entity).select("source_id", "quadrimester")
    rows = prune(rows, "quadrimester", id_keys.select("quadrimester"))
    rows = narrow(rows, id_keys.where(F.col("source_id").isNotNull()), ["source_id"], max_rows)
    counts = materialize(
        rows.groupBy("source_id", "quadrimester").agg(F.count("*").alias("lake_count")), "lake-counts"
    )
    return id_keys.join(counts, ["source_id", "quadrimester"], "left").fillna(0, ["lake_count"])


def align_histograms(left: DataFrame, right: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Two histograms (bucket, n) side by side, missing = 0."""
    on = on or ["bucket"]
    return (
        left.withColumnRenamed("n", "left_n")
        .join(right.withColumnRenamed("n", "right_n"), on, "full")
        .fillna(0, ["left_n", "right_n"])
    )


def one_sided_keys(
    left: DataFrame, right: DataFrame, on: list[str], left_name: str, right_name: str
) -> DataFrame:
    """Rows of `on` (the last being the key) held by one side only.

    Same answer as a full outer join of two distinct sets, with one shuffle:
    both sides are stacked and each value's side flags combined map-side.
    """
    key = on[-1]
    flags = left.select(*on, F.lit(True).alias("l"), F.lit(False).alias("r")).unionByName(
        right.select(*on, F.lit(False).alias("l"), F.lit(True).alias("r"))
    )
    return (
        flags.where(F.col(key).isNotNull())
        .groupBy(*on)
        .agg(F.bool_or("l").alias("l"), F.bool_or("r").alias("r"))
        .where(F.col("l") != F.col("r"))
        .select(*on, F.when(F.col("l"), left_name).otherwise(right_name).alias("source"))
    )


def under_frontier(df: DataFrame, ts, frontier: DataFrame, level: str) -> DataFrame:
    """Rows whose bucket at `level` is in the frontier (column `bucket`).

    Rows stream; the frontier, read from storage, has each bucket once. Spark
    broadcasts it when its known size allows, else shuffles both sides.
    """
    return (
        df.withColumn("bucket", F.date_trunc(level, ts))
        .join(frontier.select("bucket"), "bucket", "left_semi")
        .drop("bucket")
    )
