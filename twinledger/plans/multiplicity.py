"""How often source ids occur in text, and keys in the index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import SOURCE_MARKER, classify
from twinledger.operators import aggregates, filters, joins, ordering
from twinledger.operators.lists import NARROW_ROWS, narrow
from twinledger.session import materialize
from twinledger.sources import append_outcomes, done_keys, read_outcomes

SOURCE_OUTCOMES = T.StructType(
    [T.StructField("source_id", T.StringType()), T.StructField("n", T.LongType())]
)
KEY_OUTCOMES = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("count", T.LongType())]
)


def source_multiplicity(
    ids: DataFrame,
    docs: DataFrame,
    archived_from=None,
    archived_before=None,
    marker: str = SOURCE_MARKER,
    max_rows: int = NARROW_ROWS,
) -> DataFrame:
    """source_id, n, outcome (zero, unique, duplicate) for every listed id.

    All documents count unless `archived_from` or `archived_before` bounds their
    archiving time. All texts are searched once for all ids. Documents are counted per id before
    the shuffle, so an id named in most texts crosses it as a few rows.
    """
    dated = filters.in_archived_range(docs, archived_from, archived_before)
    pairs = joins.source_pairs(dated, marker).select("source_id")
    pairs = narrow(pairs, ids, ["source_id"], max_rows)
    counts = aggregates.count_by_source(pairs, ids)
    return counts.select("source_id", "n", classify(F.col("n")).alias("outcome"))


def key_multiplicity(
    keys: DataFrame, docs: DataFrame, max_rows: int = NARROW_ROWS
) -> DataFrame:
    """key, count for every distinct listed key, 0 included."""
    return joins.count_default_zero(keys, docs, max_rows)


def run_source_multiplicity(
    ids: DataFrame, docs: DataFrame, path: str, limit: int | None = None, **options
) -> DataFrame:
    """Classify ids not classified before, append by outcome, return all."""
    spark = ids.sparkSession
    before = read_outcomes(spark, path, SOURCE_OUTCOMES)
    done = done_keys(before, "source_id", ["zero", "unique", "duplicate"])
    pending = materialize(ordering.limit_inputs(ids, done, "source_id", limit), "pending-ids")
    append_outcomes(source_multiplicity(pending, docs, **options), path)
    return read_outcomes(spark, path, SOURCE_OUTCOMES)


def run_key_multiplicity(
    keys: DataFrame, docs: DataFrame, path: str, limit: int | None = None, **options
) -> DataFrame:
    """Count keys not counted before, append, return all."""
    spark = keys.sparkSession
    before = read_outcomes(spark, path, KEY_OUTCOMES)
    pending = ordering.limit_inputs(keys, done_keys(before, "key", ["counted"]), "key", limit)
    pending = materialize(pending, "pending-keys")
    counted = key_multiplicity(pending, docs, **options).withColumn("outcome", F.lit("counted"))
    append_outcomes(counted, path)
    return read_outcomes(spark, path, KEY_OUTCOMES)
