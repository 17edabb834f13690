"""Postings: a row per document and value that its text names after a marker.

Filters and joins that search texts take postings in their place. They are known by
their columns `marker` and `value`; the document's other columns stand beside them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions import extract_marker

# Columns that belong to the store, not to the document.
STORED = ("file", "run", "month")


def are(docs: DataFrame) -> bool:
    return {"marker", "value"} <= set(docs.columns) and "content" not in docs.columns


def named(docs: DataFrame, markers: Iterable[str]) -> DataFrame:
    """Documents whose texts name any value: `named`, an array of (marker, distinct value), in
    place of `content`."""

    def of(marker: str) -> Column:
        values = extract_marker(F.col("content"), marker)
        return F.transform(values, lambda v: F.struct(F.lit(marker).alias("marker"), v.alias("value")))

    found = docs.withColumn("named", F.concat(*map(of, markers))).drop("content")
    return found.where(F.size("named") > 0)


def spread(found: DataFrame) -> DataFrame:
    """One row per document and element of `named`."""
    rows = found.withColumn("posting", F.explode("named"))
    return rows.select("posting.*", *(c for c in found.columns if c != "named"))


def of_texts(docs: DataFrame, markers: Iterable[str]) -> DataFrame:
    """One row per document, marker and distinct value; texts without any give none."""
    return spread(named(docs, markers))


def of_marker(found: DataFrame, marker: str) -> DataFrame:
    """`value` and the documents' columns for one marker."""
    return found.where(F.col("marker") == F.lit(marker)).drop("marker", *STORED)
