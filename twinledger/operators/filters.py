"""Row filters. Values are bound as literals, never pasted into SQL text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions import ENTITY_MARKER, SOURCE_MARKER, expand_years, extract_marker
from twinledger.operators import postings
from twinledger.operators.lists import NARROW_ROWS, keep_listed


def _ts(value: str | datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def by_entity(df: DataFrame, entity: str) -> DataFrame:
    return df.where(F.col("reporting_entity") == F.lit(entity))


def by_quadrimester(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col("quadrimester") == F.lit(label))


def by_quadrimesters(df: DataFrame, labels: list[str]) -> DataFrame:
    return df.where(F.col("quadrimester").isin(*labels))


def in_window(df: DataFrame, ts: Column, start, end_exclusive) -> DataFrame:
    """start <= ts < end."""
    return df.where((ts >= _ts(start)) & (ts < _ts(end_exclusive)))


def in_window_ms(docs: DataFrame, start, end_exclusive) -> DataFrame:
    """Document times at millisecond precision, upper bound end - 1 ms included.

    A time with microseconds in the last millisecond counts as inside, so at
    that precision this is the half-open window, and stays a plain range that
    reaches the scan.
    """
    if postings.are(docs):
        docs = _in_months(docs, start, end_exclusive)
    return in_window(docs, F.col("start_ts"), start, end_exclusive)


def _in_months(found: DataFrame, start, end_exclusive) -> DataFrame:
    """Folders of postings that a range of start times can touch."""
    month = F.col("month")
    if start is not None:
        found = found.where(month >= F.date_format(_ts(start), "yyyy-MM"))
    return found if end_exclusive is None else found.where(month <= F.date_format(_ts(end_exclusive), "yyyy-MM"))


def _in_range(docs: DataFrame, column: str, start, end_exclusive) -> DataFrame:
    if column == "start_ts" and postings.are(docs):
        docs = _in_months(docs, start, end_exclusive)
    if start is not None:
        docs = docs.where(F.col(column) >= _ts(start))
    return docs if end_exclusive is None else docs.where(F.col(column) < _ts(end_exclusive))


def in_start_range(docs: DataFrame, start=None, end_exclusive=None) -> DataFrame:
    """start <= start_ts < end. A bound of None is none; without any, undated
    documents stay too."""
    return _in_range(docs, "start_ts", start, end_exclusive)


def in_archived_range(docs: DataFrame, start=None, end_exclusive=None) -> DataFrame:
    """The same for archived_ts."""
    return _in_range(docs, "archived_ts", start, end_exclusive)


def with_listed_keys(
    docs: DataFrame, keys: DataFrame, max_rows: int = NARROW_ROWS
) -> DataFrame:
    """Documents whose key is listed."""
    return keep_listed(docs, keys, ["key"], max_rows, reduce=True)


def _has_marker(docs: DataFrame, marker: str, value: str) -> DataFrame:
    if postings.are(docs):
        return postings.of_marker(docs, marker).where(F.col("value") == F.lit(value)).drop("value")
    # The byte searches are cheap and rule out most texts before the pattern runs.
    return docs.where(
        F.contains(F.col("content"), F.lit(f"{marker}:"))
        & F.contains(F.col("content"), F.lit(value))
        & F.array_contains(extract_marker(F.col("content"), marker), F.lit(value))
    )


def with_entity_phrase(docs: DataFrame, entity: str, marker: str = ENTITY_MARKER) -> DataFrame:
    return _has_marker(docs, marker, entity)


def with_source_phrase(docs: DataFrame, source_id: str, marker: str = SOURCE_MARKER) -> DataFrame:
    """Documents naming one source id. For many ids use `joins.phrase_pairs`."""
    return _has_marker(docs, marker, source_id)


def latest_only(ranked: DataFrame) -> DataFrame:
    return ranked.where(F.col("rn") == 1).drop("rn")


def duplicates(counts: DataFrame, n: str = "n") -> DataFrame:
    return counts.where(F.col(n) > 1)


def mismatched(pair: DataFrame) -> DataFrame:
    return pair.where(F.col("left_n") != F.col("right_n"))


def with_text_key(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("key").isNotNull())


def not_done(inputs: DataFrame, done: DataFrame, on: str) -> DataFrame:
    """Inputs without a finished outcome. Inputs should be distinct, as
    `ordering.limit_inputs` makes them."""
    return inputs.join(done.select(on).distinct(), on, "left_anti")


def check_quadrimesters(requested: list[str] | None, years: list[int]) -> list[str]:
    """Requested labels, each of which must belong to one of the years.

    Works on the caller's argument lists. Without a request: all of them.
    """
    allowed = [f"{y}-T{n}" for y in years for n in (1, 2, 3)]
    if requested is None:
        return allowed
    wanted = [text.strip() for text in requested if text.strip()]
    outside = [q for q in wanted if q not in allowed]
    if outside:
        raise ValueError(f"quadrimesters {outside} are not among those of the years {years}")
    return wanted


def in_years(df: DataFrame, years: DataFrame) -> DataFrame:
    """Rows whose quadrimester belongs to a years table (column `year`)."""
    labels = years.select(F.explode(expand_years(F.col("year"))).alias("quadrimester")).distinct()
    return df.join(labels, "quadrimester", "left_semi")
