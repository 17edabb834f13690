"""Matching large tables against lists of unknown length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.operators import blooms
from twinledger.session import materialize

# Upper bound on the partition values put into a filter as literals.
PRUNE_VALUES = 1_000

# Upper bounds on a list that may be broadcast. Large executors allow more rows:
# pass max_rows.
NARROW_ROWS = 200_000
NARROW_BYTES = 64 * 1024 * 1024


# A filter over a long list is made if the table has this many rows per listed value.
REDUCE_ROWS = 4


def _size(listed: DataFrame) -> tuple[int, int]:
    """Measured, not estimated: rows and bytes of the list's text values."""
    size = sum((F.octet_length(F.coalesce(F.col(c), F.lit(""))) for c in listed.columns), F.lit(0))
    rows, held = listed.agg(F.count("*"), F.sum(size.cast("bigint"))).first()
    return rows, held or 0


def _is_short(listed: DataFrame, max_rows: int) -> bool:
    rows, held = _size(listed)
    return rows <= max_rows and held <= NARROW_BYTES


def keep_possible(
    big: DataFrame, listed: DataFrame, on: list[str], max_rows: int = NARROW_ROWS, rows_of: DataFrame | None = None
) -> DataFrame:
    """Drop nearly all rows of `big` that no row of `listed` can match, before a shuffle.

    A short list is broadcast, which drops all of them. A long one becomes a Bloom
    filter if `big` is REDUCE_ROWS times longer; rows that pass it by chance are left to
    the exact join that follows. Rows of `big` are counted on `rows_of`, a plain table
    with as many rows, where its files know the number; `big` itself otherwise.
    """
    wanted = listed.select(*on)
    rows, held = _size(wanted)
    if rows <= max_rows and held <= NARROW_BYTES:
        return big.join(F.broadcast(wanted), on, "left_semi")
    if (big if rows_of is None else rows_of).count() < REDUCE_ROWS * rows:
        return big
    return blooms.reduce_by_list(big, wanted, on, rows)


def narrow(
    big: DataFrame, listed: DataFrame, on: list[str], max_rows: int = NARROW_ROWS
) -> DataFrame:
    """Drop rows of `big` that no row of `listed` can match, if the list is short.

    The list is measured first. A short one is broadcast, so `big` is filtered in
    its scan stage and never shuffled whole; a long one leaves `big` as it is. For use before an aggregation whose result
    is joined with the list anyway.
    """
    wanted = listed.select(*on)
    if not _is_short(wanted, max_rows):
        return big
    return big.join(F.broadcast(wanted), on, "left_semi")


def keep_listed(
    big: DataFrame, listed: DataFrame, on: list[str], max_rows: int = NARROW_ROWS, reduce: bool = False
) -> DataFrame:
    """Rows of `big` whose value is listed.

    The distinct list is stored first. A short one is broadcast. For a long one
    both sides are shuffled, with `big` on the side Spark can split: reading the
    stored list, instead of aggregating it inside the same plan, leaves a plain
    shuffle under each side of the join, which adaptive skew handling requires.
    So a value held by a large share of `big` is spread over many tasks. `reduce`: `big`
    is a stored table that is cheap to count, so a Bloom filter may go before the shuffle.
    """
    wanted = materialize(listed.select(*on).distinct(), "list")
    if _is_short(wanted, max_rows):
        wanted = F.broadcast(wanted)
    elif reduce:
        big = keep_possible(big, wanted, on, max_rows=-1)
    return big.join(wanted, on, "left_semi")


def prune(
    big: DataFrame, partition: str, values: DataFrame, max_values: int = PRUNE_VALUES
) -> DataFrame:
    """Rows of `big` whose partition value occurs in `values` (one column).

    Up to max_values distinct ones become a literal filter, which skips whole
    partition folders before anything is read. More are matched by a join.
    """
    name = values.columns[0]
    distinct = values.where(F.col(name).isNotNull()).distinct()
    found = [row[0] for row in distinct.limit(max_values + 1).collect()]
    if len(found) <= max_values:
        return big.where(F.col(partition).isin(*found)) if found else big.limit(0)
    return big.join(distinct.withColumnRenamed(name, partition), partition, "left_semi")
