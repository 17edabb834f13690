"""A Bloom filter over a long list, tested where the big table is scanned.

A list too long to broadcast still fits into a few bytes per value. Each value sets four
bits of one 64-bit word, chosen by its hash; the words are gathered by a map-side
combined aggregate and stored as one row. Rows of the big table whose bits are not all
set cannot match, and never reach the shuffle of the exact join that follows. Whatever
the size, no listed value is lost; too small a filter only lets more rows pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.session import materialize

#: Bits of the filter per listed value; about one row in 250 passes by chance.
BITS_PER_VALUE = 16
#: 32 MB of words at most: every task that scans gets a copy. Longer lists have fewer bits per value.
MOST_WORDS = 1 << 22
_BITS_SET = 4
_SEED = 0x5EED


def _word(values: list[Column], words: int) -> Column:
    return F.pmod(F.xxhash64(*values), F.lit(words)).cast("int")


def _bits(values: list[Column]) -> Column:
    """A word with up to four bits set, from another hash than the word's place."""
    h = F.xxhash64(*values, F.lit(_SEED))
    one = F.lit(1).cast("bigint")
    bits = one
    for k in range(_BITS_SET):
        bit = F.call_function("shiftleft", one, F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
        bits = bit if k == 0 else bits.bitwiseOR(bit)
    return bits


def words_for(values: int, bits_per_value: int = BITS_PER_VALUE) -> int:
    return max(1, min(MOST_WORDS, -(-values * bits_per_value // 64)))


def bloom(listed: DataFrame, on: list[str], words: int) -> DataFrame:
    """One stored row: `words`, the filter over the listed values. Nulls match nothing."""
    spark = listed.sparkSession
    values = [F.col(c) for c in on]
    known = listed.where(" AND ".join(f"`{c}` IS NOT NULL" for c in on))
    places = known.select(_word(values, words).alias("place"), _bits(values).alias("bits"))
    empty = spark.range(words).select(F.col("id").cast("int").alias("place"), F.lit(0).cast("bigint").alias("bits"))
    dense = places.unionByName(empty).groupBy("place").agg(F.bit_or("bits").alias("bits"))
    one = dense.agg(F.sort_array(F.collect_list(F.struct("place", "bits"))).alias("w")).select(F.col("w.bits").alias("words"))
    return materialize(one, "bloom")


def might_match(big: DataFrame, filtered: DataFrame, on: list[str], words: int) -> DataFrame:
    """Rows of `big` that the filter does not rule out; those with a null go."""
    values = [F.col(c) for c in on]
    known = filtered.select("words").scalar()
    bits = _bits(values)
    return big.where(F.get(known, _word(values, words)).bitwiseAND(bits) == bits).where(
        " AND ".join(f"`{c}` IS NOT NULL" for c in on)
    )


def reduce_by_list(
    big: DataFrame, listed: DataFrame, on: list[str], rows: int, bits_per_value: int = BITS_PER_VALUE
) -> DataFrame:
    """`big` without nearly all rows that no row of `listed` (`rows` of them) matches."""
    words = words_for(rows, bits_per_value)
    return might_match(big, bloom(listed, on, words), on, words)
