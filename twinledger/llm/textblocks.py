"""Arrow batches of texts as numpy arrays: blocks, words and their hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from twinledger import configure

BLOCK_BYTES = 4 << 20
BATCH_ROWS = 1000
_LEAST_POWERS = 1 << 16

# Any odd multiplier and any table of odd-ish constants will do; they must only
# be the same everywhere.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def prepare(spark: SparkSession) -> SparkSession:
    """Library settings, and Arrow batches small enough for long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def set_aside(docs: DataFrame) -> DataFrame:
    """`docs` with all columns but doc_id and text under names that no operator uses.

    Columns keep their places: `toDF(*docs.columns)` gives their names back.
    """
    return docs.toDF(*(c if c in ("doc_id", "text") else f"aside{i}" for i, c in enumerate(docs.columns)))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most `limit` text bytes, or of one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cut = np.cumsum(sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            yield batch.slice(start, end - start)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each text starts (with the end)."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


@dataclass
class Words:
    """Words of a block: runs of ASCII letters and digits and of non-ASCII bytes.

    `first[i]:first[i + 1]` are the words of text i. Hashes ignore the case of
    ASCII letters.
    """

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


_powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(n - 1, _LEAST_POWERS - 1).bit_length()
        up, down = np.full(size, _STEP), np.full(size, _STEP_INVERSE)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    return _powers


def unspaced(raw: np.ndarray) -> np.ndarray:
    """Where characters of scripts written without blanks start and end in UTF-8.

    These are Thai and Lao, Burmese, Khmer, and all of Chinese and Japanese with its
    punctuation; U+3000 to U+9FFF, U+20000 to U+3FFFF.
    """
    at = np.flatnonzero(raw >= 0xE0)
    lead = raw[at]
    second = raw[np.minimum(at + 1, len(raw) - 1)]
    three = (lead >= 0xE3) & (lead <= 0xE9)
    three |= (lead == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    three |= (lead == 0xE1) & ((second <= 0x82) | (second == 0x9E) | (second == 0x9F))
    four = (lead == 0xF0) & (second >= 0xA0)
    breaks = np.concatenate([at[three], at[three] + 3, at[four], at[four] + 4])
    return breaks[breaks < len(raw)]


def words(raw: np.ndarray, offsets: np.ndarray, breaks: np.ndarray | None = None) -> Words:
    """Word hashes by prefix sums of a polynomial: no loop over words.

    `breaks`: further places where a word ends and the next one starts.
    """
    n = len(raw)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(np.uint64), none, none, np.zeros(len(offsets), dtype=np.int64))
    inside = _IS_WORD[raw]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    if breaks is not None:
        edges = np.concatenate([edges, breaks])
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = _power_tables(n + 1)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[_LOWER[raw]] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def hash_texts(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte range, case and all."""
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def runs_of(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How often each value has been seen before in its row."""
    n = len(values)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(mix(values + rows.astype(np.uint64) * _STEP), kind="stable")
    v, r = values[order], rows[order]
    new = np.ones(n, dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    place = np.arange(n)
    seen = np.empty(n, dtype=np.int64)
    seen[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return seen


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
