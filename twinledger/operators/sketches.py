"""What two large sets of keys do not share, by invertible sketches.

Every key of a bucket is added to three cells of the bucket's sketch, chosen by its hash:
the cell sums up signs (one side counts +1, the other -1), the key's 128 hash bits in
four parts, and a product of two of them as a check. Keys that both sides hold equally
often cancel, whatever their number, so a sketch holds the differences alone and its
size follows from theirs. A cell with one key left tells its hash; taking that key out
of its other two cells frees more, until the sketch is empty. Sums of cells are native
aggregates, combined before the shuffle: cells are shuffled, not keys.

A sketch too small for its differences does not empty; its bucket is sketched anew with
more cells, and past a bound left to an exact comparison.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.session import materialize

#: Cells per bucket at first, how much larger the next try is, and the most (56 bytes each, in one task).
FIRST_CELLS = 768
GROWTH = 16
MOST_CELLS = 1 << 20

_SEED = 0x7A17
_LOW = 0xFFFFFFFF
_CHECK = (1 << 31) - 1
_PARTS = ("a_high", "a_low", "b_high", "b_low")
_FOUND = "bucket timestamp, a bigint, b bigint, stuck boolean"


def hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit(_SEED))


def _halves(h: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(_LOW))


def cells(rows: DataFrame, size: int) -> DataFrame:
    """bucket, cell, n, the sums of hash parts and checks. `rows`: bucket, key, sign."""
    third = max(1, size // 3)
    a, b = hashes(F.col("key"))
    hashed = rows.select("bucket", "sign", a.alias("a"), b.alias("b"))
    parts = dict(zip(_PARTS, (*_halves(F.col("a")), *_halves(F.col("b")))))
    split = hashed.select("bucket", "sign", *(c.alias(name) for name, c in parts.items()))
    check = F.pmod(F.col("a_low"), F.lit(_CHECK)) * F.pmod(F.col("b_low"), F.lit(_CHECK)) % _CHECK
    places = F.array(*(F.pmod(F.col(name), F.lit(third)) + i * third for i, name in enumerate(_PARTS[:3])))
    placed = split.select("bucket", "sign", *_PARTS, check.alias("check"), F.explode(places).alias("cell"))
    return placed.groupBy("bucket", "cell").agg(
        F.sum("sign").alias("n"), *(F.sum(F.col("sign") * F.col(name)).alias(name) for name in (*_PARTS, "check"))
    )


def peel(cell: np.ndarray, sums: np.ndarray, third: int) -> tuple[np.ndarray, bool]:
    """Hash parts of the keys in a sketch, and whether nothing is left.

    `sums`: rows n, four hash parts and check, a column per cell named by `cell`.
    """
    table = np.zeros((6, 3 * third), dtype=np.int64)
    table[:, cell] = sums
    found = [np.zeros((4, 0), dtype=np.int64)]
    look = np.flatnonzero(table[0])
    while len(look):
        n = table[0, look]
        parts, rest = np.divmod(table[1:5, look], n)
        pure = (rest == 0).all(axis=0) & (parts >= 0).all(axis=0) & (parts <= _LOW).all(axis=0)
        parts = np.where(pure, parts, 0)
        check = (parts[1] % _CHECK) * (parts[3] % _CHECK) % _CHECK
        places = np.stack([parts[i] % third + i * third for i in range(3)])
        pure &= (check * n == table[5, look]) & (places == look).any(axis=0)
        look, n, parts, check, places = look[pure], n[pure], parts[:, pure], check[pure], places[:, pure]
        if not len(look):
            break
        # A key can be alone in several of its cells.
        _, once = np.unique(parts, axis=1, return_index=True)
        n, parts, check, places = n[once], parts[:, once], check[once], places[:, once]
        found.append(parts)
        for row in places:
            np.subtract.at(table, (slice(None), row), np.concatenate([n[None], n * parts, (n * check)[None]]))
        look = np.unique(places)
        look = look[table[0, look] != 0]
    return np.concatenate(found, axis=1), not table.any()


def _peel_buckets(third: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        names = ("n", *_PARTS, "check")
        sums = np.stack([table.column(name).to_numpy() for name in names])
        parts, whole = peel(table.column("cell").to_numpy(), sums, third)
        if not whole:
            parts = parts[:, :0]
        signed = [((parts[i].astype(np.uint64) << np.uint64(32)) | parts[i + 1].astype(np.uint64)).view(np.int64) for i in (0, 2)]
        n = parts.shape[1] + (not whole)
        bucket = table.column("bucket").combine_chunks()[:1].take(pa.array(np.zeros(n, dtype=np.int64)))
        columns = [bucket, *(pa.array(x if whole else np.zeros(1, dtype=np.int64)) for x in signed), pa.array([not whole] * n, pa.bool_())]
        return pa.Table.from_arrays(columns, ["bucket", "a", "b", "stuck"])

    return run


def differences(
    rows: DataFrame, first_cells: int = FIRST_CELLS, most_cells: int = MOST_CELLS
) -> tuple[DataFrame, DataFrame]:
    """Hashes (bucket, a, b) of keys whose signs do not add up to zero, and buckets that stay open.

    `rows` (bucket, key, sign; no nulls) is read once per size tried, so pass a stored
    table; from the second size on only the open buckets' rows are sketched.
    """
    found, size = [], first_cells
    part = rows
    while True:
        third = max(1, size // 3)
        peeled = cells(part, size).groupBy("bucket").applyInArrow(_peel_buckets(third), _FOUND)
        peeled = materialize(peeled, "peeled")
        found.append(peeled.where("not stuck").select("bucket", "a", "b"))
        stuck = peeled.where("stuck").select("bucket")
        size *= GROWTH
        if size > most_cells or stuck.isEmpty():
            break
        part = rows.join(stuck, "bucket", "left_semi")
    keys = found[0]
    for more in found[1:]:
        keys = keys.unionByName(more)
    return keys, stuck
