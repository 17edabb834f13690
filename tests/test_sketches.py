"""Differences of two sets by sketches, against sets and against the exact plan."""

import random

import archive
import numpy as np
import pytest
from pyspark.sql import functions as F

from twinledger import plans
from twinledger.operators import sketches


def signed_rows(spark, left, right):
    rows = [(f"2020-0{m}-01 00:00:00", k, s) for side, s in ((left, 1), (right, -1)) for m, k in side]
    df = spark.createDataFrame(rows, "bucket string, key string, sign long")
    return df.withColumn("bucket", F.col("bucket").cast("timestamp"))


def named(spark, rows, found):
    a, b = sketches.hashes(F.col("key"))
    hit = rows.withColumns({"a": a, "b": b}).join(found, ["bucket", "a", "b"], "left_semi")
    return {(r.bucket.month, r.key) for r in hit.select("bucket", "key").distinct().collect()}


@pytest.mark.parametrize("cells", [9, 60, 768])
def test_differences_of_sets(spark, cells):
    r = random.Random(cells)
    both = [(m, f"k{i}") for m in (1, 2, 3) for i in range(400)]
    left = both + [(1, f"l{i}") for i in range(5)] + [(3, f"l{i}") for i in range(300)] + both[:3]
    right = both + [(1, f"r{i}") for i in range(4)] + [(3, f"r{i}") for i in range(300)] + [(4, "only")]
    r.shuffle(left)
    rows = signed_rows(spark, left, right).cache()
    found, stuck = sketches.differences(rows, cells, most_cells=cells)
    wanted = set(left) ^ set(right) | set(both[:3])
    open_months = {row.bucket.month for row in stuck.collect()}
    assert named(spark, rows, found) == {(m, k) for m, k in wanted if m not in open_months}
    assert not open_months & {2, 4} and (3 in open_months or cells == 768)
    again, none = sketches.differences(rows, cells)
    assert none.isEmpty() and named(spark, rows, again) == wanted


def test_peeling_by_hand():
    third, r = 50, np.random.default_rng(5)
    keys = r.integers(0, 1 << 32, (4, 40), dtype=np.int64)
    n = r.choice([-3, -1, 1, 2], 40)
    table = np.zeros((6, 3 * third), dtype=np.int64)
    check = (keys[1] % sketches._CHECK) * (keys[3] % sketches._CHECK) % sketches._CHECK
    for i in range(3):
        np.add.at(table, (slice(None), keys[i] % third + i * third), np.concatenate([n[None], n * keys, (n * check)[None]]))
    found, whole = sketches.peel(np.arange(3 * third), table, third)
    assert whole and sorted(map(tuple, found.T)) == sorted(map(tuple, keys.T))
    assert sketches.peel(np.zeros(0, dtype=np.int64), np.zeros((6, 0), dtype=np.int64), 1)[1]


def copies(spark, n, seed):
    r = random.Random(seed)
    docs, stage = [], []
    for i in range(n):
        at = f"2020-{r.randrange(1, 13):02d}-{r.randrange(1, 28):02d} 0{r.randrange(10)}:00:00"
        key = f"{at[:10].replace('-', '/')}/k{i}"
        for side, make, p in ((docs, archive.doc_row, 0.04), (stage, archive.stage_row, 0.03)):
            if r.random() >= p:
                side += [make(key, at, entity=archive.ENTITY) for _ in range(r.choice([1, 1, 1, 2, 3]))]
    docs.append(archive.doc_row(None, "2020-05-05 00:00:00", doc_id="nokey"))
    return archive.docs(spark, docs).cache(), archive.stage(spark, stage).cache()


@pytest.mark.parametrize(("first", "most", "bound"), [(3, 3, 1000), (30, 30, 0), (30, 1 << 20, 1000), (768, 1 << 20, 0)])
def test_equals_the_exact_plan(spark, first, most, bound):
    """With sketches that stay open, are sketched again, or empty at once; lists broadcast or not."""
    docs, stage = copies(spark, 700, first)
    for level in ("month", "day"):
        exact = plans.reconcile_exact(docs, stage, archive.ENTITY, [2020], level)
        mine = plans.reconcile_sketched(
            docs, stage, archive.ENTITY, [2020], level, max_rows=bound, first_cells=first, most_cells=most
        )
        assert sorted(mine.collect()) == sorted(exact.collect()) and exact.count() > 20


def test_equal_copies_and_no_rows(spark):
    docs, stage = copies(spark, 1, 1)
    none = plans.reconcile_sketched(docs.limit(0), stage.limit(0), archive.ENTITY, [2020])
    assert none.count() == 0
    rows = signed_rows(spark, [(1, "k")] * 2, [(1, "k")] * 2)
    found, stuck = sketches.differences(rows)
    assert found.isEmpty() and stuck.isEmpty()


def test_cells_are_shuffled_not_keys(spark):
    """Two copies of 200,000 keys that differ in 0.1 percent."""
    n = 200_000
    rows = spark.range(n, numPartitions=4).selectExpr("id", "1L AS sign").unionByName(
        spark.range(n, numPartitions=4).where("id % 1000 != 7").selectExpr("id", "-1L AS sign")
    )
    rows = rows.select(F.lit("2020-01-01").cast("timestamp").alias("bucket"), F.concat(F.lit("k"), "id").alias("key"), "sign")
    made = sketches.cells(rows, sketches.FIRST_CELLS)
    from test_blooms import shuffled_rows

    assert max(shuffled_rows(made)) <= 8 * sketches.FIRST_CELLS < n / 20
    found, stuck = sketches.differences(rows)
    assert stuck.isEmpty() and found.count() == n // 1000
