"""Pairs that cannot be similar go no further than their parity bits, those that can always do."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa

from twinledger.llm import linededup, links, neardup


def draw(rng, n):
    return rng.integers(1, 1 << 62, n).astype(np.uint64)


def test_parity_bits_differ_in_no_more_places_than_labels():
    rng = np.random.default_rng(1)
    for n in (1, 5, 60, 64, 65, 200, 700):
        for _ in range(30):
            a = draw(rng, n)
            b = np.concatenate([a[rng.random(n) < rng.random()], draw(rng, int(rng.integers(0, 2 * n)))])
            apart = len(np.setxor1d(a, b))
            assert links.differing(links.parity(a), links.parity(b)) <= apart
            assert links.differing(links.parity(b), links.parity(a)) <= apart


def test_unlike_pairs_fetch_no_labels(spark):
    """A shared passage made pairs of all items; all of them had their labels fetched before."""
    rng = np.random.default_rng(2)
    passage = draw(rng, 60)
    items = [np.concatenate([passage, draw(rng, 300)]) for _ in range(30)]
    items += [np.concatenate([x[5:], draw(rng, 5)]) for x in items[:10]]
    rows = [(i, bytearray(x.tobytes())) for i, x in enumerate(items)]
    known = neardup.LINK.read(spark.createDataFrame(rows, "id long, labels binary"), "some")
    pairs = spark.createDataFrame(list(combinations(range(len(items)), 2)), "a long, b long")
    similar = {(i, i + 30) for i in range(10)}
    assert {tuple(x) for x in neardup.LINK.maybe(pairs, known, "told").collect()} == similar
    assert {tuple(x) for x in neardup.LINK.links(pairs, known, "told").collect()} == similar


def test_long_unlike_lines_of_a_block_go_no_further():
    """128 bits of two unlike lines of 400 words differ in some 64 places, and 80 are allowed."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 400)) for _ in range(40)]
    texts += [" ".join(["other", *t.split(" ")[1:]]) for t in texts[:5]]
    batch = pa.record_batch({"text": pa.array(texts)})
    level = np.ones(linededup._COUNTERS, dtype=np.uint8)
    (found,) = linededup._read_blocks(iter([batch]), level, 1)
    bits = [x for x in found.schema.names if x.startswith("p")]
    of = {k: [found.column(x)[i].as_py() for x in bits] for i, k in enumerate(found.column("k0").to_pylist())}
    parity = np.array(list(of.values()), dtype=np.int64).view(np.uint64)
    kept = linededup._possible(np.zeros(len(of)), parity, np.full(len(of), 400))
    assert kept.sum() == 10


def test_blocks_of_the_same_lines_are_looked_at_once(spark):
    """Copies of a long line share dozens of blocks, and all of these were joined."""
    rows = [(key, i, 20) for key in range(5) for i in (1, 2, 3)] + [(5, 1, 20), (5, 2, 20), (6, 4, 20)]
    found = linededup.distinct_blocks(spark.createDataFrame(rows, "key long, id long, size long"))
    assert sorted((x.key, x.id, x.n) for x in found.collect()) == [(0, 1, 3), (0, 2, 3), (0, 3, 3), (5, 1, 2), (5, 2, 2)]
