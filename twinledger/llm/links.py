"""From shared buckets to connected groups, without all pairs of any bucket.

A bucket holds items that a sketch calls similar. Every item is first compared
with its bucket's centre, and linked items form components; a bucket of many
copies costs one comparison per member. What that leaves apart is compared
further, and still not pair by pair. Let d(x, y) be the number of labels that
only one of x and y has; x and y can only be similar if d(x, y) <= t * (|x| + |y|).
For r and c around a centre b,

    d(r, c) = d(r, b) + d(c, b) - 2 * (common labels new to b + common losses),

and the losses c shares are at most all of its own, so r and c need at least

    q = (d(r, b) + |c| - |b| - t * (|r| + |c|)) / 2

common labels that b lacks. An item that its centre rejects is itself far from
it, which makes q positive for partners of about b's size or more: these are
found by a join on the labels new to b (on as many of them as leave fewer than q
out, the rarest first: what many items have besides their centre, such as a common
passage, is what is left out). Partners small enough for q <= 0 are compared
directly. So no link between items of a bucket is lost, and copies with changes
of their own, which share none of them, are never paired up. Before the labels of such
pairs are fetched, a parity bit per label rules out most that are not similar.

Nothing is collected; every step is a join or an aggregation that may be split.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.operators.lists import narrow
from twinledger.session import materialize

Features = Callable[[DataFrame], DataFrame]
_PAIR = "a long, b long"
# Labels are counted by so many values of their hash, in so many pieces, by so many tasks at most.
_COUNTERS, _PIECES, _COUNTING = 1 << 19, 16, 64
_AWAY = "b long, id long, linked boolean, size long, reach long, floor long, fresh array<long>"
_SIGNED = "id long, labels binary, n int, parity binary"
_LEAST_BITS = 64


@dataclass(frozen=True)
class Similarity:
    """When two sequences of labels are similar.

    `similar` decides. `labels` makes the labels of a sequence unique; similar
    ones differ in at most `slack` * (n + m) of them, and their sizes by no more
    than `size_ratio`.
    """

    similar: Callable[[np.ndarray, np.ndarray], bool]
    labels: Callable[[np.ndarray], np.ndarray]
    slack: float
    size_ratio: float
    width: type = np.uint64

    def _sequences(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        left, right = batch.column("left"), batch.column("right")
        for i in range(batch.num_rows):
            yield np.frombuffer(left[i].as_buffer(), self.width), np.frombuffer(right[i].as_buffer(), self.width)

    def verify(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [self.similar(a, b) for a, b in self._sequences(batch)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    def sign(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Number of labels, and about as many parity bits, each flipped by every label that falls on it."""
        for batch in batches:
            found = [self.labels(np.frombuffer(x.as_buffer(), self.width)) for x in batch.column("labels")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("id", "labels")),
                    pa.array([len(x) for x in found], pa.int32()),
                    pa.array(list(map(parity, found)), pa.binary()),
                ],
                ["id", "labels", "n", "parity"],
            )

    def possible(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs that sizes and parity bits do not rule out: similar ones differ in no more bits than labels."""
        for batch in batches:
            n, m = (batch.column(name).to_numpy().astype(np.int64) for name in ("na", "nb"))
            most = self.slack * (n + m) + 1e-9
            left, right = batch.column("pa").to_pylist(), batch.column("pb").to_pylist()
            kept = [k <= d and differing(x, y) <= d for x, y, k, d in zip(left, right, abs(n - m).tolist(), most.tolist())]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    def read(self, items: DataFrame, name: str) -> DataFrame:
        """id, labels, n, parity of `items` (id, labels), stored."""
        return materialize(items.select("id", "labels").mapInArrow(self.sign, _SIGNED), name)

    def maybe(self, pairs: DataFrame, known: DataFrame, name: str) -> DataFrame:
        """Pairs (a, b) that may be similar, stored. Parity bits travel, at an eighth of a byte per label, no labels."""
        of_a, of_b = (
            known.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("parity").alias(f"p{x}")) for x in "ab"
        )
        told = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "na", "nb", "pa", "pb")
        return materialize(told.mapInArrow(self.possible, _PAIR), name)

    def links(self, pairs: DataFrame, known: DataFrame, name: str) -> DataFrame:
        """The similar ones of `pairs` (a, b). Only labels of pairs that may be similar travel."""
        pairs = self.maybe(pairs, known, name)
        wanted = materialize(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), f"{name}-ids")
        some = narrow(known.select("id", "labels"), wanted, ["id"])
        left = some.select(F.col("id").alias("a"), F.col("labels").alias("left"))
        right = some.select(F.col("id").alias("b"), F.col("labels").alias("right"))
        both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
        return both.mapInArrow(self.verify, _PAIR)

    def count(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many labels of all items fall on each counter, in pieces."""
        total = np.zeros(_COUNTERS, dtype=np.int64)
        for batch in batches:
            held = [self.labels(np.frombuffer(x.as_buffer(), self.width)) for x in batch.column("labels")]
            if held:
                total += np.bincount(counters(np.concatenate(held)), minlength=_COUNTERS)
        if total.any():
            rows = [x.tobytes() for x in np.split(total, _PIECES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(_PIECES), pa.int32()), pa.array(rows, pa.binary())], ["piece", "n"])

    def differences(self, batches: Iterator[pa.RecordBatch], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whether an item is linked to its centre, and what it has that the centre lacks, as far as a partner must share it.

        Any order of labels will do if all items have the same one; `counts` makes it
        the one in which the fewest items meet.
        """
        for batch in batches:
            linked, sizes, reach, floors, fresh = [], [], [], [], []
            for centre, item in self._sequences(batch):
                linked.append(self.similar(centre, item))
                b, r = self.labels(centre), self.labels(item)
                new = np.setdiff1d(r, b, assume_unique=True)
                away = 2 * len(new) + len(b) - len(r)
                least = math.floor(self.size_ratio * len(r))
                # The smallest partner needs the fewest common labels.
                needed = math.ceil((away + least - len(b) - self.slack * (len(r) + least)) / 2 - 1e-9)
                new = new[np.lexsort((new, counts[counters(new)]))]
                fresh.append(new[: len(new) - max(0, needed - 1)].view(np.int64))
                sizes.append(len(r))
                floors.append(least)
                reach.append(math.floor((len(b) - away + self.slack * len(r)) / (1 - self.slack) + 1e-9))
            ends = np.cumsum([0, *map(len, fresh)])
            flat = np.concatenate(fresh) if fresh else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("b", "id")),
                    pa.array(linked, pa.bool_()),
                    pa.array(sizes, pa.int64()),
                    pa.array(reach, pa.int64()),
                    pa.array(floors, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                ["b", "id", "linked", "size", "reach", "floor", "fresh"],
            )


def counters(labels: np.ndarray) -> np.ndarray:
    return (labels % labels.dtype.type(_COUNTERS)).astype(np.int64)


def parity(labels: np.ndarray) -> bytes:
    """As many bits as there are labels, or up to twice as many: a power of two."""
    bits = max(_LEAST_BITS, 1 << (max(1, len(labels)) - 1).bit_length())
    hits = np.bincount((labels & labels.dtype.type(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((hits & 1).astype(np.uint8)).tobytes()


def differing(one: bytes, other: bytes) -> int:
    """Parity bits that differ; the longer of two is folded to the other's length."""
    short, long = sorted((np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)), key=len)
    while len(long) > len(short):
        half = len(long) // 2
        long = long[:half] ^ long[half:]
    return int(np.bitwise_count(short ^ long).sum())


def label_counts(known: DataFrame, spec: Similarity) -> np.ndarray:
    """How often labels of each hash value occur in all of `known`: 4 MB on the driver."""

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(_COUNTERS // _PIECES, dtype=np.int64)
        for row in table.column("n").to_pylist():
            total += np.frombuffer(row, dtype=np.int64)
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "n": [total.tobytes()]})

    schema = "piece int, n binary"
    tasks = min(_COUNTING, 2 * known.sparkSession.sparkContext.defaultParallelism)
    counted = known.select("labels").coalesce(tasks).mapInArrow(spec.count, schema)
    total = np.zeros((_PIECES, _COUNTERS // _PIECES), dtype=np.int64)
    for row in counted.groupBy("piece").applyInArrow(add, schema).collect():
        total[row.piece] = np.frombuffer(row.n, dtype=np.int64)
    return total.ravel()


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id with a link (a, b): root is the lowest id of its component.

    Alternates the large-star and small-star steps of Kiveris et al. (2014)
    until the edges are stars. Each step's result is stored, which also lets
    adaptive execution split the edges of a hot node.
    """
    edges = materialize(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(),
        "edges",
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("root"))
            ).distinct()
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "lowest")
        large = materialize(
            both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large-star",
        )
        lowest = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = (
            large.join(lowest, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .union(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = materialize(small, "small-star")


def _similar_sizes(one: str, other: str, ratio: float):
    low, high = F.least(one, other), F.greatest(one, other)
    return low >= high * F.lit(ratio)


def linked_groups(members: DataFrame, features: Features, spec: Similarity) -> DataFrame:
    """(id, root) of all items linked to another one; root is the lowest id of the group.

    `members`: key, id, size (all long), one row per bucket and item; it is read
    more than once, so it should come from a stored table. `features` maps ids
    (column `id`) to (id, labels): the item's sequence as numbers of `spec.width`.
    """
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(members.join(materialize(sizes, "shared-buckets"), "key"), "bucket-members")
    # The centre of a bucket is the item with the most company in all its buckets:
    # among copies of one text that is the text they were made from, or close to it.
    company = materialize(shared.groupBy("id").agg(F.sum("n").alias("score")), "company")
    scored = shared.join(company, "id")
    centres = scored.groupBy("key").agg(F.max(F.struct("score", F.negative("id").alias("low"))).alias("top"))
    centres = materialize(centres.select("key", (-F.col("top.low")).alias("b")), "centres")
    around = materialize(shared.join(centres, "key").select("b", "id").distinct(), "around")

    known = spec.read(features(around.select("id").distinct()), "features")
    of_b = known.select(F.col("id").alias("b"), F.col("labels").alias("left"))
    of_id = known.select("id", F.col("labels").alias("right"))
    counts = known.sparkSession.sparkContext.broadcast(label_counts(known, spec))
    # Each pair's labels travel once, for the link as well as for what the centre lacks.
    pairs = around.where("b != id").join(of_id, "id").join(of_b, "b").select("b", "id", "left", "right")
    compared = materialize(pairs.mapInArrow(lambda batches: spec.differences(batches, counts.value), _AWAY), "compared")
    first = compared.where("linked").select(F.col("b").alias("a"), F.col("id").alias("b"))
    roots = materialize(components(first), "roots")

    # Groups around a centre that it does not hold together.
    rooted = around.join(roots, "id", "left").select("b", "id", F.coalesce("root", "id").alias("root"))
    rooted = materialize(rooted, "rooted")
    loose = rooted.groupBy("b").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.max(F.when(F.col("b") == F.col("id"), F.col("root"))).alias("main")
    )
    loose = materialize(loose.where("least != most").select("b", "main"), "loose-groups")
    # The centre itself has nothing that it lacks.
    apart = materialize(rooted.where("b != id").join(loose, "b"), "loose-members")
    away = materialize(compared.join(apart, ["b", "id"]).drop("linked"), "differences")

    tokens = away.select("b", "id", "root", "main", "size", F.explode("fresh").alias("token"))
    mine = tokens.where("root != main").select("b", "token", F.col("id").alias("a"), F.col("root").alias("ra"), F.col("size").alias("na"))
    alike = _similar_sizes("na", "size", spec.size_ratio)
    # Of two items that are both away from the centre, the lower one asks.
    ordered = (F.col("root") == F.col("main")) | (F.col("a") < F.col("id"))
    common = mine.join(tokens, ["b", "token"]).where((F.col("ra") != F.col("root")) & ordered & alike)
    asking = away.where("root != main and reach >= floor").select(
        "b", F.col("id").alias("a"), F.col("root").alias("ra"), F.col("size").alias("na"), "reach"
    )
    near = asking.join(away.select("b", "id", "root", "main", "size"), "b").where(
        (F.col("size") <= F.col("reach")) & (F.col("ra") != F.col("root")) & (F.col("id") != F.col("b")) & alike
    )
    candidates = common.select("a", "id").union(near.select("a", "id"))
    candidates = materialize(candidates.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct(), "more-pairs")
    second = spec.links(candidates, known, "more-possible")
    second = materialize(second, "more-links")
    # The second round joins whole components: its graph has a node per root.
    of_a = roots.select(F.col("id").alias("a"), F.col("root").alias("ra"))
    of_other = roots.select(F.col("id").alias("b"), F.col("root").alias("rb"))
    between = second.join(of_a, "a", "left").join(of_other, "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")
    )
    higher = materialize(components(between), "higher-roots").select(
        F.col("id").alias("root"), F.col("root").alias("top")
    )
    lone = higher.select(F.col("root").alias("id"), "root").join(roots.select("id"), "id", "left_anti")
    return roots.unionByName(lone).join(higher, "root", "left").select("id", F.coalesce("top", "root").alias("root"))
