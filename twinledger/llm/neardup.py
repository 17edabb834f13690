"""Near-duplicate documents by Order MinHash over five-word shingles.

A shingle is labelled with its occurrence number, so repeats count. Each of 32
permutations picks a text's five lowest labelled shingles, kept in text order:
two texts agree on a sketch if they share those shingles and their order, which
follows edit similarity rather than bags of words. Candidates are verified by a
banded alignment of the labelled shingles: aligned / (all - aligned) >= 0.8.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm.links import Similarity, linked_groups
from twinledger.llm.textblocks import _STEP, blocks, mix, prepare, runs_of, set_aside, signed, text_bytes, words, Words
from twinledger.operators.lists import narrow
from twinledger.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
PERMUTATIONS = 32
LOWEST = 5
# Short texts have too few shingles for five to agree often: they get further
# sketches of two shingles. Both texts of a pair get them, as 15 * 0.8 = 12.
SHORT = 15
SHORT_PERMUTATIONS = 12
SHORT_LOWEST = 2
_CELLS = 1 << 21

_MULTIPLY = mix(np.arange(1, PERMUTATIONS + SHORT_PERMUTATIONS + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = mix(np.arange(1001, 1001 + PERMUTATIONS + SHORT_PERMUTATIONS, dtype=np.uint64))
_PLACE = mix(np.arange(2001, 2001 + max(SHINGLE, LOWEST), dtype=np.uint64)) | np.uint64(1)


def labelled_shingles(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Labelled shingle hashes of all texts, and where each text's begin (with the end).

    A text of one to four words is one shingle; a text without words has none.
    """
    n_words = np.diff(found.first)
    n = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, np.minimum(n_words, 1))
    first = np.concatenate([[0], np.cumsum(n)])
    rows = np.repeat(np.arange(len(n)), n)
    at = np.arange(first[-1]) - first[rows] + found.first[rows]
    size = np.minimum(n_words[rows], SHINGLE)
    sums = np.zeros(len(at), dtype=np.uint64)
    for j in range(SHINGLE):
        inside = size > j
        sums[inside] += found.hashes[at[inside] + j] * _PLACE[j]
    shingles = mix(sums)
    seen = runs_of(shingles, rows).astype(np.uint64)
    return mix(shingles + seen * _STEP), first


def sketches(labels: np.ndarray) -> np.ndarray:
    """Order MinHash sketches of one text, told apart by permutation."""
    plans = [(0, PERMUTATIONS, LOWEST)]
    if len(labels) <= SHORT:
        plans.append((PERMUTATIONS, PERMUTATIONS + SHORT_PERMUTATIONS, SHORT_LOWEST))
    out = []
    for start, end, lowest in plans:
        step = max(1, _CELLS // len(labels))
        for i in range(start, end, step):
            j = min(end, i + step)
            if len(labels) > lowest:
                ranks = labels * _MULTIPLY[i:j, None] + _ADD[i:j, None]
                places = np.sort(np.argpartition(ranks, lowest - 1, axis=1)[:, :lowest], axis=1)
                chosen = labels[places]
            else:
                chosen = np.broadcast_to(labels, (j - i, len(labels)))
            out.append(mix((chosen * _PLACE[: chosen.shape[1]]).sum(axis=1, dtype=np.uint64) + _ADD[i:j]))
    return np.concatenate(out)


def alignment_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """aligned / (len(a) + len(b) - aligned) for labelled shingles, 0 if below `least`.

    Texts that reach `least` differ in few enough shingles that aligned places
    lie within a band around the diagonal; matches beyond it are not looked at.
    Labels are unique within a text, so the alignment is the longest increasing
    run of matched places.
    """
    total = len(a) + len(b)
    band = int(total * (1 - least) / (1 + least)) + 1
    _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    places = in_b[np.argsort(in_a)][np.abs(np.sort(in_a) - in_b[np.argsort(in_a)]) <= band]
    aligned = len(places)
    if total == 0 or aligned < least * (total - aligned):
        return 0.0
    if aligned > 1 and (np.diff(places) < 0).any():
        tails: list[int] = []
        for p in places.tolist():
            i = bisect_left(tails, p)
            tails[i : i + 1] = [p]
        aligned = len(tails)
    value = aligned / (total - aligned)
    return value if value >= least else 0.0


LINK = Similarity(
    similar=lambda a, b: alignment_similarity(a, b) > 0,
    labels=np.array,
    slack=(1 - SIMILARITY) / (1 + SIMILARITY),
    size_ratio=SIMILARITY,
)


def _sketch_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in blocks(batches, "text"):
        labels, first = labelled_shingles(words(*text_bytes(part.column("text"))))
        lists = [sketches(labels[s:e]) if e > s else labels[:0] for s, e in zip(first[:-1], first[1:])]
        ends = np.cumsum([0, *map(len, lists)])
        flat = signed(np.concatenate(lists))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("node"),
                pa.array(np.diff(first)),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
            ],
            ["doc_id", "node", "size", "keys"],
        )


def _shingle_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in blocks(batches, "text"):
        labels, first = labelled_shingles(words(*text_bytes(part.column("text"))))
        rows = [labels[s:e].tobytes() for s, e in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(rows, pa.binary())], ["id", "labels"])


def _with_node(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("node")).where("text is not null")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, node, class_id, kept: one row per row of `docs`.

    Equal texts are one node; nodes linked by alignment form a class, whose id is
    its lowest doc_id. `kept` marks the lowest (doc_id, node) of a class. Texts of
    fewer than five words match by equal words; texts without a word only if they
    are equal byte for byte. A null text is a class of its own: class_id is its
    doc_id, and it is kept.
    """
    spark = prepare(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("node", T.StringType()),
            T.StructField("size", T.LongType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
        ]
    )
    known = _with_node(docs)
    sketched = materialize(known.mapInArrow(_sketch_texts, schema), "sketches")
    by_node = sketched.groupBy("node").agg(
        F.min("doc_id").alias("low_doc"), F.first("size").alias("size"), F.first("keys").alias("keys")
    )
    nodes = materialize(by_node.select(F.monotonically_increasing_id().alias("id"), "*"), "nodes")

    def features(wanted: DataFrame) -> DataFrame:
        listed = materialize(nodes.select("id", "node", F.col("low_doc").alias("one")).join(wanted, "id", "left_semi"), "listed")
        texts = narrow(known, listed.select("node"), ["node"])
        texts = texts.join(listed, "node").where(F.col("doc_id").eqNullSafe(F.col("one"))).select("id", "text")
        return texts.mapInArrow(_shingle_texts, "id long, labels binary").dropDuplicates(["id"])

    members = nodes.select(F.explode("keys").alias("key"), "id", "size")
    groups = materialize(linked_groups(members, features, LINK), "groups")
    grouped = materialize(nodes.select("id", "node", "low_doc").join(groups, "id"), "grouped-nodes")
    lowest = grouped.groupBy("root").agg(F.min(F.struct("low_doc", "node")).alias("low"))
    classes = nodes.select("id", "node", "low_doc").join(groups, "id", "left").join(lowest, "root", "left")
    classes = materialize(
        classes.select("node", F.coalesce("low", F.struct("low_doc", "node")).alias("low")), "node-classes"
    )
    found = sketched.select("doc_id", "node").join(classes, "node").select(
        "doc_id",
        "node",
        F.col("low.low_doc").alias("class_id"),
        (F.col("doc_id").eqNullSafe(F.col("low.low_doc")) & (F.col("node") == F.col("low.node"))).alias("kept"),
    )
    unread = docs.where("text is null").select(
        "doc_id", F.lit(None).cast("string").alias("node"), F.col("doc_id").alias("class_id"), F.lit(True).alias("kept")
    )
    return found.unionByName(unread)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class: all columns of `docs`, rows repeated in doc_id and text once."""
    kept = near_duplicates(docs).where("kept and node is not null")
    kept = materialize(kept.select(F.col("doc_id").alias("__id"), F.col("node").alias("__node")).distinct(), "kept")
    plain = set_aside(docs)
    marked = plain.withColumn("__digest", F.md5(F.col("text").cast("binary")))
    match = (F.col("__digest") == F.col("__node")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    known = marked.join(kept, match).dropDuplicates(["__node", "__id"]).select(*plain.columns)
    known = known.toDF(*docs.columns)
    return known.unionByName(docs.where("text is null"))
