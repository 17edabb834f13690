"""Documents that hold benchmark items, found by latent semantic retrieval.

Texts are cut into passages of 32 words, one every 16. Passages are TF-IDF
vectors (tf * idf^2) over the words of the benchmark, with frequencies counted
over all passages of the corpus. A randomised SVD of all those vectors gives the latent
space: every task multiplies its passages with a random matrix and back, the
products are summed over the cluster, and the driver factors one matrix of the
benchmark's vocabulary by RANK. Passages near an item's passage by cosine are
then verified word by word: the item's longest common subsequence with the
document around the passage, and for looser matches (paraphrases) whether the
item's answer stands there whole. Items of up to 16 words would be outweighed by
the other words of a passage; they are also compared with every run of their own
length that has half of its words from such items.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm.linededup import common_words
from twinledger.llm.textblocks import blocks, prepare, set_aside, text_bytes, words, Words
from twinledger.session import materialize

STRIDE = 16
#: Items of up to so many words are also searched in runs of their own length.
SHORT = 16
RANK = 128
COSINE = 0.5
#: Share of an item's words found in order that makes it a leak.
SAME = 0.7
#: The same for a paraphrase whose answer (the last words) is there whole.
PARAPHRASE = 0.55
ANSWER_SHARE = 4
#: Benchmark text handled at a time. A larger benchmark is searched block by block.
BLOCK_BYTES = 2 << 20
#: Words in more than one of so many runs of text hardly tell items apart and stay out
#: of the vectors, unless an item has fewer than LEAST_TERMS others.
COMMON = 16
LEAST_TERMS = 8
_SLICE_TERMS = 4096
_RUNS_AT_ONCE = 1024
_FOLDS = 64


@dataclass
class Benchmark:
    """One block of the benchmark: items as words, the vocabulary, passage vectors."""

    items: list[np.ndarray]
    vocabulary: np.ndarray
    present: np.ndarray
    passages: np.ndarray | None = None
    item_of: np.ndarray | None = None
    weights: np.ndarray | None = None
    #: A row per word: its place in the latent space, times its weight.
    basis: np.ndarray | None = None
    #: All words of the short items, common ones too.
    short_words: np.ndarray | None = None

    @classmethod
    def of(cls, texts: list[str]) -> Benchmark:
        found = words(*text_bytes(pa.array(texts, pa.string())))
        items = [found.hashes[s:e] for s, e in zip(found.first[:-1], found.first[1:])]
        vocabulary = np.unique(found.hashes)
        short = [x for x in items if len(x) <= SHORT]
        short_words = np.unique(np.concatenate(short)) if short else None
        return cls(items, vocabulary, cls._prefixes(vocabulary), short_words=short_words)

    @staticmethod
    def _prefixes(vocabulary: np.ndarray) -> np.ndarray:
        present = np.zeros(1 << 20, dtype=bool)
        present[vocabulary >> np.uint64(44)] = True
        return present

    def weigh(self, df: np.ndarray, runs: int) -> None:
        """Weights by how many runs of the corpus hold a word; common words are left out."""
        rare = df * COMMON <= runs
        for item in self.items:
            terms = np.searchsorted(self.vocabulary, np.unique(item))
            if rare[terms].sum() < LEAST_TERMS:
                rare[terms[np.argsort(df[terms], kind="stable")[:LEAST_TERMS]]] = True
        self.vocabulary, df = self.vocabulary[rare], df[rare]
        self.present = self._prefixes(self.vocabulary)
        self.weights = np.square(np.log1p(max(runs, 1) / np.maximum(df, 1))).astype(np.float32)

    def terms(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """Words of the vocabulary: their places among all words, and their numbers."""
        at = np.flatnonzero(self.present[found.hashes >> np.uint64(44)])
        number = np.searchsorted(self.vocabulary, found.hashes[at])
        hit = self.vocabulary[np.minimum(number, len(self.vocabulary) - 1)] == found.hashes[at]
        return at[hit], number[hit]

    def vectors(self, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit vectors of all passages, the text of each and its first word within the text."""
        halves = Halves(found)
        at, number = self.terms(found)
        sums = np.zeros((halves.n, self.basis.shape[1]), dtype=np.float32)
        if len(at):
            half = halves.of_word[at]
            edges = np.flatnonzero(np.append(True, half[1:] != half[:-1]))
            sums[half[edges]] = row_sums(self.basis, number, edges)
        starts = np.flatnonzero(halves.opens)
        both = sums[starts].copy()
        more = halves.has_next[starts]
        both[more] += sums[starts[more] + 1]
        length = np.linalg.norm(both, axis=1, keepdims=True)
        both /= np.where(length > 1e-6, length, 1)
        return both, halves.text[starts], halves.place[starts] * STRIDE

    def short_hits(self, found: Words) -> Iterator[tuple[int, int, float, float]]:
        """(text, item, share, cosine) of short items in runs of their own length."""
        if self.short_words is None or not len(self.short_words):
            return
        place = np.minimum(np.searchsorted(self.short_words, found.hashes), len(self.short_words) - 1)
        known = np.append(0, np.cumsum(self.short_words[place] == found.hashes))
        number = np.full(len(found.hashes), len(self.vocabulary))
        at, of_term = self.terms(found)
        number[at] = of_term
        rows = np.concatenate([self.basis, np.zeros((1, self.basis.shape[1]), dtype=self.basis.dtype)])
        text = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
        by_size: dict[int, list[int]] = {}
        for b, i in enumerate(self.item_of):
            if len(self.items[i]) <= SHORT:
                by_size.setdefault(len(self.items[i]), []).append(b)
        for n, wanted in by_size.items():
            last = len(found.hashes) - n + 1
            if last < 1:
                continue
            starts = np.flatnonzero((2 * (known[n:] - known[:-n]) >= n) & (text[:last] == text[n - 1 :]))
            for low in range(0, len(starts), 4096):
                part = starts[low : low + 4096]
                sums = sum(rows[number[part + j]] for j in range(n))
                length = np.linalg.norm(sums, axis=1, keepdims=True)
                sums /= np.where(length > 1e-6, length, 1)
                cosines = sums @ self.passages[wanted].T
                for w, b in zip(*np.nonzero(cosines >= COSINE)):
                    p, i = int(part[w]), int(self.item_of[wanted[b]])
                    t = int(text[p])
                    region = found.hashes[max(found.first[t], p - n) : min(found.first[t + 1], p + 2 * n)]
                    share, hit = matches(self.items[i], region)
                    if hit:
                        yield t, i, share, float(cosines[w, b])


def row_sums(rows: np.ndarray, number: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of rows[number] over short runs of `number`, which begin at `edges`.

    Runs are added up in step, longest first, some at a time: one row of floats per
    number would be much larger than the text.
    """
    size = np.diff(np.append(edges, len(number)))
    order = np.argsort(-size, kind="stable")
    out = np.empty((len(edges), rows.shape[1]), dtype=rows.dtype)
    for low in range(0, len(edges), _RUNS_AT_ONCE):
        here = order[low : low + _RUNS_AT_ONCE]
        begin, n = edges[here], size[here]
        total = rows[number[begin]]
        for j in range(1, n[0]):
            longer = np.count_nonzero(n > j)
            total[:longer] += rows[number[begin[:longer] + j]]
        out[here] = total
    return out


def row_totals(rows: np.ndarray, number: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The same for runs of any length, which are cut into short ones."""
    cuts = -(-np.diff(np.append(edges, len(number))) // STRIDE)
    first = np.cumsum(cuts) - cuts
    within = np.arange(cuts.sum()) - np.repeat(first, cuts)
    return np.add.reduceat(row_sums(rows, number, np.repeat(edges, cuts) + STRIDE * within), first, axis=0)


class Halves:
    """Runs of STRIDE words within each text; a passage is a run and the next one."""

    def __init__(self, found: Words):
        n_words = np.diff(found.first)
        n = -(-n_words // STRIDE)
        self.n = int(n.sum())
        self.text = np.repeat(np.arange(len(n)), n)
        first = np.cumsum(n) - n
        self.place = np.arange(self.n) - first[self.text] if self.n else np.zeros(0, dtype=np.int64)
        of_text = np.repeat(np.arange(len(n)), n_words)
        within = np.arange(len(found.hashes)) - found.first[of_text]
        self.of_word = first[of_text] + within // STRIDE
        self.has_next = self.place + 1 < n[self.text]
        # The last run of a text opens no passage unless it is the only one.
        self.opens = self.has_next | (self.place == 0)


def _passage_counts(docs: DataFrame, bench: Benchmark) -> tuple[np.ndarray, int]:
    """Runs of the corpus that contain each term, and all runs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, runs = np.zeros(len(bench.vocabulary), dtype=np.int64), 0
        for part in blocks(batches, "text"):
            found = words(*text_bytes(part.column("text")))
            halves = Halves(found)
            at, number = bench.terms(found)
            pairs = np.sort(halves.of_word[at] * len(total) + number)
            pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]]
            total += np.bincount(pairs % len(total), minlength=len(total))
            runs += halves.n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(total[used], runs))], ["term", "n"]
        )

    table = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = table.column("term").to_numpy(), table.column("n").to_numpy()
    out = np.zeros(len(bench.vocabulary), dtype=np.int64)
    out[term[term >= 0]] = n[term >= 0]
    return out, int(n[term < 0].sum())


def _latent_basis(docs: DataFrame, bench: Benchmark, seed: int) -> np.ndarray:
    """Right singular vectors of the passage matrix A: the range of A'A times a random
    matrix. They are scaled so that the space's main directions, which all texts of a
    language share, do not drown the others."""
    size = len(bench.vocabulary)
    rank = min(RANK, size)
    start = np.random.default_rng(seed).standard_normal((size, rank)).astype(np.float32)
    weighted = start * bench.weights[:, None]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((size, rank), dtype=np.float32)
        for part in blocks(batches, "text", 1 << 20):
            found = words(*text_bytes(part.column("text")))
            halves = Halves(found)
            at, number = bench.terms(found)
            if not len(at):
                continue
            half = halves.of_word[at]
            weight = bench.weights[number]
            edges = np.flatnonzero(np.append(True, half[1:] != half[:-1]))
            rows = row_sums(weighted, number, edges)
            norm = np.add.reduceat(weight * weight, edges)
            rows /= norm[:, None]
            by_term = np.argsort(number, kind="stable")
            run = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(at))))[by_term]
            ordered = number[by_term]
            firsts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
            total[ordered[firsts]] += row_totals(rows, run, firsts) * bench.weights[ordered[firsts], None]
        fold = TaskContext.get().partitionId() % _FOLDS
        for i in range(0, size, _SLICE_TERMS):
            data = total[i : i + _SLICE_TERMS].astype(np.float64).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([i // _SLICE_TERMS], pa.int32()), pa.array([fold], pa.int32()), pa.array([data], pa.binary())],
                ["slice", "fold", "data"],
            )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, dtype=np.float64) for x in group["data"])
        return pd.DataFrame({"slice": group["slice"].iloc[:1], "fold": [0], "data": [total.tobytes()]})

    schema = "slice int, fold int, data binary"
    parts = docs.select("text").mapInArrow(multiply, schema)
    # Twice, so that no group grows with the number of tasks beyond a 64th of them.
    summed = parts.groupBy("slice", "fold").applyInPandas(add, schema).groupBy("slice").applyInPandas(add, schema)
    slices = {row["slice"]: row["data"] for row in summed.collect()}
    product = np.concatenate([np.frombuffer(slices[i], dtype=np.float64) for i in sorted(slices)]).reshape(size, rank)
    left, scale, _ = np.linalg.svd(product, full_matrices=False)
    return (left / np.sqrt(np.maximum(scale, 1e-9 * max(scale[0], 1e-9)))).astype(np.float32)


def matches(item: np.ndarray, region: np.ndarray) -> tuple[float, bool]:
    """Share of the item's words found in order, and whether that is a leak."""
    share = common_words(item.tolist(), region.tolist()) / len(item)
    if share >= SAME or share < PARAPHRASE:
        return share, share >= SAME
    answer = item[-max(1, len(item) // ANSWER_SHARE) :]
    n = len(region) - len(answer) + 1
    if n < 1:
        return share, False
    spots = np.ones(n, dtype=bool)
    for j, w in enumerate(answer):
        spots &= region[j : j + n] == w
    return share, bool(spots.any())


def _search(docs: DataFrame, bench: Benchmark, ids: list, id_field: T.StructField) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bench)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("item", T.IntegerType()),
            T.StructField("share", T.DoubleType()),
            T.StructField("cosine", T.DoubleType()),
        ]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = shared.value
        for part in blocks(batches, "text", 1 << 20):
            found = words(*text_bytes(part.column("text")))
            vectors, text, place = bench.vectors(found)
            near: dict[tuple[int, int], tuple[float, list[int]]] = {}
            for low in range(0, len(vectors), 4096):
                cosines = vectors[low : low + 4096] @ bench.passages.T
                for w, b in zip(*np.nonzero(cosines >= COSINE)):
                    key = (int(text[low + w]), int(bench.item_of[b]))
                    best, places = near.get(key, (0.0, []))
                    places.append(int(place[low + w]))
                    near[key] = (max(best, float(cosines[w, b])), places)
            leaking: dict[tuple[int, int], tuple[float, float]] = {}
            for (t, i), (cosine, places) in near.items():
                item, reach = bench.items[i], len(bench.items[i]) + STRIDE
                text_words = found.hashes[found.first[t] : found.first[t + 1]]
                best, leak, done = 0.0, False, -1
                for p in sorted(set(places)):
                    if p + 2 * STRIDE <= done:
                        continue
                    region = text_words[max(0, p - reach) : p + 2 * STRIDE + reach]
                    share, hit = matches(item, region)
                    best, leak, done = max(best, share), leak or hit, p + STRIDE
                    if hit:
                        break
                if leak:
                    leaking[t, i] = best, cosine
            for t, i, share, cosine in bench.short_hits(found):
                best = leaking.get((t, i), (0.0, 0.0))
                leaking[t, i] = max(best[0], share), max(best[1], cosine)
            rows = [(t, i, share, cosine) for (t, i), (share, cosine) in leaking.items()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array([r[0] for r in rows], pa.int32())),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.float64()),
                    pa.array([r[3] for r in rows], pa.float64()),
                ],
                schema.fieldNames(),
            )

    names = spark.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("item", T.IntegerType()), id_field]))
    hits = docs.select("doc_id", "text").mapInArrow(search, schema)
    return hits.join(F.broadcast(names), "item").select("doc_id", "key", "share", "cosine")


def _text_leaks(docs: DataFrame, benchmark: DataFrame, seed: int) -> DataFrame:
    """doc_id, key, share, cosine: each row of `docs` with the hash of each item text that it holds."""
    spark: SparkSession = prepare(docs.sparkSession)
    items = benchmark.where("text is not null").select("text").distinct()
    items = materialize(items.select(F.xxhash64("text").alias("key"), "text"), "item-texts")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    known = docs.select("doc_id", "text").where("text is not null")
    key_field = T.StructField("key", T.LongType())
    found = []
    for b in range(n_blocks):
        rows = items.where(F.pmod("key", F.lit(n_blocks)) == b).orderBy("text").collect()
        bench = Benchmark.of([r["text"] for r in rows])
        full = [i for i, item in enumerate(bench.items) if len(item)]
        if not full:
            continue
        bench.items = [bench.items[i] for i in full]
        df, n = _passage_counts(known, bench)
        bench.weigh(df, n)
        bench.basis = _latent_basis(known, bench, seed) * bench.weights[:, None]
        joined = np.concatenate(bench.items)
        first = np.concatenate([[0], np.cumsum([len(x) for x in bench.items])])
        bench.passages, bench.item_of, _ = bench.vectors(Words(joined, first, first, first))
        found.append(_search(known, bench, [rows[i]["key"] for i in full], key_field))
    if not found:
        kinds = [docs.schema["doc_id"], key_field]
        return spark.createDataFrame(
            [], T.StructType([*kinds, T.StructField("share", T.DoubleType()), T.StructField("cosine", T.DoubleType())])
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, item_id, share, cosine: each row of `docs` with each item that it holds.

    `benchmark`: item_id, text. Items and documents without a word match nothing.
    The driver reads the distinct texts of the benchmark in blocks of about 2 MB, so
    what it holds and sends to the tasks is bounded; ids are joined to them afterwards.
    """
    named = benchmark.where("text is not null").select("item_id", F.xxhash64("text").alias("key"))
    return _text_leaks(docs, benchmark, seed).join(named, "key").select("doc_id", "item_id", "share", "cosine")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the rows whose doc_id has a leak in any of its texts."""
    bad = materialize(_text_leaks(docs, benchmark, 0).select(F.col("doc_id").alias("__id")).distinct(), "leaking")
    return set_aside(docs).join(bad, F.col("doc_id").eqNullSafe(F.col("__id")), "left_anti").toDF(*docs.columns)
