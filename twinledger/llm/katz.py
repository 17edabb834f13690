"""Katz backoff language model, counted and evaluated over whole tables.

A token's probability is that of the longest known n-gram that ends with it. With c
the training count of an n-gram and h its first n - 1 words,

    P(w | h) = d(c) c / (c(h) + z(h))               if c > 0,
    P(w | h) = a(h) P(w | h without its first word) else (a = 1 if h is unknown),

and for single words P(w) = d(c) c / (N + z), all unknown words together having what
is left. d is the Good-Turing discount of counts up to DISCOUNTED, per length of the
n-gram; where the counts of counts give none between 0 and 1, half a count is taken off.
a(h) shares what h leaves, 1 - sum of d(c) c / (c(h) + z), among the words not seen after
h in proportion to the shorter n-grams, so the probabilities after any h sum to 1.
z(h) is 1 if no count after h is discounted, so that something is left, else 0.

Texts are tokenised once, into stored blocks of words numbered within the block. For
each length, every block asks for its distinct n-grams: one row per block and table
partition. A partition adds up the counts, stores its part of the table, and answers. n-grams are dealt by their context, so a context's
sums meet in one partition; those of contexts too frequent for one partition are dealt
by the whole n-gram, and their sums are added in a further, small shuffle. Blocks then
evaluate the recursion for all their tokens in step.

Null and empty texts have the end token only. Rows are texts: repeated rows count, and
are scored, each. Only doc_id and text are read. With no training text everything is
unknown, and unknown words have probability 1.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm.textblocks import _LOWER, _STEP, blocks, mix, prepare, text_bytes
from twinledger.session import scratch_path

ORDER = 2
#: Highest count that is discounted.
DISCOUNTED = 5
#: Bytes of text in a stored block, and n-grams of a table partition before equal ones are merged.
STORED_BYTES = 8 << 20
PART_ENTRIES = 1 << 20
#: The end token; no word holds a line end.
END = b"\n"

_ANSWER, _TABLE, _PARTIAL, _HOT = range(4)


# How a column is packed: by its smallest type, and as differences if it ascends.
_TYPES = (np.dtype("u1"), np.dtype("<u2"), np.dtype("<u4"), np.dtype("<i8"), np.dtype("<f8"))
_ASCENDING = 8


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, compressed. The few bytes around them matter: at scale a block asks
    each partition for little."""
    codes, parts = [], []
    for values in columns:
        code = 4 if values.dtype.kind == "f" else 3
        if code == 3 and len(values):
            if len(values) > 1 and (values[1:] >= values[:-1]).all():
                values, code = np.diff(values, prepend=0), code | _ASCENDING
            low, high = int(values.min()), int(values.max())
            if low >= 0:
                code = code & _ASCENDING | (0 if high < 1 << 8 else 1 if high < 1 << 16 else 2 if high < 1 << 32 else 3)
        codes.append(code)
        parts.append(values.astype(_TYPES[code & 7]).tobytes())
    head = len(columns[0]).to_bytes(4, "little") + bytes(codes)
    return head + pa.compress(b"".join(parts), codec="zstd", asbytes=True)


def _unpack(payload: bytes, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    n, codes = int.from_bytes(payload[:4], "little"), payload[4 : 4 + len(names)]
    size = sum(_TYPES[c & 7].itemsize for c in codes) * n
    data = pa.decompress(payload[4 + len(names) :], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    out, at = {}, 0
    for name, code in zip(names, codes):
        kind = _TYPES[code & 7]
        values = np.frombuffer(data, dtype=kind, count=n, offset=at)
        at += kind.itemsize * n
        if kind.kind != "f":
            values = values.astype(np.int64)
        out[name] = np.cumsum(values) if code & _ASCENDING else values
    return out


def _pack_words(words: pa.Array) -> bytes:
    flat = b"".join(words.to_pylist())
    return len(flat).to_bytes(8, "little") + pa.compress(flat, codec="zstd", asbytes=True)


def _unpack_words(payload: bytes, sizes: np.ndarray) -> pa.Array:
    size = int.from_bytes(payload[:8], "little")
    flat = pa.decompress(payload[8:], decompressed_size=size, codec="zstd") if size else pa.py_buffer(b"")
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), flat])


def _sizes(words: pa.Array) -> np.ndarray:
    return pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written once and read back; payloads are compressed already."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Discounts:
    """d(1) .. d(DISCOUNTED) of one length, by Good-Turing from the counts of counts."""

    factors: list[float]

    @classmethod
    def of(cls, counts_of_counts: list[int]) -> Discounts:
        n = [0, *counts_of_counts]
        k = DISCOUNTED
        top = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
        factors = []
        for r in range(1, k + 1):
            good = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
            d = (good - top) / (1 - top) if top < 1 else 0.0
            factors.append(d if 0 < d < 1 else (r - 0.5) / r)
        return cls(factors)

    def of_counts(self, counts: np.ndarray) -> np.ndarray:
        table = np.array([0.0, *self.factors, 1.0])
        return table[np.minimum(counts, DISCOUNTED + 1)]

    def taken(self, few: np.ndarray) -> np.ndarray:
        """What is taken off in all, `few[r - 1]` n-grams having count r."""
        r = np.arange(1, DISCOUNTED + 1)
        return ((1 - np.array(self.factors)) * r) @ few


def _tokenised(docs: DataFrame, training: Column, stored_bytes: int) -> DataFrame:
    """Stored blocks: ids, whether each text is a training text, its number of tokens; the tokens as
    numbers of `words`, and how often each word stands in training texts."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("texts", T.BinaryType()),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("word_counts", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        train: list[np.ndarray] = []
        sizes: list[int] = []
        tokens: list[np.ndarray] = []
        words: dict[bytes, int] = defaultdict(count().__next__)
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, ids, train, sizes, tokens, words, held
            flat, flags = np.concatenate(tokens), np.concatenate(train)
            learned = flat[np.repeat(flags, sizes)]
            spelled = pa.array(list(words), pa.binary())
            row = [
                pa.array([number]),
                pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids)),
                pa.array([len(flat)], pa.int64()),
                pa.array([_pack(flags.astype(np.int64), np.array(sizes))], pa.binary()),
                pa.array([_pack(flat)], pa.binary()),
                pa.array([_pack_words(spelled)], pa.binary()),
                pa.array([_pack(_sizes(spelled), np.bincount(learned, minlength=len(words)))], pa.binary()),
            ]
            number, ids, train, sizes, tokens, held = number + 1, [], [], [], [], 0
            words = defaultdict(count().__next__)
            return pa.RecordBatch.from_arrays(row, schema.fieldNames())

        for part in blocks(batches, "text"):
            raw, offsets = text_bytes(part.column("text"))
            data = _LOWER[raw].tobytes()
            found = [[*data[s:e].split(), END] for s, e in zip(offsets.tolist(), offsets[1:].tolist())]
            ids.append(part.column("doc_id"))
            train.append(part.column("training").to_numpy(zero_copy_only=False).astype(bool))
            sizes += map(len, found)
            tokens.append(np.fromiter((words[w] for t in found for w in t), dtype=np.int32, count=sum(map(len, found))))
            held += len(data)
            if held >= stored_bytes:
                yield flush()
        if ids:
            yield flush()

    return _stored(docs.select("doc_id", "text", training.alias("training")).mapInArrow(run, schema), "lm-blocks")


@dataclass
class Level:
    """A block's distinct n-grams of one length: where each first ends, which one ends at each
    token (-1 near the beginning of a text), and what the table answered."""

    first: np.ndarray
    at: np.ndarray
    known: dict[str, np.ndarray]


class Block:
    """One block's tokens and the n-grams that end at them, as far as they were asked."""

    def __init__(self, batch: pa.RecordBatch, i: int, dealing: Dealing):
        self.dealing = dealing
        self.number = batch.column("block")[i].as_py()
        self.ids = batch.column("doc_ids")[i].values
        texts = _unpack(batch.column("texts")[i].as_py(), ("train", "size"))
        self.train, self.sizes = texts["train"].astype(bool), texts["size"]
        self.token = _unpack(batch.column("tokens")[i].as_py(), ("token",))["token"]
        self.learned = np.repeat(self.train, self.sizes)
        self.place = np.arange(len(self.token)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.levels: list[Level] = []
        words, _ = _words_of(batch, i)
        first = np.zeros(len(words), dtype=np.int64)
        first[self.token[::-1]] = np.arange(len(self.token))[::-1]
        part = dealing.words(words)
        order = np.argsort(part, kind="stable")
        known = _merge(part[order], batch.column("answers1")[i].as_py(), _OF_WORD)
        back = np.argsort(order)
        self.levels.append(Level(first, self.token, {name: v[back] for name, v in known.items()}))
        n = 2
        while f"answers{n}" in batch.schema.names:
            self._add(n, batch.column(f"answers{n}")[i].as_py() or [], batch.column(f"sums{n}")[i].as_py() or [])
            n += 1

    def _add(self, n: int, answers: list[dict], sums: list[dict]) -> None:
        first, at, order, part = self.requested(n)
        known = _merge(part[order], answers, _OF_GRAM)
        back = np.argsort(order)
        known = {name: v[back] for name, v in known.items()}
        # Sums of contexts that are dealt by whole n-grams come apart.
        of = {tuple(s["context"]): s for s in sums}
        for i in np.flatnonzero(self.context_count(n, first) > self.dealing.entries).tolist() if of else ():
            found = of.get(tuple(self.word_ids(first[i], k) for k in range(n - 1, 0, -1)))
            if found:
                known["lower"][i] = found["lower"]
                known["z"][i] = int(not any(found["few"]))
                for name, value in zip(_FEW, found["few"]):
                    known[name][i] = value
        self.levels.append(Level(first, at, known))

    def word_ids(self, ends: np.ndarray, back: int) -> np.ndarray:
        """Corpus-wide numbers of the words so many places before these."""
        return self.levels[0].known["id"][self.token[ends - back]]

    def context_count(self, n: int, ends: np.ndarray) -> np.ndarray:
        """Training count of the n - 1 words before these places."""
        context = self.levels[n - 2]
        return context.known["c"][context.at[ends - 1]]

    def requested(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct n-grams: a place where each ends, the one that ends at each token, the order in
        which they are sent (by partition, then by their words' numbers), and each one's partition
        (-1: the context is unknown, so there is nothing to ask)."""
        at = np.full(len(self.token), -1, dtype=np.int64)
        ends = np.flatnonzero(self.place >= n - 1)
        keys = self.levels[n - 2].at[ends - 1] * len(self.levels[0].first) + self.token[ends]
        _, first, at[ends] = np.unique(keys, return_index=True, return_inverse=True)
        first = ends[first]
        words = [self.word_ids(first, k) for k in range(n - 1, -1, -1)]
        part = self.dealing.grams(words, self.context_count(n, first))
        return first, at, np.lexsort((*words[::-1], part)), part


@dataclass
class Dealing:
    """Which table partition has which n-gram."""

    parts: int
    entries: int

    def words(self, words: pa.Array) -> np.ndarray:
        return np.fromiter((zlib.crc32(w) for w in words.to_pylist()), dtype=np.int64, count=len(words)) % self.parts

    def grams(self, words: list[np.ndarray], context_count: np.ndarray) -> np.ndarray:
        """By context, or by the whole n-gram if the context alone would fill a partition."""
        h = np.zeros(len(context_count), dtype=np.uint64)
        for w in words[:-1]:
            h = mix(h * _STEP + w.astype(np.uint64) + np.uint64(1))
        whole = mix(h * _STEP + words[-1].astype(np.uint64) + np.uint64(1))
        part = (np.where(context_count > self.entries, whole, h) % np.uint64(self.parts)).astype(np.int64)
        return np.where(context_count > 0, part, -1)


def _words_of(batch: pa.RecordBatch, i: int) -> tuple[pa.Array, np.ndarray]:
    """A block's words and their training counts."""
    counts = _unpack(batch.column("word_counts")[i].as_py(), ("size", "n"))
    return _unpack_words(batch.column("words")[i].as_py(), counts["size"]), counts["n"]


_FEW = tuple(f"few{r}" for r in range(1, DISCOUNTED + 1))
_OF_WORD, _OF_GRAM, _OF_CONTEXT = ("id", "c"), ("c", "z"), ("lower", *_FEW)
_ASKED = ("n", "many", "above", "below")
_REQUEST = "part long, block long, payload binary, words binary"
# Answers to blocks; table partitions with their counts of counts; partial sums of contexts
# dealt by whole n-grams; and who asks for those sums.
_REPLY = "kind int, part long, block long, payload binary, sums binary, words binary, context array<long>, few array<long>, lower double"


def _merge(part: np.ndarray, answers: list[dict], names: tuple[str, ...]) -> dict[str, np.ndarray]:
    """Answers of all partitions, in the order sent; zeros where nothing was asked."""
    out = {name: np.zeros(len(part), dtype=np.int64) for name in names}
    if names != _OF_WORD:
        out |= {name: np.zeros(len(part), dtype=np.float64 if name == "lower" else np.int64) for name in _OF_CONTEXT}
    for answer in answers:
        low, high = np.searchsorted(part, [answer["part"], answer["part"] + 1])
        found = _unpack(answer["payload"], names)
        for name, values in found.items():
            out[name][low:high] = values
        if answer["sums"]:
            # Sent for n-grams that training texts do not have: the others need none.
            missing = low + np.flatnonzero(found["c"] == 0)
            for name, values in _unpack(answer["sums"], _OF_CONTEXT).items():
                out[name][missing] = values
    return out


def _requests(block: int, rows: list[tuple[int, bytes, bytes | None]]) -> pa.RecordBatch:
    columns = [[p for p, _, _ in rows], [block] * len(rows), [x for _, x, _ in rows], [w for _, _, w in rows]]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "block", "payload", "words"])


def _stretches(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """value, start, end of each stretch of equal values."""
    if len(values):
        edges = np.flatnonzero(np.append(True, values[1:] != values[:-1])).tolist()
        yield from zip(values[edges].tolist(), edges, [*edges[1:], len(values)])


def _replies(rows: list[dict]) -> pa.Table:
    types = {
        "kind": pa.int32(), "part": pa.int64(), "block": pa.int64(), "payload": pa.binary(), "sums": pa.binary(), "words": pa.binary(),
        "context": pa.list_(pa.int64()), "few": pa.list_(pa.int64()), "lower": pa.float64(),
    }
    return pa.Table.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in types.items()], list(types))


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    """How many n-grams have count 1, .., DISCOUNTED + 1; then how many there are, and their sum."""
    few = np.bincount(np.minimum(counts, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2]
    return [*few.tolist(), int((counts > 0).sum()), int(counts.sum())]


def _word_requests(stored: DataFrame, dealing: Dealing) -> DataFrame:
    """The words of each block with their training counts, per partition of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, n = _words_of(batch, i)
                part = dealing.words(words)
                order = np.argsort(part, kind="stable")
                rows = []
                for p, s, e in _stretches(part[order]):
                    mine = words.take(pa.array(order[s:e]))
                    rows.append((p, _pack(_sizes(mine), n[order[s:e]]), _pack_words(mine)))
                yield _requests(batch.column("block")[i].as_py(), rows)

    return stored.select("block", "words", "word_counts").mapInArrow(run, _REQUEST)


def _count_words(parts: int) -> Callable[[pa.Table], pa.Table]:
    """Adds up one partition's words. A word's number is its row in the partition, times the
    number of partitions, plus the partition's."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        asked = [_unpack(p, ("size", "n")) for p in table.column("payload").to_pylist()]
        spelled = [_unpack_words(w, a["size"]) for w, a in zip(table.column("words").to_pylist(), asked)]
        encoded = pa.concat_arrays(spelled).dictionary_encode()
        row = encoded.indices.to_numpy().astype(np.int64)
        counts = np.zeros(len(encoded.dictionary), dtype=np.int64)
        np.add.at(counts, row, np.concatenate([a["n"] for a in asked]))
        seen = np.flatnonzero(counts)
        words = encoded.dictionary.take(pa.array(seen))
        stored = _pack(_sizes(words), seen * parts + part, counts[seen])
        rows = [{"kind": _TABLE, "part": part, "payload": stored, "words": _pack_words(words), "few": _counts_of_counts(counts)}]
        ends = np.cumsum([len(a["n"]) for a in asked]).tolist()
        for block, s, e in zip(table.column("block").to_pylist(), [0, *ends], ends):
            payload = _pack(row[s:e] * parts + part, counts[row[s:e]])
            rows.append({"kind": _ANSWER, "part": part, "block": block, "payload": payload})
        return _replies(rows)

    return run


def _gram_requests(asking: DataFrame, n: int, dealing: Dealing, total: int) -> DataFrame:
    """The n-grams of each block whose context is known, per partition of the table.

    With each go its training count, how frequent its context is, and the count and
    denominator of the probability of the n-gram without its first word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i, dealing)
                first, at, order, part = block.requested(n)
                last = block.levels[-1]
                short = last.at[first]
                below = total if n == 2 else block.context_count(n - 1, first) + last.known["z"][short]
                learned = np.bincount(at[block.learned & (at >= 0)], minlength=len(first))
                order = order[part[order] >= 0]
                columns = [block.word_ids(first, n - 1 - k)[order] for k in range(n)]
                columns += [learned[order], block.context_count(n, first)[order]]
                columns += [np.where(learned > 0, x, 0)[order] for x in (last.known["c"][short], below)]
                rows = [(p, _pack(*(v[s:e] for v in columns)), None) for p, s, e in _stretches(part[order])]
                yield _requests(block.number, rows)

    return asking.mapInArrow(run, _REQUEST)


def _count_grams(n: int, dealing: Dealing, shorter: Discounts) -> Callable[[pa.Table], pa.Table]:
    """Adds up one partition's n-grams and the sums of their contexts. `shorter`: the discounts of
    the probabilities one word shorter."""
    names = [f"w{k}" for k in range(n)]

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        asked = [_unpack(p, (*names, *_ASKED)) for p in table.column("payload").to_pylist()]
        ends = np.cumsum([len(a["n"]) for a in asked]).tolist()
        column = {name: np.concatenate([a.pop(name) for a in asked]) for name in (*names, *_ASKED)}
        context = np.zeros(len(column["n"]), dtype=np.int64)
        for name in names[:-1]:
            _, context = np.unique(context * (int(column[name].max()) + 1) + column[name], return_inverse=True)
        whole = context * (int(column[names[-1]].max()) + 1) + column[names[-1]]
        _, first, gram = np.unique(whole, return_index=True, return_inverse=True)
        counts, above, below = (np.zeros(len(first), dtype=np.int64) for _ in range(3))
        np.add.at(counts, gram, column["n"])
        np.maximum.at(above, gram, column["above"])
        np.maximum.at(below, gram, column["below"])
        of = context[first]  # ascending
        size = int(of[-1]) + 1
        lower = np.where(counts > 0, shorter.of_counts(above) * above / np.maximum(below, 1), 0.0)
        sums = np.bincount(of, weights=lower, minlength=size)
        few = {name: np.bincount(of[counts == r], minlength=size) for r, name in enumerate(_FEW, 1)}
        hot = np.zeros(size, dtype=bool)
        hot[of] = column["many"][first] > dealing.entries
        spare = (sum(few.values()) == 0) & ~hot

        kept = np.flatnonzero(counts)
        grams = _pack(*(column[name][first[kept]] for name in names), counts[kept])
        rows = [{"kind": _TABLE, "part": part, "payload": grams, "few": _counts_of_counts(counts)}]
        head = first[np.searchsorted(of, np.arange(size))]

        def spelled(c: int) -> list[int]:
            return [int(column[name][head[c]]) for name in names[:-1]]

        for c in np.flatnonzero(hot).tolist():
            some = [int(few[name][c]) for name in _FEW]
            rows.append({"kind": _PARTIAL, "part": part, "context": spelled(c), "few": some, "lower": float(sums[c])})
        for block, s, e in zip(table.column("block").to_pylist(), [0, *ends], ends):
            mine, c = context[s:e], counts[gram[s:e]]
            missing = mine[c == 0]
            answer = {
                "kind": _ANSWER,
                "part": part,
                "block": block,
                "payload": _pack(c, spare[mine].astype(np.int64)),
                "sums": _pack(sums[missing], *(few[name][missing] for name in _FEW)) if len(missing) else None,
            }
            rows.append(answer)
            rows += [{"kind": _HOT, "part": part, "block": block, "context": spelled(k)} for k in np.unique(mine[hot[mine]]).tolist()]
        return _replies(rows)

    return run


def _answers(replies: DataFrame, n: int) -> DataFrame:
    """Per block what the tables of n-grams answer: at most its own n-grams."""
    answers = (
        replies.where(F.col("kind") == _ANSWER)
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("part", "payload", "sums"))).alias(f"answers{n}"))
    )
    if n == 1:
        return answers
    few = F.array(*(F.sum(F.col("few")[r]) for r in range(DISCOUNTED)))
    sums = replies.where(F.col("kind") == _PARTIAL).groupBy("context").agg(few.alias("few"), F.sum("lower").alias("lower"))
    hot = (
        replies.where(F.col("kind") == _HOT)
        .select("block", "context")
        .distinct()
        .join(sums, "context")
        .groupBy("block")
        .agg(F.collect_list(F.struct("context", "few", "lower")).alias(f"sums{n}"))
    )
    return answers.join(hot, "block", "left")


def _statistics(replies: DataFrame) -> list[int]:
    """Counts of counts, distinct n-grams and tokens of a whole table: one row to the driver."""
    tables = replies.where(F.col("kind") == _TABLE)
    row = tables.agg(*(F.sum(F.col("few")[i]).alias(f"s{i}") for i in range(DISCOUNTED + 3))).first()
    return [int(x or 0) for x in row]


@dataclass
class Katz:
    """A trained model and its scores.

    `tables[n - 1]` has the stored partitions of the table of n-grams of n words among its
    rows; `rows` reads them. `scores`: see `train_and_score`.
    """

    total: int
    distinct: int
    discounts: list[Discounts]
    tables: list[DataFrame]
    scores: DataFrame

    def rows(self, n: int) -> DataFrame:
        """words (their numbers, or the word itself and its number for n = 1) and n, the training count."""
        fields = "word string, id long, n long" if n == 1 else "words array<long>, n long"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for payload, words in zip(batch.column("payload").to_pylist(), batch.column("words").to_pylist()):
                    if n == 1:
                        found = _unpack(payload, ("size", "id", "n"))
                        columns = [_unpack_words(words, found["size"]).cast(pa.string()), pa.array(found["id"])]
                    else:
                        found = _unpack(payload, (*(f"w{k}" for k in range(n)), "n"))
                        flat = np.stack([found[f"w{k}"] for k in range(n)], axis=1).ravel()
                        columns = [pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, n), pa.int32()), pa.array(flat))]
                    columns.append(pa.array(found["n"]))
                    yield pa.RecordBatch.from_arrays(columns, ["word", "id", "n"] if n == 1 else ["words", "n"])

        return self.tables[n - 1].where(F.col("kind") == _TABLE).select("payload", "words").mapInArrow(run, fields)


def train_and_score(
    docs: DataFrame,
    training: Column,
    order: int = ORDER,
    stored_bytes: int = STORED_BYTES,
    part_entries: int = PART_ENTRIES,
) -> Katz:
    """Learns from the rows of `docs` that fulfil `training`, and scores all rows.

    Tokens are runs of characters other than U+0020 and U+0009 to U+000D, with A-Z in lower
    case, then the end of the text. `scores` has doc_id, held_out (not a training text),
    n_tokens, n_known (tokens that training texts have), train_tokens (all tokens of
    training texts), base_score (log10 of add-one word frequencies, one word more than known
    counted) and score (log10 of the text's probability).
    """
    prepare(docs.sparkSession)
    stored = _tokenised(docs, F.coalesce(training, F.lit(False)), stored_bytes)
    tokens = stored.agg(F.sum("n_tokens")).first()[0] or 0
    dealing = Dealing(max(1, -(-tokens // part_entries)), part_entries)
    replies = _stored(_word_requests(stored, dealing).groupBy("part").applyInArrow(_count_words(dealing.parts), _REPLY), "lm-1")
    *few, distinct, total = _statistics(replies)
    tables, discounts, counts = [replies], [Discounts.of(few)], [few]
    asking = stored.join(_answers(replies, 1), "block")
    spare = int(sum(few[:DISCOUNTED]) == 0)
    for n in range(2, order + 1):
        requests = _gram_requests(asking, n, dealing, total + spare)
        replies = _stored(requests.groupBy("part").applyInArrow(_count_grams(n, dealing, discounts[-1]), _REPLY), f"lm-{n}")
        *few, _, _ = _statistics(replies)
        tables.append(replies)
        discounts.append(Discounts.of(few))
        asking = asking.join(_answers(replies, n), "block", "left")
    left = (spare + float(discounts[0].taken(np.array(counts[0][:DISCOUNTED])))) / (total + spare)

    id_type = docs.schema["doc_id"].dataType
    kinds = {
        "held_out": T.BooleanType(), "n_tokens": T.LongType(), "n_known": T.LongType(), "train_tokens": T.LongType(),
        "base_score": T.DoubleType(), "score": T.DoubleType(),
    }
    schema = T.StructType([T.StructField("doc_id", id_type), *(T.StructField(name, kind) for name, kind in kinds.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i, dealing)
                c = block.levels[0].known["c"][block.token]
                starts = np.cumsum(block.sizes) - block.sizes
                columns = [
                    block.ids,
                    pa.array(~block.train),
                    pa.array(block.sizes),
                    pa.array(np.add.reduceat(c > 0, starts, dtype=np.int64)),
                    pa.array(np.full(len(starts), total)),
                    pa.array(np.add.reduceat(np.log10((c + 1) / (total + 1 * (distinct + 1))), starts)),
                    pa.array(np.add.reduceat(np.log10(probabilities(block, discounts, total + spare, left)), starts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return Katz(total, distinct, discounts, tables, asking.mapInArrow(run, schema))


def probabilities(block: Block, discounts: list[Discounts], total: int, left: float) -> np.ndarray:
    """The probability of every token of a block after the words before it.

    `total`: the denominator of single words; `left`: what all unknown words share.
    """
    c = block.levels[0].known["c"][block.token]
    p = np.where(c > 0, discounts[0].of_counts(c) * c / total, left)
    for n, (level, discount) in enumerate(zip(block.levels[1:], discounts[1:]), 2):
        known = level.known
        above = block.context_count(n, level.first)
        whole = np.maximum(above + known["z"], 1)
        taken = known["z"] + discount.taken(np.stack([known[name] for name in _FEW]))
        share = np.where(above > 0, taken / whole / (1 - known["lower"]), 1.0)
        seen = known["c"] > 0
        direct = np.where(seen, discount.of_counts(known["c"]) * known["c"] / whole, 0.0)
        ends = np.flatnonzero(level.at >= 0)
        gram = level.at[ends]
        p[ends] = np.where(seen[gram], direct[gram], share[gram] * p[ends])
    return p
