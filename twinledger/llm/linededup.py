"""Repeated lines across documents, near ones included: one occurrence stays.

A line is its sequence of words, case aside; each character of a script without
blanks is a word. Lines of any number of words are told apart by that. Lines of at
least five words may also have near copies, by edit similarity over words,
2 * LCS / (n + m) >= 0.9; shorter ones are only looked at for exact repeats.

Candidates come from pigeonhole blocks of two kinds. Each line has a 128-bit SimHash
of its words, cut into four blocks of 32 bits: lines that differ in three bits or
fewer share a block, whatever their words. Most similar lines differ in more bits,
so that the words themselves are cut into blocks as well, by their hash. Similar
lines of n and m words differ in no more than D = (n + m) / 10 words (a word's later
occurrences count as words of their own), so that of k blocks at least k - D are
equal in both. Of these, a line keeps the D + 1 that tell most about it by the corpus
counts of their words; since two equal blocks tell equally much, at least one equal
block is kept by both. D depends on both sizes: lines are cut once for each of the
overlapping ranges of sizes that they lie in, and any two similar lines lie in one.
Counts decide only how few unrelated lines share a block, never which pairs are found.

Blocks travel bare, as 13 bytes with 32 parity bits of the line (each flipped by every
word that falls on it: similar lines differ in no more than D). Only lines that share
a block with one of possible size and parity travel again, with 256 of these bits (128
rule out nothing from 640 words in both lines on). Pairs that are still possible are
told apart by as many bits as they have words, and what is left is compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm.links import Features, Similarity, components
from twinledger.llm.textblocks import blocks, mix, prepare, runs_of, set_aside, signed, text_bytes, unspaced, words
from twinledger.operators import blooms
from twinledger.operators.lists import narrow
from twinledger.session import materialize

#: Shorter lines have no near copies.
LEAST_WORDS = 5
SIMILARITY = 0.9
BLOCKS = 4
#: A range of sizes that lines are cut into blocks for begins at so many tenths of the one before.
STEP_TENTHS = 16
#: Up to so many line keys (16 bytes each), and documents with lists of lines to drop
#: of so many numbers in all, are sent to every task; more are matched by a shuffle.
KEYS_SENT = 1_000_000
DOCS_SENT, NUMBERS_SENT = 200_000, 4_000_000
#: Bytes of bare blocks that one task looks through, on average.
BARE_BYTES = 8 << 20
#: Lines of a block are tested against so many others; all lines of a longer block go on.
TESTED = 256
#: Words are counted by so many values of their hash, in so many pieces, so many tasks' at a time.
_COUNTERS, _PIECES, _FAN_IN = 1 << 19, 16, 16
_LINES_AT_ONCE = 1 << 24
#: Bytes of text whose lines a task holds as numbers at a time.
TEXT_BYTES = 1 << 19
_SENT_AT_ONCE = 1 << 18
# A block as it travels: its name within its part, its line, the line's parity bits and size.
_BARE = np.dtype([("rest", "<u4"), ("line", "<u4"), ("parity", "<u4"), ("size", "u1")])
# The same of lines that may be similar to another one, so far.
_PARITY = ("p0", "p1", "p2", "p3")
_FULL = np.dtype([("rest", "<u4"), ("k0", "<i8"), ("k1", "<i8"), ("size", "<i4"), ("parity", "<u8", len(_PARITY))])
_MEMBER = ", ".join(f"{x} long" for x in ("k0", "k1", "size", *_PARITY))
_WORDS_AT_ONCE = 1 << 16
# The bits of a byte, highest first, as the bytes of a number, lowest first.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view("<u8").ravel()


class Lines:
    """Lines of a block of texts that have a word, or at least `least` of them.

    Each character of a script without blanks is a word.
    """

    def __init__(self, texts: pa.Array, least: int = 1):
        raw, offsets = text_bytes(texts)
        found = words(raw, offsets, unspaced(raw))
        breaks = np.flatnonzero(raw == 10)
        text_of_break = np.searchsorted(offsets, breaks, side="right") - 1
        # A line starts with its text or after a break within it.
        starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
        # A break at the end of a text starts an (empty) line of that text, not of the next.
        owner = np.sort(np.concatenate([np.arange(len(offsets) - 1), text_of_break]), kind="stable")
        per_text = np.bincount(owner, minlength=len(offsets) - 1)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        edges = np.append(np.searchsorted(found.starts, starts), len(found.starts))
        size = np.diff(edges)
        kept = np.flatnonzero(size >= least)
        self.text, self.number, self.first, self.size = owner[kept], number[kept], edges[kept], size[kept]
        self.words = found.hashes

    def leave(self, kept: np.ndarray) -> None:
        """Only the lines at the places `kept` stay."""
        self.text, self.number, self.first, self.size = (
            x[kept] for x in (self.text, self.number, self.first, self.size)
        )

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums modulo 2^64 over the words of each line."""
        total = np.zeros(len(self.words) + 1, dtype=np.uint64)
        np.cumsum(values, out=total[1:])
        return total[self.first + self.size] - total[self.first]

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that stand for each line's word sequence."""
        place = np.zeros(len(self.words), dtype=np.uint64)
        at = np.repeat(self.first - np.cumsum(self.size) + self.size, self.size) + np.arange(self.size.sum())
        place[at] = at - np.repeat(self.first, self.size)
        one = mix(self.words ^ mix(place + np.uint64(1)))
        return mix(self.sums(one)), mix(self.sums(mix(one + np.uint64(7))))

    @cached_property
    def told(self) -> tuple[np.ndarray, np.ndarray]:
        """The words of all lines, told apart by how often the line had them before, and their lines.

        A line's words come in the order of their hashes.
        """
        out, starts = [], np.cumsum(self.size) - self.size
        for i in range(0, len(self.size), _LINES_AT_ONCE):
            size = self.size[i : i + _LINES_AT_ONCE]
            line = np.repeat(np.arange(len(size)), size)
            held = self.words[np.arange(len(line)) + (self.first[i : i + _LINES_AT_ONCE] - starts[i : i + _LINES_AT_ONCE] + starts[i])[line]]
            held = np.sort(line.astype(np.uint64) << np.uint64(40) | held >> np.uint64(24))
            new = np.ones(len(held), dtype=bool)
            new[1:] = held[1:] != held[:-1]
            place = np.arange(len(held))
            again = (place - np.maximum.accumulate(np.where(new, place, 0))).astype(np.uint64)
            out.append(mix((held & np.uint64((1 << 40) - 1)) + (again << np.uint64(40))))
        none = np.zeros(0, dtype=np.uint64)
        return np.concatenate([none, *out]), np.repeat(np.arange(len(self.size)), self.size)

    def parities(self, bits: int) -> np.ndarray:
        """A row of so many bits per line, as bytes: each is flipped by every word that falls on it."""
        told, owner = self.told
        hits = np.bincount(owner * bits + (told & np.uint64(bits - 1)).astype(np.int64), minlength=bits * len(self.size))
        return np.packbits((hits & 1).astype(np.uint8).reshape(-1, bits), axis=1)

    def word_blocks(self, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lines and hashes of the blocks of words that each keeps."""
        told, _ = self.told
        begin = np.cumsum(self.size) - self.size
        tells = level[_counter(told)].astype(np.float64)
        low = (told & np.uint64(0xFFFFFFFF)).astype(np.float64)
        other = mix(told)
        high = (other >> np.uint64(32)).astype(np.float64)
        lines, hashes = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
        for least, most, kept in size_ranges(int(self.size.max(initial=0))):
            here = np.flatnonzero((self.size >= least) & (self.size <= most))
            if not len(here):
                continue
            n = kept + kept // 2
            size = self.size[here]
            line = np.repeat(np.arange(len(here)), size)
            at = np.arange(len(line)) + (begin[here] - np.cumsum(size) + size)[line]
            block = line * n + (other[at] & np.uint64(0xFFFFFFFF)).astype(np.int64) % n
            # Sums of 32-bit numbers are exact in doubles, for up to two million words.
            one, two, told_by = (np.bincount(block, x[at], len(here) * n).astype(np.uint64) for x in (low, high, tells))
            place = np.tile(np.arange(n, dtype=np.uint64), len(here)) + np.uint64(n << 32)
            found = mix(one + mix(two + mix(place)))
            strength = (told_by << np.uint64(32) | found >> np.uint64(32)).reshape(-1, n)
            chosen = np.argpartition(strength, n - kept - 1, axis=1)[:, n - kept :] if n > kept else np.tile(np.arange(n), (len(here), 1))
            lines.append(np.repeat(here, kept))
            hashes.append(found[(chosen + np.arange(len(here))[:, None] * n).ravel()])
        return np.concatenate(lines), np.concatenate(hashes)

    def blocks(self, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lines and hashes of all their blocks, those of the SimHash included."""
        line, found = self.word_blocks(level)
        shape = self.simhashes().astype(np.uint64) + (np.arange(1, BLOCKS + 1, dtype=np.uint64) << np.uint64(32))
        return np.concatenate([line, np.repeat(np.arange(len(self.size)), BLOCKS)]), np.concatenate([found, mix(shape.ravel())])

    def simhashes(self) -> np.ndarray:
        """Four 32-bit blocks per line: each bit is that of most of its words.

        A word's later occurrences count as words of their own; else the few most
        frequent words of a language would decide, alike in all of its long lines.
        """
        starts = np.cumsum(self.size) - self.size
        told, _ = self.told
        octets = np.stack([mix(told + np.uint64(11)), mix(told ^ np.uint64(0x5851F42D4C957F2D))], axis=1).view(np.uint8)
        out = np.zeros((len(self.size), 16), dtype=np.uint8)
        reach, i = np.cumsum(self.size), 0
        while i < len(self.size):
            j = max(i + 1, int(np.searchsorted(reach, (reach[i - 1] if i else 0) + _WORDS_AT_ONCE, side="right")))
            size = self.size[i:j]
            begin = np.cumsum(size) - size
            # Eight bits are counted at once, in the bytes of one number: for up to 255 words.
            runs = -(-size // 255)
            begin_run = np.cumsum(runs) - runs
            within = np.arange(int(runs.sum())) - np.repeat(begin_run, runs)
            part = octets[starts[i] : starts[i] + int(size.sum())]
            counts = np.add.reduceat(_SPREAD[part], np.repeat(begin, runs) + 255 * within, axis=0)
            ones = np.add.reduceat(counts.view(np.uint8).astype(np.int32), begin_run, axis=0)
            out[i:j] = np.packbits(2 * ones > size[:, None], axis=1)
            i = j
        return out.view("<u4")


def size_ranges(most: int) -> Iterator[tuple[int, int, int]]:
    """Overlapping ranges of sizes, and one more than the words in which similar lines there differ.

    The smaller of two similar lines lies in one range before the next one's beginning;
    the larger one, of at most 11 / 9 its words, lies there too.
    """
    least = LEAST_WORDS
    while least <= most:
        following = max(least + 1, least * STEP_TENTHS // 10)
        last = (following - 1) * 11 // 9
        yield least, last, (following - 1 + last) // 10 + 1
        least = following


def _counter(told: np.ndarray) -> np.ndarray:
    return (told % np.uint64(_COUNTERS)).astype(np.int64)


def word_levels(docs: DataFrame) -> np.ndarray:
    """Eight times the bits that a word of each hash value tells, by how often it occurs.

    Each task's counts are summed with those of fifteen others, and so on.
    """
    width = _COUNTERS // _PIECES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_COUNTERS, dtype=np.int64)
        for part in blocks(batches, "text", TEXT_BYTES):
            total += np.bincount(_counter(Lines(part.column("text"), LEAST_WORDS).told[0]), minlength=_COUNTERS)
        if total.any():
            task = TaskContext.get().partitionId()
            rows = [total[i : i + width].tobytes() for i in range(0, _COUNTERS, width)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(_PIECES), pa.int32()), pa.array([task] * _PIECES, pa.int32()), pa.array(rows, pa.binary())],
                ["piece", "task", "n"],
            )

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(width, dtype=np.int64)
        for row in table.column("n").to_pylist():
            total += np.frombuffer(row, dtype=np.int64)
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([key[1].as_py()], pa.int32()), "n": [total.tobytes()]})

    schema = "piece int, task int, n binary"
    counts = materialize(docs.select("text").mapInArrow(count, schema), "word-counts")
    while (counts.agg(F.max("task")).first()[0] or 0) > 0:
        groups = counts.withColumn("task", F.floor(F.col("task") / _FAN_IN).cast("int")).groupBy("piece", "task")
        counts = materialize(groups.applyInArrow(add, schema), "word-counts")
    # At most _PIECES rows, 4 MB in all.
    total = np.zeros(_COUNTERS, dtype=np.int64)
    for row in counts.collect():
        total[row.piece * width : (row.piece + 1) * width] = np.frombuffer(row.n, dtype=np.int64)
    bits = np.log2(max(1, total.sum()) / np.maximum(total, 1))
    return np.clip(np.round(8 * bits), 1, 255).astype(np.uint8)


def _block_lines(batches: Iterator[pa.RecordBatch], level: np.ndarray, parts: int) -> Iterator[tuple]:
    """Lines that may have near copies, each once a batch: keys, and their blocks' lines, parts and names."""
    for part in blocks(batches, "text", TEXT_BYTES):
        lines = Lines(part.column("text"), LEAST_WORDS)
        one, two = lines.keys()
        _, once = np.unique(one, return_index=True)
        lines.leave(once)
        if len(once):
            line, found = lines.blocks(level)
            yield lines, one[once], two[once], line, (found & np.uint64(0xFFFFFFFF)).astype(np.int64) % parts, (found >> np.uint64(32))


def _send_bare(batches: Iterator[pa.RecordBatch], level: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for lines, one, _, line, part, rest in _block_lines(batches, level, parts):
        rows = np.empty(len(line), dtype=_BARE)
        rows["rest"], rows["line"] = rest, one[line] & np.uint64(0xFFFFFFFF)
        rows["parity"] = lines.parities(32).view("<u4").ravel()[line]
        # Of lines that long, 32 parity bits rule out nothing, and a size cut short stays possible.
        rows["size"] = np.minimum(lines.size[line], 255)
        held.append((part, rows))
        # Many at a time, so that parts get rows of some length.
        if sum(len(x) for x, _ in held) >= _SENT_AT_ONCE:
            yield _packed(*map(np.concatenate, zip(*held)))
            held = []
    if held:
        yield _packed(*map(np.concatenate, zip(*held)))


def _packed(part: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """One row per part, with all its rows as bytes."""
    order = np.argsort(part, kind="stable")
    here, begin = np.unique(part[order], return_index=True)
    rows, ends = rows[order], [*begin[1:].tolist(), len(order)]
    packed = [rows[i:j].tobytes() for i, j in zip(begin.tolist(), ends)]
    return pa.RecordBatch.from_arrays([pa.array(here), pa.array(packed, pa.binary())], ["part", "rows"])


def _by_part(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[tuple[int, np.ndarray]]:
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for part, rows in zip(batch.column("part").to_pylist(), batch.column("rows").to_pylist()):
            held.setdefault(part, []).append(rows)
    while held:
        part, rows = held.popitem()
        yield part, np.frombuffer(b"".join(rows), dtype=kind)


def _possible(name: np.ndarray, parity: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which rows, sorted by name, share it with one of possible size and parity. All of a long block do."""
    found = np.zeros(len(name), dtype=bool)
    left, i = np.arange(len(name)), 0
    while len(left) and i < TESTED:
        i += 1
        left = left[left + i < len(name)]
        left = left[name[left] == name[left + i]]
        other = left + i
        sizes = size[left] + size[other]
        apart = np.bitwise_count(parity[left] ^ parity[other]).sum(axis=1, dtype=np.int64)
        near = (10 * np.abs(size[left] - size[other]) <= sizes) & (10 * apart <= sizes)
        found[left[near]] = found[other[near]] = True
    if len(left):
        found |= np.isin(name, name[left])
    return found


def _read_bare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, rows in _by_part(batches, _BARE):
        # A line of several batches is one line.
        _, at = np.unique(rows["rest"].astype(np.uint64) << np.uint64(32) | rows["line"], return_index=True)
        rows = rows[at]
        rows = rows[_possible(rows["rest"], rows["parity"][:, None], rows["size"].astype(np.int64))]
        key = rows["rest"].astype(np.int64) + (part << 32)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(rows["line"].copy().view(np.int32))], ["key", "line"])


def _send_full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = batch.column("key").to_numpy()
        rows = np.empty(len(key), dtype=_FULL)
        rows["rest"] = key & 0xFFFFFFFF
        for name in ("k0", "k1", "size"):
            rows[name] = batch.column(name).to_numpy()
        for i, name in enumerate(_PARITY):
            rows["parity"][:, i] = batch.column(name).to_numpy().view(np.uint64)
        yield _packed(key >> 32, rows)


def _read_full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, rows in _by_part(batches, _FULL):
        rows = rows[np.lexsort((rows["k1"], rows["k0"], rows["rest"]))]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows["rest"][1:] != rows["rest"][:-1]) | (rows["k0"][1:] != rows["k0"][:-1]) | (rows["k1"][1:] != rows["k1"][:-1])
        rows = rows[new]
        rows = rows[_possible(rows["rest"], rows["parity"], rows["size"].astype(np.int64))]
        key = rows["rest"].astype(np.int64) + (part << 32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key),
                *(pa.array(rows[name].astype(np.int64)) for name in ("k0", "k1", "size")),
                *(pa.array(signed(rows["parity"][:, i].copy())) for i in range(len(_PARITY))),
            ],
            ["key", "k0", "k1", "size", *_PARITY],
        )


def _read_blocks(batches: Iterator[pa.RecordBatch], level: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    for lines, one, two, line, part, rest in _block_lines(batches, level, parts):
        parity = lines.parities(64 * len(_PARITY)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((part << 32) + rest.astype(np.int64)),
                pa.array((one & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)[line]),
                pa.array(signed(one)[line]),
                pa.array(signed(two)[line]),
                pa.array(lines.size[line]),
                *(pa.array(parity[line, i]) for i in range(len(_PARITY))),
            ],
            ["key", "line", "k0", "k1", "size", *_PARITY],
        )


def block_members(known: DataFrame, words_held: int) -> DataFrame:
    """key, k0, k1, size, p0 to p3: blocks with two or more lines that may be similar, and these lines, stored."""
    sc = known.sparkSession.sparkContext
    level = sc.broadcast(word_levels(known))
    texts = known.select("text")
    # A line of n words has some 0.4 * n blocks, and four of the SimHash.
    parts = max(sc.defaultParallelism, words_held // 2 * _BARE.itemsize // BARE_BYTES)
    bare = texts.mapInArrow(lambda batches: _send_bare(batches, level.value, parts), "part long, rows binary")
    shared = materialize(bare.repartition(parts, "part").mapInArrow(_read_bare, "key long, line int"), "shared-blocks")
    rows = texts.mapInArrow(lambda batches: _read_blocks(batches, level.value, parts), f"key long, line int, {_MEMBER}")
    # What passes the filter by chance is dropped by the second test, as it has no partner.
    rows = blooms.reduce_by_list(rows, shared, ["key", "line"], shared.count()).mapInArrow(_send_full, "part long, rows binary")
    rows = rows.repartition(parts, "part").mapInArrow(_read_full, f"key long, {_MEMBER}")
    return materialize(rows, "block-members")


def _read_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in blocks(batches, "text", TEXT_BYTES):
        lines = Lines(part.column("text"))
        if not len(lines.size):
            continue
        one, two = lines.keys()
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id").take(pa.array(lines.text)),
                part.column("digest").take(pa.array(lines.text)),
                pa.array(lines.number.astype(np.int32)),
                pa.array(signed(one)),
                pa.array(signed(two)),
                pa.array(lines.size.astype(np.int32)),
            ],
            ["doc_id", "digest", "line", "k0", "k1", "size"],
        )


def _read_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of every line that may have near copies, as 32 bits each, under the line's key."""
    for part in blocks(batches, "text", TEXT_BYTES):
        lines = Lines(part.column("text"), LEAST_WORDS)
        one, two = lines.keys()
        _, once = np.unique(one, return_index=True)
        lines.leave(once)
        one, two = one[once], two[once]
        short = (lines.words >> np.uint64(32)).astype(np.uint32)
        rows = [short[f : f + n].tobytes() for f, n in zip(lines.first.tolist(), lines.size.tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(one)), pa.array(signed(two)), pa.array(rows, pa.binary())],
            ["k0", "k1", "labels"],
        )


def common_words(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, all columns of a row at once in one integer."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    # Words that `a` lacks change nothing.
    for held in filter(None, map(places.get, b)):
        hit = row & held
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def edit_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """2 * LCS / (n + m) of two word sequences; equal ends are set aside first."""
    n, m = len(a), len(b)
    if n + m == 0:
        return 1.0
    short = min(n, m)
    differs = np.flatnonzero(a[:short] != b[:short])
    head = int(differs[0]) if len(differs) else short
    differs = np.flatnonzero(a[n - short + head :][::-1] != b[m - short + head :][::-1])
    tail = int(differs[0]) if len(differs) else short - head
    inner = common_words(a[head : n - tail].tolist(), b[head : m - tail].tolist())
    return 2 * (head + tail + inner) / (n + m)


def _numbered(sequence: np.ndarray) -> np.ndarray:
    """Words told apart by how often they have occurred before."""
    sequence = sequence.astype(np.uint64)
    seen = runs_of(sequence, np.zeros(len(sequence), dtype=np.int64)).astype(np.uint64)
    return mix(sequence + seen * np.uint64(0x9E3779B97F4A7C15))


LINK = Similarity(
    similar=lambda a, b: edit_similarity(a, b) >= SIMILARITY,
    labels=_numbered,
    slack=1 - SIMILARITY,
    size_ratio=SIMILARITY / (2 - SIMILARITY),
    width=np.uint32,
)


def _with_digest(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))


def _may_be_similar(a: str, b: str) -> Column:
    both = F.col(f"{a}size") + F.col(f"{b}size")
    apart = sum((F.bit_count(F.col(f"{a}{p}").bitwiseXOR(F.col(f"{b}{p}"))) for p in _PARITY), F.lit(0))
    return (10 * F.abs(F.col(f"{a}size") - F.col(f"{b}size")) <= both) & (10 * apart <= both)


def distinct_blocks(members: DataFrame) -> DataFrame:
    """`members` with the size n of their block; of blocks that hold the same lines, one stays, and none of one line."""
    held = members.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("one"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("two")
    )
    once = held.where("n > 1").groupBy("n", "one", "two").agg(F.min("key").alias("key"))
    return members.join(once.select("key", "n"), "key")


def line_groups(members: DataFrame, features: Features) -> DataFrame:
    """(id, root) of all lines linked to another one; root is the lowest id of the group.

    `members`: key, id, size, p0 to p3, one row per block and line, stored. Lines are compared
    with the centre of their block, the line with the most company in all its blocks. Lines
    of another group than the centre's are then compared with all lines of the block that
    neither this group nor their sizes and parity bits rule out; so no link is lost.
    """
    members = materialize(distinct_blocks(members), "distinct-blocks")
    company = materialize(members.groupBy("id").agg(F.sum("n").alias("score")), "company")
    members = members.drop("n")
    centres = members.join(company, "id").groupBy("key").agg(F.max(F.struct("score", "id", "size", *_PARITY)).alias("top"))
    centres = centres.select("key", *(F.col(f"top.{name}").alias(f"b_{name}") for name in ("id", "size", *_PARITY)))
    centres = materialize(centres, "centres")
    around = members.join(centres, "key").where("id != b_id").where(_may_be_similar("", "b_"))
    around = materialize(around.select(F.least("id", "b_id").alias("a"), F.greatest("id", "b_id").alias("b")).distinct(), "around")
    known = LINK.read(features(around.select(F.col("a").alias("id")).union(around.select("b")).distinct()), "features")
    roots = materialize(components(LINK.links(around, known, "around-possible")), "roots")

    rooted = members.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    main = centres.join(roots, F.col("b_id") == F.col("id"), "left").select("key", F.coalesce("root", "b_id").alias("main"))
    rooted = materialize(rooted.join(main, "key").select("key", "id", "size", *_PARITY, "root", "main"), "rooted")
    apart = rooted.where("root != main").select("key", *(F.col(x).alias(f"o_{x}") for x in ("id", "size", *_PARITY, "root")))
    # Of two lines that are both of other groups than the centre's, the lower one asks.
    asked = (F.col("root") != F.col("o_root")) & ((F.col("root") == F.col("main")) | (F.col("o_id") < F.col("id")))
    more = apart.join(rooted, "key").where(asked & _may_be_similar("", "o_"))
    more = materialize(more.select(F.least("id", "o_id").alias("a"), F.greatest("id", "o_id").alias("b")).distinct(), "more-pairs")
    further = more.select(F.col("a").alias("id")).union(more.select("b")).distinct().join(known.select("id"), "id", "left_anti")
    known = known.unionByName(LINK.read(features(further), "more-features"))
    second = materialize(LINK.links(more, known, "more-possible"), "more-links")
    return components(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(second))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, digest, lines: numbers of the lines to drop, for documents that have any.

    `digest` is the hash of the text, so that a doc_id with several texts is
    several documents. The first occurrence of a group, by doc_id, digest and
    line number, stays.
    """
    prepare(docs.sparkSession)
    known = _with_digest(docs).where("text is not null")
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)])
    for name in ("digest", "line", "k0", "k1", "size"):
        schema = schema.add(name, T.IntegerType() if name in ("line", "size") else T.LongType())
    occurrences = materialize(known.mapInArrow(_read_lines, schema), "lines")
    members = block_members(known, occurrences.agg(F.sum("size")).first()[0] or 0)
    near = members.select("k0", "k1").distinct().select(F.monotonically_increasing_id().alias("id"), "k0", "k1")
    near = materialize(near, "near-lines")
    by_line = occurrences.groupBy("k0", "k1").agg(F.min(F.struct("doc_id", "digest", "line")).alias("first"), F.count("*").alias("n"))
    again = by_line.join(near, ["k0", "k1"], "left").where("n > 1 or id is not null")
    again = materialize(again, "repeated")

    def features(wanted: DataFrame) -> DataFrame:
        # Equal keys are equal words: any occurrence will do, and the first one's document has it.
        listed = again.where("id is not null").join(wanted, "id", "left_semi")
        listed = materialize(listed.select("id", "k0", "k1", F.col("first.doc_id").alias("doc_id")), "listed-lines")
        texts = known.select("doc_id", "text").where("doc_id is null").union(
            narrow(known.select("doc_id", "text").where("doc_id is not null"), listed.select("doc_id").distinct(), ["doc_id"])
        )
        found = texts.mapInArrow(_read_words, "k0 long, k1 long, labels binary")
        found = narrow(found, listed.select("k0", "k1"), ["k0", "k1"], KEYS_SENT).dropDuplicates(["k0", "k1"])
        return found.join(listed, ["k0", "k1"]).select("id", "labels")

    members = materialize(members.join(near, ["k0", "k1"]).select("key", "id", "size", *_PARITY), "members")
    groups = materialize(line_groups(members, features), "line-groups")
    grouped = materialize(again.where("id is not null").select("id", "first").join(groups, "id"), "grouped-lines")
    stays = grouped.groupBy("root").agg(F.min("first").alias("stays"))
    firsts = again.join(groups, "id", "left").join(stays, "root", "left").where("n > 1 or root is not null")
    firsts = materialize(firsts.select("k0", "k1", F.coalesce("stays", "first").alias("stays")), "first-lines")
    here = F.struct("doc_id", "digest", "line")
    dropped = occurrences.select("doc_id", "digest", "line", "k0", "k1").join(firsts, ["k0", "k1"]).where(
        ~here.eqNullSafe(F.col("stays"))
    )
    return dropped.groupBy("doc_id", "digest").agg(F.collect_set("line").alias("lines"))


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lists = batch.column("text").to_pylist(), batch.column("__lines").to_pylist()
        for i, numbers in enumerate(lists):
            if numbers:
                gone = set(numbers)
                texts[i] = "\n".join(x for j, x in enumerate(texts[i].split("\n")) if j not in gone)
        at = batch.schema.get_field_index("text")
        names = [n for n in batch.schema.names if n != "__lines"]
        yield batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type)).select(names)


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """`docs` with the later occurrences of repeated lines taken out of `text`.

    Lines end at \\n. Lines without a word, null texts and texts without repeated lines
    stay as they are; a text whose lines all occur elsewhere becomes empty. The column
    `__removed` tells how many lines went; one that `docs` has by that name is replaced.
    """
    docs = docs.drop("__removed")
    dropped = materialize(repeated_lines(docs), "dropped-lines")
    n_docs, n_lines = dropped.agg(F.count("*"), F.sum(F.size("lines"))).first()
    if n_docs <= DOCS_SENT and (n_lines or 0) <= NUMBERS_SENT:
        dropped = F.broadcast(dropped)
    dropped = dropped.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__key"), F.col("lines").alias("__lines"))
    match = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
    plain = set_aside(docs)
    joined = plain.join(dropped, match, "left").select(
        *plain.columns, F.coalesce(F.size("__lines"), F.lit(0)).alias("__removed"), "__lines"
    )
    schema = T.StructType([f for f in joined.schema.fields if f.name != "__lines"])
    return joined.mapInArrow(_without_lines, schema).toDF(*docs.columns, "__removed")
