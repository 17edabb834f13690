"""Token counts by byte-level BPE, merged for many pre-tokens at a time.

Distinct pre-tokens of a batch lie one after another in one array of symbols.
In each round every sequence applies its own lowest-ranked pair, at all places
at once; sequences without a known pair are done. The symbols left are counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from twinledger.llm import units
from twinledger.llm.textblocks import blocks, prepare, text_bytes

# The published splitting pattern of byte-level BPE (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NO_PAIR = np.iinfo(np.int32).max


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class RankedMerges:
    """The merge list as sorted arrays: pair -> rank and pair -> new symbol."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [m if isinstance(m, (list, tuple)) else m.split(" ") for m in merges]
        self.width = np.int64(max(vocab.values()) + 1)
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self.of_byte = np.array([vocab.get(c, -1) for _, c in sorted(byte_symbols().items())], dtype=np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NO_PAIR)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each piece once no pair can be merged."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        left_over = sizes.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        while len(symbols) > 1:
            joined = owner[1:] == owner[:-1]
            ranks = np.where(joined, self.rank(symbols[:-1], symbols[1:]), _NO_PAIR)
            ranks = np.append(ranks, _NO_PAIR)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(ranks, starts)
            # Finished sequences leave the arrays.
            sizes_now = np.diff(np.append(starts, len(symbols)))
            left_over[owner[starts]] = sizes_now
            going = np.repeat(lowest < _NO_PAIR, sizes_now)
            best = np.repeat(lowest, sizes_now)
            symbols, owner, ranks, best = symbols[going], owner[going], ranks[going], best[going]
            if not len(symbols):
                break
            chosen = ranks == best
            # In a run of overlapping pairs (aaa) every second one is taken, from the left.
            place = np.arange(len(chosen))
            last_free = np.maximum.accumulate(np.where(chosen, -1, place))
            chosen &= (place - last_free) % 2 == 1
            at = np.flatnonzero(chosen)
            symbols[at] = self.made[ranks[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if len(symbols):
            left_over[owner[0]] = len(symbols)
        return left_over


@lru_cache(maxsize=2)
def _memory(path: str) -> units.UnitMemory:
    import regex

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    merges = RankedMerges(spec["model"]["vocab"], spec["model"]["merges"])
    special = [t["content"].encode() for t in spec["added_tokens"]]
    split = regex.compile(PATTERN)
    cut = regex.compile(b"|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) or b"(?!)")

    def encode(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token count of each unit, as sequences of one number."""
        counts = np.zeros(len(found), dtype=np.int64)
        pieces: list[bytes] = []
        owners: list[int] = []
        for i, unit in enumerate(found):
            parts = [unit]
            if b"<|" in unit:
                counts[i] += len(cut.findall(unit))
                parts = cut.split(unit)
            for part in parts:
                mine = split.findall(part.decode("utf-8"))
                pieces += [p.encode("utf-8") for p in mine]
                owners += [i] * len(mine)
        if pieces:
            counts += np.bincount(owners, weights=merges.count(pieces), minlength=len(found)).astype(np.int64)
        return np.ones(len(found), dtype=np.int64), counts.astype(np.int32)

    return units.UnitMemory(encode)


def count_tokens(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; null texts count as empty.

    `path`: a byte-level BPE file in JSON form. Strings of its special tokens
    inside a text count as that one token.
    """
    prepare(docs.sparkSession)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(path)
        for part in blocks(batches, "text"):
            raw, offsets = text_bytes(part.column("text"))
            starts = units.cut_before_blanks(raw, offsets)
            rows = memory.rows(raw, starts, np.append(starts[1:], len(raw)))
            n = units.per_text(memory.store.gather(rows), starts, offsets)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)],
                schema.fieldNames(),
            )

    return docs.select("doc_id", "text").mapInArrow(count, schema)
