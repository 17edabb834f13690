"""SentencePiece encoding and decoding with a suffix array.

The distinct new units of a block (words with the blanks before them, which no
piece crosses) are laid end to end and indexed by a suffix array. Every piece of
the vocabulary is looked up in it by binary search, which yields all places where
it occurs: the edges of a graph over text positions. Edges are sorted by where
they end and relaxed in that order, in step for all units.

The model's pieces were learned by pair merging, so the best path is the one the
merges take, not the one of the highest sum of scores. Two facts make it a
relaxation all the same: a prefix of a merged sequence is itself the merged
sequence of its text, and a sequence is merged correctly if every neighbouring
pair is. So each position has one valid incoming edge: the piece that fits the
last piece of the position where it starts. Two pieces fit if undoing their
merges, latest first, never meets an earlier merge across their border.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from twinledger.llm import units
from twinledger.llm.textblocks import blocks, prepare, text_bytes

SPACE = "▁"
# Kinds of pieces in model files (fixed values of the format).
NORMAL, BYTE = 1, 6
_END = 0x110000
_NEVER = np.iinfo(np.int64).max
#: Edges, suffix array and paths of a block take some 100 bytes for each of its new bytes.
BLOCK_BYTES = 1 << 20


class PieceModel:
    """Pieces, ranks and merges of a pair-merged model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.trainer_spec.model_type != pb.TrainerSpec.BPE or proto.normalizer_spec.precompiled_charsmap:
            raise ValueError("only pair-merged models without a character map are known")
        if proto.normalizer_spec.remove_extra_whitespaces or not proto.normalizer_spec.escape_whitespaces:
            raise ValueError("only models that keep and escape blanks are known")
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        texts = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.n_ids = len(proto.pieces)
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
        # Characters inside pieces that are no pieces themselves get numbers past the ids.
        for c in sorted({c for text in texts for c in text} - texts.keys()):
            texts[c] = self.n_ids + sum(1 for i in texts.values() if i >= self.n_ids)
        self.texts = texts
        size = max(texts.values()) + 2
        self.unknown = size - 1
        scores = sorted({proto.pieces[i].score for t, i in texts.items() if len(t) > 1}, reverse=True)
        place = {score: r for r, score in enumerate(scores)}
        self.rank = np.full(size, -1, dtype=np.int64)
        for text, i in texts.items():
            if len(text) > 1:
                self.rank[i] = place[proto.pieces[i].score]
        self.width = np.int64(size)
        pairs = {
            (texts[text[:k]], texts[text[k:]]): i
            for text, i in texts.items()
            for k in range(1, len(text))
            if text[:k] in texts and text[k:] in texts
        }
        keys = np.array([a * size + b for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = self.rank[np.array(list(pairs.values()))[order]]
        self.left = np.arange(size, dtype=np.int64)
        self.right = np.arange(size, dtype=np.int64)
        usable = []
        for text, i in texts.items():
            if len(text) == 1:
                if i < self.n_ids:
                    usable.append((text, i))
                continue
            split = self._last_merge(text, pairs)
            if split:
                self.left[i], self.right[i] = split
                usable.append((text, i))
        self._set_pieces(usable)
        self.surface = [p.piece.encode("utf-8") if p.type == NORMAL else b"" for p in proto.pieces]
        for b, i in enumerate(self.byte_ids.tolist()):
            self.surface[i] = bytes([b])
        spaced = [s.replace(SPACE.encode(), b" ") for s in self.surface]
        self.surface_ends = np.cumsum([len(s) for s in spaced])
        self.surface_bytes = np.frombuffer(b"".join(spaced), dtype=np.uint8)

    def _last_merge(self, text: str, pairs: dict) -> tuple[int, int] | None:
        """The pair that the merges of a piece's own text end with; None if they don't make it."""
        symbols = [self.texts[c] for c in text]
        while len(symbols) > 2:
            found = [
                (self.rank[pairs[pair]], i)
                for i, pair in enumerate(zip(symbols, symbols[1:]))
                if pair in pairs
            ]
            if not found:
                return None
            _, i = min(found)
            symbols[i : i + 2] = [pairs[symbols[i], symbols[i + 1]]]
        return (symbols[0], symbols[1]) if len(symbols) == 2 and tuple(symbols) in pairs else None

    def _set_pieces(self, usable: list[tuple[str, int]]) -> None:
        self.piece_ids = np.array([i for _, i in usable], dtype=np.int64)
        self.piece_lengths = np.array([len(t) for t, _ in usable], dtype=np.int64)
        self.longest = int(self.piece_lengths.max())
        self.chars = np.full((len(usable), self.longest), _END, dtype=np.int32)
        for row, (text, _) in enumerate(usable):
            self.chars[row, : len(text)] = [ord(c) for c in text]
        self.single = np.array(sorted(ord(t) for t, _ in usable if len(t) == 1), dtype=np.int32)

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the merges leave these neighbours apart."""
        ok = np.ones(len(left), dtype=bool)
        at = np.arange(len(left))
        a, b = left.astype(np.int64), right.astype(np.int64)
        limit = np.full(len(left), _NEVER)
        while len(at):
            keys = a * self.width + b
            place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            merged = np.where(self.pair_keys[place] == keys, self.pair_ranks[place], _NEVER)
            crossed = merged < limit
            ok[at[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            going = ~crossed & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb = at[going], a[going], b[going], ra[going], rb[going]
            # The later merge is undone; of equal ones the right, as merges go from the left.
            of_a = ra > rb
            limit = np.where(of_a, ra, rb + 1)
            a, b = np.where(of_a, self.right[a], a), np.where(of_a, b, self.left[b])
        return ok


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the `depth` characters that start there, by doubling."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, reach = np.argsort(rank, kind="stable"), 1
    while reach < depth:
        ahead = np.zeros(len(rank), dtype=np.int64)
        ahead[:-reach] = rank[reach:] + 1
        key = rank * (len(rank) + 1) + ahead
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(len(rank), dtype=np.int64)
        rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
        reach *= 2
    return order


def occurrences(text: np.ndarray, order: np.ndarray, model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """For every piece, its range in the suffix array; one character at a time, all pieces at once."""
    low = np.zeros(len(model.piece_ids), dtype=np.int64)
    high = np.full(len(model.piece_ids), len(order), dtype=np.int64)
    padded = np.append(text, np.full(model.longest, -1, dtype=text.dtype))
    for d in range(model.longest):
        alive = np.flatnonzero((model.piece_lengths > d) & (low < high))
        if not len(alive):
            break
        wanted = model.chars[alive, d]
        bounds = []
        for after in (False, True):
            a, b = low[alive].copy(), high[alive].copy()
            while True:
                open_ = a < b
                if not open_.any():
                    break
                middle = (a + b) // 2
                seen = padded[order[np.minimum(middle, len(order) - 1)] + d]
                right = (seen <= wanted) if after else (seen < wanted)
                a = np.where(open_ & right, middle + 1, a)
                b = np.where(open_ & ~right, middle, b)
            bounds.append(a)
        low[alive], high[alive] = bounds
    return low, high


def encode_units(found: list[bytes], model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and ids of units, blanks given as U+0020 or U+2581."""
    texts = [u.decode("utf-8").replace(" ", SPACE) for u in found]
    # Units are kept apart by a character that no text has.
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.full(int((sizes + 1).sum()), _END, dtype=np.int32)
    inside = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(texts)), sizes)
    text[inside] = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.int32)
    order = suffix_array(text, model.longest)
    low, high = occurrences(text, order, model)
    n = high - low
    total = int(n.sum())
    rows = np.repeat(np.arange(len(n)), n)
    begin = order[np.arange(total) - np.repeat(np.cumsum(n) - n, n) + low[rows]]
    piece, end = model.piece_ids[rows], begin + model.piece_lengths[rows]
    strange = inside[~np.isin(text[inside], model.single)]
    begin = np.concatenate([begin, strange])
    piece = np.concatenate([piece, np.full(len(strange), model.unknown)])
    end = np.concatenate([end, strange + 1])

    # Edges by how far into their unit they end, then by place.
    unit = np.searchsorted(starts, begin, side="right") - 1
    step = end - starts[unit]
    by_step = np.lexsort((end, step))
    begin, piece, end, step = begin[by_step], piece[by_step], end[by_step], step[by_step]
    last = np.full(len(text) + 1, -1, dtype=np.int64)
    came = np.full(len(text) + 1, -1, dtype=np.int64)
    at_start = np.zeros(len(text) + 1, dtype=bool)
    at_start[starts] = True
    edges = np.flatnonzero(np.append(True, step[1:] != step[:-1])) if len(step) else np.zeros(0, dtype=np.int64)
    for i, j in zip(edges.tolist(), [*edges[1:].tolist(), len(step)]):
        b, p, e = begin[i:j], piece[i:j], end[i:j]
        first = at_start[b]
        good = first.copy()
        inner = np.flatnonzero(~first & (last[b] >= 0))
        good[inner] = model.fits(last[b[inner]], p[inner])
        last[e[good]] = p[good]
        came[e[good]] = b[good]

    # Back along the edges, in step for all units; places are then put in order.
    place, chosen, owner = [], [], []
    here, who = starts + sizes, np.arange(len(texts))
    while True:
        going = here > starts[who]
        here, who = here[going], who[going]
        if not len(here):
            break
        place.append(here)
        chosen.append(last[here])
        owner.append(who)
        here = came[here]
        if (here < 0).any():
            raise ValueError("a position of a text was not reached")
    if not place:
        return np.zeros(len(texts), dtype=np.int64), np.zeros(0, dtype=np.int32)
    where = np.concatenate(place)
    forward = np.argsort(where)
    where, ids, who = where[forward], np.concatenate(chosen)[forward], np.concatenate(owner)[forward]
    counts = np.ones(len(ids), dtype=np.int64)
    outside = np.flatnonzero(ids >= model.n_ids)
    if len(outside):
        spelled = [chr(c).encode("utf-8") for c in text[where[outside] - 1].tolist()]
        counts[outside] = [len(s) for s in spelled]
        flat = np.repeat(ids, counts)
        spots = np.repeat((np.cumsum(counts) - counts)[outside], counts[outside])
        runs = counts[outside]
        spots = spots + np.arange(len(spots)) - np.repeat(np.cumsum(runs) - runs, runs)
        flat[spots] = model.byte_ids[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
        ids = flat
    lengths = np.bincount(np.repeat(who, counts), minlength=len(texts))
    return lengths.astype(np.int64), ids.astype(np.int32)


@lru_cache(maxsize=2)
def _model(path: str) -> PieceModel:
    return PieceModel(path)


@lru_cache(maxsize=2)
def _memory(path: str) -> units.UnitMemory:
    model = _model(path)
    return units.UnitMemory(lambda found: encode_units(found, model))


def encode_block(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids per text and all ids of a block."""
    raw, offsets = text_bytes(texts)
    if _model(path).prefix:
        full = np.diff(offsets) > 0
        raw = np.insert(raw, offsets[:-1][full], 32)
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
    memory = _memory(path)
    starts = units.cut_before_spaces(raw, offsets)
    rows = memory.rows(raw, starts, np.append(starts[1:], len(raw)))
    return units.per_text(memory.store.lengths(rows), starts, offsets), memory.store.gather(rows)


def decode_block(counts: np.ndarray, ids: np.ndarray, path: str) -> list[str]:
    """Texts of id sequences. Ids outside the vocabulary and control pieces are nothing;
    bytes that are not UTF-8 become U+FFFD."""
    model = _model(path)
    known = (ids >= 0) & (ids < model.n_ids)
    ends = np.where(known, model.surface_ends[np.where(known, ids, 0)], 0)
    begins = np.where(known & (ids > 0), model.surface_ends[np.where(known, ids, 0) - 1], 0)
    begins = np.where(known, begins, 0)
    sizes = ends - begins
    total = int(sizes.sum())
    data = model.surface_bytes[np.arange(total) + np.repeat(begins - np.cumsum(sizes) + sizes, sizes)].tobytes()
    reach = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    out = [data[s:e].decode("utf-8", "replace") for s, e in zip(reach, reach[1:])]
    return [t[1:] if model.prefix and t.startswith(" ") else t for t in out]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """The columns of `docs` but `text`, with `ids` in its place. Null and empty texts have no ids."""
    prepare(docs.sparkSession)
    fields = [
        T.StructField("ids", T.ArrayType(T.IntegerType())) if f.name == "text" else f for f in docs.schema.fields
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "text", BLOCK_BYTES):
            counts, ids = encode_block(part.column("text"), path)
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            at = part.schema.get_field_index("text")
            columns = [c if i != at else pa.ListArray.from_arrays(ends, pa.array(ids)) for i, c in enumerate(part.columns)]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.mapInArrow(run, T.StructType(fields))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The columns of `encoded` but `ids`, with `text` in its place. Null ids are none."""
    prepare(encoded.sparkSession)
    fields = [T.StructField("text", T.StringType()) if f.name == "ids" else f for f in encoded.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            lists = batch.column(at)
            counts = np.array([len(x) if x.is_valid else 0 for x in lists], dtype=np.int64)
            texts = decode_block(counts, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), path)
            columns = [c if i != at else pa.array(texts, pa.string()) for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return encoded.mapInArrow(run, T.StructType(fields))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32, n_chars, same: each text encoded, and decoded again.

    `same` tells whether decoding gives the text back (U+2581 reads as a blank).
    """
    prepare(docs.sparkSession)
    kinds = {"n_ids": T.LongType(), "ids_crc32": T.LongType(), "n_chars": T.LongType(), "same": T.BooleanType()}
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(n, k) for n, k in kinds.items())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "text", BLOCK_BYTES):
            counts, ids = encode_block(part.column("text"), path)
            again = decode_block(counts, ids.astype(np.int64), path)
            ends = np.cumsum(counts).tolist()
            raw = ids.astype("<u4")
            crcs = [zlib.crc32(raw[e - n : e].tobytes()) for e, n in zip(ends, counts.tolist())]
            texts = [(t or "").replace(SPACE, " ") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(counts),
                    pa.array(crcs, pa.int64()),
                    pa.array([len(t) for t in again], pa.int64()),
                    pa.array([a == b for a, b in zip(again, texts)], pa.bool_()),
                ],
                schema.fieldNames(),
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
