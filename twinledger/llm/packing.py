"""Token ids on disk, each in as few bits as the vocabulary needs.

A packed table is Parquet with one row per block of documents, in ascending
doc_id order: (shard, block, start, n_ids, doc_ids, doc_sizes, payload). The
payload is self-describing: a header (magic, bits, ids per chunk, ids in all),
the byte offset of every chunk, then the chunks, each padded to whole bytes. A
chunk can be unpacked alone, so any range of ids is read without the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm import units
from twinledger.llm.textblocks import _LOWER, blocks, prepare, text_bytes
from twinledger.session import scratch_path

MAGIC = 0x314B4950  # "PIK1"
CHUNK_IDS = 4096
BLOCK_IDS = 1 << 20
_HEADER = np.dtype([("magic", "<u4"), ("bits", "<u4"), ("chunk", "<u4"), ("n_chunks", "<u4"), ("n_ids", "<u8")])


def id_bits(vocabulary: int) -> int:
    """Bits that hold every id below `vocabulary`."""
    return max(1, (vocabulary - 1).bit_length())


def _pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits == 16:
        return ids.astype("<u2").tobytes()
    flags = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(flags.astype(np.uint8).ravel(), bitorder="little").tobytes()


def _unpack_bits(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    if bits == 16:
        return data[: 2 * n].view("<u2").astype(np.uint32)
    flags = np.unpackbits(data, count=n * bits, bitorder="little").reshape(n, bits)
    return flags.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


def pack(ids: np.ndarray, bits: int, chunk: int = CHUNK_IDS) -> bytes:
    """One block. Ids must be below 2 ** bits."""
    ids = np.asarray(ids, dtype=np.uint32)
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {ids.max()} does not fit in {bits} bits")
    parts = [_pack_bits(ids[i : i + chunk], bits) for i in range(0, len(ids), chunk)]
    header = np.zeros(1, dtype=_HEADER)
    header[0] = (MAGIC, bits, chunk, len(parts), len(ids))
    base = _HEADER.itemsize + 8 * (len(parts) + 1)
    offsets = base + np.cumsum([0, *map(len, parts)]).astype("<u8")
    return b"".join([header.tobytes(), offsets.astype("<u8").tobytes(), *parts])


class PackedIds:
    """Random access to a block's ids."""

    def __init__(self, payload: bytes):
        self.data = np.frombuffer(payload, dtype=np.uint8)
        head = np.frombuffer(payload, dtype=_HEADER, count=1)[0]
        if head["magic"] != MAGIC:
            raise ValueError("not a block of packed ids")
        self.bits, self.chunk, self.n_ids = int(head["bits"]), int(head["chunk"]), int(head["n_ids"])
        self.offsets = np.frombuffer(payload, dtype="<u8", count=int(head["n_chunks"]) + 1, offset=_HEADER.itemsize)

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids start .. start + n - 1; only the chunks that hold them are unpacked."""
        if start < 0 or n < 0 or start + n > self.n_ids:
            raise IndexError(f"{start} + {n} of {self.n_ids} ids")
        if n == 0:
            return np.zeros(0, dtype=np.uint32)
        low, high = start // self.chunk, (start + n - 1) // self.chunk
        parts = [
            _unpack_bits(
                self.data[int(self.offsets[c]) : int(self.offsets[c + 1])],
                min(self.chunk, self.n_ids - c * self.chunk),
                self.bits,
            )
            for c in range(low, high + 1)
        ]
        return np.concatenate(parts)[start - low * self.chunk :][:n]


@lru_cache(maxsize=2)
def _memory(path: str) -> tuple[units.UnitMemory, int]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lists = []
        for i in range(0, len(pieces), 2000):
            found = tokenizer.encode_batch_fast(
                [p.decode("utf-8") for p in pieces[i : i + 2000]], add_special_tokens=False
            )
            lists += [e.ids for e in found]
        lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        flat = np.fromiter((x for ids in lists for x in ids), dtype=np.int32, count=int(lengths.sum()))
        return lengths, flat

    return units.UnitMemory(encode), tokenizer.get_vocab_size(with_added_tokens=True)


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Token counts and all ids of a block of texts, for a tokenizer that drops blanks
    and ignores case (its normaliser lowers and its patterns skip blanks)."""
    memory, _ = _memory(path)
    raw, offsets = text_bytes(texts)
    starts = units.cut_words(raw, offsets)
    folded = raw if b"<|" in raw.tobytes() else _LOWER[raw]
    rows = memory.rows(raw, starts, np.append(starts[1:], len(raw)), folded)
    return units.per_text(memory.store.lengths(rows), starts, offsets), memory.store.gather(rows)


PACKED = "shard int, block int, start long, n_ids long, doc_ids array<{id}>, doc_sizes array<long>, payload binary"


def write_packed(
    docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, partitions: int | None = None
) -> None:
    """Encode `text` and write it in ascending doc_id order, nulls first, ties by text.

    Texts are sorted by range over the cluster; a task writes the blocks of its
    range as it goes and never holds more than one. A document lies in one block
    whole, so a single text must encode to under 2 GB.
    """
    spark = prepare(docs.sparkSession)
    bits = id_bits(max(vocabulary_size(tokenizer), (end_id or 0) + 1))
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(T._parse_datatype_string(PACKED.format(id=id_type.simpleString())).fields)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ["shard", "block", "start", "n_ids", "doc_ids", "doc_sizes", "payload"]

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        held_ids: list[pa.Array] = []
        held_sizes: list[np.ndarray] = []
        held: list[np.ndarray] = []
        count = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, start, held_ids, held_sizes, held, count
            ids, sizes = pa.concat_arrays(held_ids), np.concatenate(held_sizes)
            row = [
                pa.array([shard], pa.int32()),
                pa.array([block], pa.int32()),
                pa.array([start], pa.int64()),
                pa.array([count], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.array(sizes)),
                pa.array([pack(np.concatenate(held), bits)], pa.binary()),
            ]
            block, start = block + 1, start + count
            held_ids, held_sizes, held, count = [], [], [], 0
            return pa.RecordBatch.from_arrays(row, columns)

        for part in blocks(batches, "text"):
            sizes, ids = encode_texts(part.column("text"), tokenizer)
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                sizes = sizes + 1
            held_ids.append(part.column("doc_id"))
            held_sizes.append(sizes)
            held.append(ids)
            count += len(ids)
            if count >= BLOCK_IDS:
                yield flush()
        if held_ids:
            yield flush()

    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    )
    ordered.mapInArrow(pack_partition, schema).write.option("compression", "zstd").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a packed table: doc_id, start, n_tokens, ids_crc32.

    `start` counts the ids of all documents before it. It needs the shard sizes
    only: one row per written partition.
    """
    packed = prepare(spark).read.parquet(path)
    sizes = packed.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    bases = sizes.select(
        "shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base")
    )
    id_type = packed.schema["doc_ids"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("shard", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("doc_ids")[i].values
                sizes = batch.column("doc_sizes")[i].values.to_numpy(zero_copy_only=False)
                block = PackedIds(batch.column("payload")[i].as_py())
                ends = np.cumsum(sizes)
                values = block.ids(0, block.n_ids).astype("<u4")
                crcs = [zlib.crc32(values[e - n : e].tobytes()) for e, n in zip(ends.tolist(), sizes.tolist())]
                start = batch.column("start")[i].as_py() + ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.full(len(ids), batch.column("shard")[i].as_py(), dtype=np.int32)),
                        pa.array(start.astype(np.int64)),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(np.array(crcs, dtype=np.int64)),
                    ],
                    schema.fieldNames(),
                )

    # One payload per Arrow batch would be ideal; a few are still small.
    return (
        packed.select("shard", "start", "doc_ids", "doc_sizes", "payload")
        .mapInArrow(unpack, schema)
        .join(bases, "shard")
        .select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
    )


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int | None = None) -> DataFrame:
    """Write the documents to a packed table of their own and describe what it holds."""
    path = scratch_path(docs.sparkSession, "packed-ids")
    write_packed(docs, path, tokenizer, end_id)
    return read_documents(docs.sparkSession, path)
