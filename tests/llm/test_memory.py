"""What a task that encodes holds at a time."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import public_tokenizers

from twinledger.llm import alignment, pieces
from twinledger.llm.textblocks import blocks


def test_memory_of_a_block_of_new_words():
    """In blocks of 8 MB, 681 MB were held at a time."""
    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    pieces.encode_block(pa.array(["a"]), path)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"{x:x}" for x in rng.integers(0, 1 << 40, 300)) for _ in range(1000)]
    tracemalloc.start()
    for part in blocks(iter([pa.record_batch({"text": pa.array(texts)})]), "text", pieces.BLOCK_BYTES):
        pieces.encode_block(part.column("text"), path)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 350 << 20


def test_memory_of_aligned_texts():
    """In blocks of 2 MB, 269 MB were held at a time."""
    paths = [str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    rng = np.random.default_rng(7)
    words = [f"{x:x}" for x in rng.integers(0, 1 << 28, 5000)]
    texts = [" ".join(words[i] for i in rng.zipf(1.3, 400) % 5000) for _ in range(2400)]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    assert batch.column("text").nbytes > 4 << 20
    alignment.align_texts(pa.array(["a b"]), *paths)
    tracemalloc.start()
    counts = []
    for part in blocks(iter([batch]), "text", alignment.BLOCK_BYTES):
        counts += alignment.align_texts(part.column("text"), *paths).n_links.tolist()
    _, peak = tracemalloc.get_traced_memory()
    assert peak < 100 << 20
    tracemalloc.reset_peak()
    (row,) = alignment.stored_blocks(iter([batch]), *paths, 1 << 30, 5)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 130 << 20
    assert row[0].to_pylist() == [5] and row[1][0].as_py() == list(range(len(texts)))
    assert row[5][0].as_py() == counts and sum(row[9][0].as_py()) == sum(counts)
