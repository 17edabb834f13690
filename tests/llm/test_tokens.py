"""Token operators against the libraries."""

import zlib

import cases
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from twinledger.llm import packing, pieces, queries, tokencount, units

SF_DIR = "/root/testdata/sf0.001"
ODD_TEXT = st.text(alphabet="abcTHE'st \n\t.,!<|endofx|>0159éè　 ́▁日🙂", max_size=40)


def texts_of(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def tokenizers():
    from tokenizers import Tokenizer

    return {name: Tokenizer.from_file(queries.tokenizer(name)) for name in ("word_bpe_49k.json", "byte_bpe_50k.json")}


@pytest.fixture(scope="module")
def processor():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))


def test_packed_ids_of_all_documents(spark, tokenizers):
    texts = texts_of(spark)
    found = queries.op4_packed_token_ids(spark, SF_DIR).orderBy("doc_id").collect()
    assert [r.doc_id for r in found] == sorted(texts)
    start = 0
    for row in found:
        ids = [*tokenizers["word_bpe_49k.json"].encode(texts[row.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31])
def test_packing_is_exact_and_random_access_reads_any_range(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 10_001).astype(np.uint32)
    block = packing.PackedIds(packing.pack(ids, bits, chunk=257))
    assert (block.ids(0, len(ids)) == ids).all()
    for start, n in ((0, 0), (256, 2), (257, 1), (9_000, 1_001), (10_001, 0)):
        assert (block.ids(start, n) == ids[start : start + n]).all()
    with pytest.raises(IndexError):
        block.ids(10_000, 2)
    with pytest.raises(ValueError):
        packing.pack(np.array([1 << bits], dtype=np.uint64), bits)


def test_bits_of_a_vocabulary():
    assert [packing.id_bits(n) for n in (1, 2, 3, 49_408, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD_TEXT, min_size=1, max_size=6))
def test_word_units_encode_as_whole_texts(tokenizers, texts):
    sizes, ids = packing.encode_texts(pa.array(texts), queries.tokenizer("word_bpe_49k.json"))
    whole = [e.ids for e in tokenizers["word_bpe_49k.json"].encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(x) for x in whole]
    assert ids.tolist() == [i for x in whole for i in x]


def test_token_counts_of_all_documents(spark, tokenizers):
    texts = texts_of(spark)
    for row in queries.op7_token_counts(spark, SF_DIR).collect():
        n = len(tokenizers["byte_bpe_50k.json"].encode(texts[row.doc_id] or "", add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(texts[row.doc_id].encode()), n, n > 512)


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD_TEXT, min_size=1, max_size=6))
def test_merged_arrays_count_as_the_library(tokenizers, texts):
    raw, offsets = tokencount.text_bytes(pa.array(texts))
    starts = units.cut_before_blanks(raw, offsets)
    memory = tokencount._memory(queries.tokenizer("byte_bpe_50k.json"))
    rows = memory.rows(raw, starts, np.append(starts[1:], len(raw)))
    found = units.per_text(memory.store.gather(rows), starts, offsets)
    whole = tokenizers["byte_bpe_50k.json"].encode_batch(texts, add_special_tokens=False)
    assert found.tolist() == [len(e.ids) for e in whole]


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD_TEXT, min_size=1, max_size=6))
def test_pieces_encode_and_decode_as_the_library(processor, texts):
    path = queries.tokenizer("piece_bpe_32k.model")
    counts, ids = pieces.encode_block(pa.array(texts), path)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == processor.encode(texts)
    assert pieces.decode_block(counts, ids.astype(np.int64), path) == [t.replace("▁", " ") for t in texts]


def test_pieces_of_all_documents(spark, processor):
    texts = texts_of(spark)
    for row in queries.op8_sentencepiece(spark, SF_DIR).collect():
        ids = processor.encode(texts[row.doc_id])
        assert (row.n_ids, row.ids_crc32, row.same) == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()), True)


def test_suffix_array_orders_suffixes():
    text = np.array([ord(c) for c in "banana|bandana|"], dtype=np.int32)
    order = pieces.suffix_array(text, 16)
    suffixes = ["".join(map(chr, text[i:])) for i in order]
    assert suffixes == sorted(suffixes)


def test_units_are_forgotten_beyond_the_bound(monkeypatch):
    seen = []
    memory = units.UnitMemory(lambda found: (seen.append(len(found)), (np.ones(len(found), int), np.arange(len(found))))[1])
    monkeypatch.setattr(units, "MEMORY_UNITS", 1)
    raw = np.frombuffer(b" a b a", dtype=np.uint8)
    starts = units.cut_before_spaces(raw, np.array([0, 6]))
    for _ in range(2):
        rows = memory.rows(raw, starts, np.append(starts[1:], 6))
        assert rows[0] == rows[2] != rows[1]
    assert seen == [2, 2]


def test_odd_documents(spark, odd, empty, processor):
    n = len(cases.rows())
    word, byte, piece = (queries.tokenizer(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
    packed = packing.packed_documents(odd, word, 2).collect()
    assert len(packed) == n and sorted(r.start for r in packed)[0] == 0
    assert packing.packed_documents(empty, word, 2).count() == 0
    assert {r.n_tokens for r in tokencount.count_tokens(odd, byte, 512).where("doc_id in (5, 6)").collect()} == {0}
    assert tokencount.count_tokens(empty, byte, 512).count() == 0
    encoded = pieces.encode(odd, piece)
    assert encoded.columns == [c if c != "text" else "ids" for c in odd.columns]
    back = {(r.doc_id, r.text) for r in pieces.decode(encoded, piece).collect()}
    assert back == {(i, (t or "").replace("▁", " ")) for i, t, *_ in cases.rows()}
    assert pieces.encode(empty, piece).count() == 0
