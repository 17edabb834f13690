"""The pipeline's stages against brute force, each on its own input."""

from collections import Counter

import cases
import corpus_pipeline
import pytest
import sentencepiece

import __spark_entry__ as contract
from twinledger.llm import queries
from twinledger.session import materialize

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    names = contract.queries()
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 14)} == {
        name[: name.index("_") + 1] for name in names if name.startswith("op")
    }
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5


@pytest.fixture(scope="module")
def stages(spark):
    out = [queries.table(spark, SF_DIR, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF_DIR), name.replace(" ", "-")))
    return out


def test_stages_keep_what_their_operators_keep(spark, stages):
    documents, good, lines, lone, clean, encoded = stages
    for kept in (good, lines, lone, clean):
        assert kept.columns == documents.columns
    judged = {r.doc_id: r.kept for r in queries.op5_quality_rules(spark, SF_DIR).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, kept in judged.items() if kept}
    # Nothing is lost that occurs nowhere else.
    before, after = ({line for r in x.collect() for line in r.text.split("\n") if len(line.split()) >= 5} for x in (good, lines))
    assert after <= before
    repeated = Counter(line for r in lines.collect() for line in r.text.split("\n") if len(line.split()) >= 8)
    assert all(n == 1 for n in repeated.values())
    assert {r.doc_id for r in lone.collect()} <= {r.doc_id for r in lines.collect()}
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaking = {r.doc_id for r in lone.collect() if any(x in r.text for x in items)}
    left = {r.doc_id for r in clean.collect()}
    assert not leaking & left and len(left) >= lone.count() - len(leaking) - 3
    processor = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer(corpus_pipeline.TOKENIZER))
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert {r.doc_id: r.ids for r in encoded.collect()} == {i: processor.encode(t) for i, t in texts.items()}


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert {(r.doc_id, tuple(r.ids)) for r in found.collect()} == {(r.doc_id, tuple(r.ids)) for r in stages[-1].collect()}


def test_stages_stand_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF_DIR), "odd-stage")
    assert empty.count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF_DIR).count() <= len(cases.rows())
