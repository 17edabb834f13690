"""The training-data pipeline: documents in, token ids of the kept ones out.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept; `run` stores each stage's rows and reads them again for the next. Null
texts fail the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.llm import decontaminate, linededup, neardup, pieces, quality
from twinledger.llm.queries import table, tokenizer
from twinledger.llm.textblocks import prepare
from twinledger.session import materialize

TOKENIZER = "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list reject."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occur earlier; those of which nothing is left go.

    n_chars of a shortened document is that of its new text.
    """
    prepare(spark)
    found = linededup.drop_repeated_lines(docs)
    cut = F.col("__removed") > 0
    kept = found.where(~cut | (F.length(F.trim("text")) > 0))
    columns = [
        F.when(cut, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c
        for c in docs.columns
    ]
    return kept.select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    prepare(spark)
    return neardup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`ids` in place of `text`."""
    return pieces.encode(docs, tokenizer(TOKENIZER))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]

# Learned rules, sketches and tokenizers are not SQL: tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
