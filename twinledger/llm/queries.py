"""Registered queries of the operators in this package, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.llm import (
    alignment,
    decontaminate,
    katz,
    language,
    linededup,
    neardup,
    packing,
    periodic,
    pieces,
    pii,
    quality,
    secrets,
    spans,
    tokencount,
)
from twinledger.llm.textblocks import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

END_ID = 2
TOKEN_LIMIT = 512


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def wrap(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("found")
    return secrets.find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(spans.number_of(found, kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS),
        spans.digest(spans.of_kinds(found, secrets.BASE_KINDS)).alias("base_sha256"),
        spans.joined(found).alias("spans"),
    )


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("found")
    return pii.find_personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(spans.number_of(found, kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        spans.digest(spans.of_kinds(found, pii.BASE_KINDS)).alias("base_sha256"),
        spans.joined(found).alias("spans"),
    )


@query("op3_near_duplicates")
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


@query("op4_packed_token_ids")
def op4_packed_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.packed_documents(docs, tokenizer("word_bpe_49k.json"), END_ID)


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality.judged(docs, labels, ["doc_id"]).select(
        "doc_id",
        *(F.col("__f")[name].alias(name) for name in counts),
        F.col("__failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
    )


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), TOKEN_LIMIT)


@query("op8_sentencepiece")
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_repeated_lines(docs).select(
        "doc_id", "text", F.col("__removed").cast("bigint").alias("n_removed")
    )


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    filters = language.learn(docs.where(~held_out).select("lang", "text"))
    return language.predict(docs, filters).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document, by the hash of its id, repeats a stretch of its words to its end.

    Null ids have no hash: their texts stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.select("doc_id", "text", h.alias("__h")).withColumn(
        "__words", F.when(F.col("__h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    )
    n, g = F.size("__words"), F.floor(F.col("__h") / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    left = n - a
    period = (1 + F.floor(left / (3 + g % 8))).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice("__words", a + 1, period), F.ceil(left / period).cast("int")))
    planted = F.array_join(F.concat(F.slice("__words", F.lit(1), a), F.slice(repeated, F.lit(1), left)), " ")
    return words.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = F.col("runs")
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # Runs are in order of start, then period: only a greater exponent replaces an earlier run.
    ahead = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    best = F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(ahead(best, r), r).otherwise(best))
    return (
        periodic.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
        .withColumn("best", best)
        .select(
            "doc_id",
            F.size("runs").cast("bigint").alias("n_runs"),
            "best.start",
            "best.length",
            "best.period",
            F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
            F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )


@query("op12_lm_scoring")
def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A null id has no hash: its text is a training text.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return katz.train_and_score(table(spark, sf_dir, "documents"), ~held_out).scores


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.link_statistics(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
