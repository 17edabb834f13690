"""Language by n-grams: bit-sliced Bloom filters over all languages at once.

A slice is an array of bit masks, one bit per language; two slices are addressed
by independent hashes of a 4-byte n-gram. The AND of both entries tells all
languages that contain the n-gram, in two look-ups however many languages there
are. Per language the hits are counted and freed of those expected by chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm.textblocks import blocks, prepare, text_bytes

SLICE_BITS = 18
SLICES = 2
WORD_BITS = 60
UNKNOWN = "und"
_SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_PAD = 4

_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123, dtype=np.uint8)
_FOLD[128:] = np.arange(128, 256, dtype=np.uint8)


def _grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams (slice x gram) and the text of each gram.

    Anything but letters is a blank; texts are kept apart by blanks; grams of
    blanks only are left out.
    """
    n_texts = len(offsets) - 1
    sizes = np.diff(offsets)
    folded = np.full(len(raw) + _PAD * (n_texts + 1), 32, dtype=np.uint8)
    place = np.arange(len(raw)) + _PAD * (np.repeat(np.arange(n_texts), sizes) + 1)
    body = _FOLD[raw]
    # Capital letters of the Latin-1 block, as 0xC3 0x80-0x9E.
    capital = (body >= 0x80) & (body <= 0x9E)
    capital[1:] &= body[:-1] == 0xC3
    capital[:1] = False
    body[capital] += 0x20
    folded[place] = body
    wide = folded.astype(np.uint64)
    codes = wide[:-3] | wide[1:-2] << np.uint64(8) | wide[2:-1] << np.uint64(16) | wide[3:] << np.uint64(24)
    owner = np.repeat(np.arange(n_texts), sizes + _PAD)
    codes = codes[: len(owner)]
    kept = codes != np.uint64(0x20202020)
    codes, owner = codes[kept], owner[kept]
    shift = np.uint64(64 - SLICE_BITS)
    return np.stack([(codes * seed) >> shift for seed in _SEEDS]).astype(np.int64), owner


def gram_counts(labelled: DataFrame) -> DataFrame:
    """lang, slot, n over all rows of (lang, text): a slot is an entry of a slice."""
    prepare(labelled.sparkSession)
    schema = "lang string, slot int, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for part in blocks(batches, "text"):
            langs = part.column("lang").to_pylist()
            slots, owner = _grams(*text_bytes(part.column("text")))
            names = sorted(set(langs))
            of_text = np.array([names.index(x) for x in langs])
            for i, name in enumerate(names):
                total = held.setdefault(name, np.zeros((SLICES, 1 << SLICE_BITS), dtype=np.int64))
                mine = of_text[owner] == i
                for j in range(SLICES):
                    total[j] += np.bincount(slots[j][mine], minlength=1 << SLICE_BITS)
        for name, total in held.items():
            flat = total.ravel()
            used = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(flat[used])],
                ["lang", "slot", "n"],
            )

    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    partial = usable.select("lang", "text").mapInArrow(count, schema)
    return partial.groupBy("lang", "slot").agg(F.sum("n").alias("n"))


@dataclass
class LanguageFilters:
    """masks[w, slot]: bit b stands for language names[w * WORD_BITS + b]."""

    names: list[str]
    masks: np.ndarray
    chance: np.ndarray


def learn(labelled: DataFrame, share: float = 0.2, at_least: int = 2) -> LanguageFilters:
    """Filters from labelled rows.

    A language holds an entry if it has it `at_least` times and at no less than
    `share` of the rate of the language where it is most common. The driver gets
    the finished masks: 2 x 2^18 numbers at most per 60 languages.
    """
    counts = gram_counts(labelled)
    from twinledger.session import materialize

    counts = materialize(counts, "gram-counts")
    totals = counts.where(F.col("slot") < 1 << SLICE_BITS).groupBy("lang").agg(F.sum("n").alias("total"))
    names = sorted(row["lang"] for row in totals.collect())
    if not names:
        return LanguageFilters([], np.zeros((0, SLICES << SLICE_BITS), dtype=np.int64), np.zeros(0))
    rated = counts.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))
    place = F.create_map(*[x for i, name in enumerate(names) for x in (F.lit(name), F.lit(i))])
    per_slot = rated.groupBy("slot").agg(
        F.max("rate").alias("top"),
        F.collect_list(F.struct(place[F.col("lang")].alias("i"), "rate", "n")).alias("found"),
    )
    held = F.filter("found", lambda x: (x["rate"] >= F.col("top") * share) & (x["n"] >= at_least))
    words = -(-len(names) // WORD_BITS)
    masks = np.zeros((words, SLICES << SLICE_BITS), dtype=np.int64)
    for w in range(words):
        bits = F.aggregate(
            held,
            F.lit(0).cast("bigint"),
            lambda a, x: a + F.when(
                F.floor(x["i"] / WORD_BITS) == w, F.pow(F.lit(2.0), x["i"] - w * WORD_BITS).cast("bigint")
            ).otherwise(F.lit(0).cast("bigint")),
        )
        table = per_slot.select("slot", bits.alias("mask")).where("mask != 0").toArrow()
        masks[w, table.column("slot").to_numpy()] = table.column("mask").to_numpy()
    fill = np.array(
        [
            [((masks[i // WORD_BITS] >> (i % WORD_BITS)) & 1).reshape(SLICES, -1)[j].mean() for j in range(SLICES)]
            for i in range(len(names))
        ]
    )
    return LanguageFilters(names, masks, fill.prod(axis=1))


def predict(docs: DataFrame, filters: LanguageFilters) -> DataFrame:
    """doc_id, lang_pred, score: `und` and 0 for null texts and texts without a letter.

    score is the winner's share of all corrected hits. Ties, and texts none of
    whose n-grams is known, go to the first language by name.
    """
    spark = prepare(docs.sparkSession)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    shared = spark.sparkContext.broadcast(filters)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.names, UNKNOWN], dtype=object)
        for part in blocks(batches, "text"):
            n_texts = part.num_rows
            slots, owner = _grams(*text_bytes(part.column("text")))
            hits = np.zeros((len(model.names), n_texts))
            for w in range(len(model.masks)):
                mask = model.masks[w][slots[0]] & model.masks[w][slots[1] + (1 << SLICE_BITS)]
                for i in range(w * WORD_BITS, min(len(model.names), (w + 1) * WORD_BITS)):
                    found = owner[(mask >> (i - w * WORD_BITS)) & 1 == 1]
                    hits[i] = np.bincount(found, minlength=n_texts)
            tried = np.bincount(owner, minlength=n_texts)
            chance = model.chance[:, None]
            freed = np.maximum(0.0, (hits - tried * chance) / np.maximum(1e-9, 1 - chance))
            known = part.column("has_letter").to_numpy(zero_copy_only=False).astype(bool) & bool(model.names)
            best = np.where(known, freed.argmax(axis=0), len(model.names)) if model.names else np.zeros(n_texts, int)
            total = freed.sum(axis=0) if model.names else np.zeros(n_texts)
            top = freed.max(axis=0) if model.names else np.zeros(n_texts)
            score = np.where(known & (total > 0), top / np.where(total > 0, total, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                schema.fieldNames(),
            )

    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", "text", has_letter.alias("has_letter")).mapInArrow(answer, schema)
