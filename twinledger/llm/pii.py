"""Personal data, and the words that give it away.

Patterns find protected entities (mail and network addresses, card and phone
numbers). How strongly a term of its documents reveals an entity is estimated from the
whole corpus (Sanchez and Batet's C-sanitisation): with documents as events,
PMI(c; t) = log2(N * df(c, t) / (df(c) * df(t))) is at most IC(c) = log2(N / df(c)),
which it reaches when t occurs with c only. A term whose share PMI / IC reaches
a threshold is a further span wherever it stands in documents with the entity:
generalised, or removed from a higher one on. An entity of one text only has no
terms: every word that the corpus has nowhere else would reveal it as surely.
Intermediate tables hold hashes of entities and terms, never the values.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm.textblocks import blocks, prepare, set_aside, signed, text_bytes, words
from twinledger.session import materialize

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "removed", "generalised")

#: A term must be seen with an entity in so many documents, of two different texts at least.
LEAST_TOGETHER = 2
GENERALISE_AT = 0.75
REMOVE_AT = 0.95
#: Up to so many terms (or entities) the tasks are told which ones matter (8 bytes each).
TERMS_SENT = 1_000_000
TASKS_A_CORE = 2

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


def _emails(text: str) -> list[tuple[int, int, str]]:
    """From each '@' leftwards, so that long runs without one cost nothing."""
    out, done = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end(), text[start : m.end()].lower()))
            done = m.end()
    return out


def _addresses(text: str) -> list[tuple[int, int, str]]:
    found = []
    for m in _ADDRESS.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append((m.start(), m.end(), ".".join(parts)))
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _numbers(pattern: re.Pattern, low: int, high: int, check=None):
    def find(text: str) -> list[tuple[int, int, str]]:
        out = []
        for m in pattern.finditer(text):
            if m.end() - m.start() < low:
                continue
            digits = "".join(c for c in m[0] if c.isdigit())
            if low <= len(digits) <= high and (check is None or check(digits)):
                out.append((m.start(), m.end(), digits))
        return out

    return find


FINDERS = {
    "email": _emails,
    "ip": _addresses,
    "card": _numbers(_CARD, 14, 19, _luhn),
    "phone": _numbers(_PHONE, 10, 15),
}


def entities(text: str) -> list[tuple[int, int, int, str]]:
    """(start, order of kind, end, normal form), leftmost and not overlapping within a kind."""
    found = []
    for k, kind in enumerate(BASE_KINDS):
        if kind == "email" and "@" not in text or kind == "phone" and "+" not in text:
            continue
        found += [(start, k, end, value) for start, end, value in FINDERS[kind](text)]
    return sorted(found)


def _terms(text: str, found: list[tuple[int, int, int, str]]) -> list[tuple[str, int, int]]:
    """(term, start, end) of all words of a text outside its entities."""
    out, at, reach = [], 0, 0
    for m in _TERM.finditer(text):
        start, end = m.span()
        while at < len(found) and found[at][0] < end:
            reach = max(reach, found[at][2])
            at += 1
        if start >= reach and end - start >= 3 and not m[0].isdigit():
            out.append((m[0], start, end))
    return out


_SPAN = "struct<kind: string, start: bigint, end: bigint>"
_PLACE = "struct<start: int, end: int>"


def _hashes(found: list[tuple[int, int, int, str]]) -> list[int]:
    """Each entity of a text once."""
    return sorted({xxhash.xxh64_intdigest(f"{BASE_KINDS[k]}:{value}") for _, k, _, value in found})


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = pa.array(BASE_KINDS)
    for part in blocks(batches, "text"):
        spans, names_of = [], []
        span_ends, entity_ends = [0], [0]
        for text in part.column("text").to_pylist():
            found = entities(text or "")
            spans += found
            names_of += _hashes(found)
            span_ends.append(len(spans))
            entity_ends.append(len(names_of))
        span_values = pa.StructArray.from_arrays(
            [
                names.take(pa.array([k for _, k, _, _ in spans], pa.int32())),
                pa.array([s for s, _, _, _ in spans], pa.int64()),
                pa.array([e for _, _, e, _ in spans], pa.int64()),
            ],
            ["kind", "start", "end"],
        )
        lists = lambda ends, values: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("digest"),
                lists(span_ends, span_values),
                lists(entity_ends, pa.array(signed(np.array(names_of, dtype=np.uint64)))),
            ],
            ["doc_id", "digest", "found", "entities"],
        )


def _pair_up(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Every wanted entity of a document with every term of it, and the term's places."""
    wanted = None if wanted is None else set(wanted.tolist())
    for part in blocks(batches, "text"):
        for i, text in enumerate(part.column("text").to_pylist()):
            found = entities(text or "")
            held = [h for h in _hashes(found) if wanted is None or h in wanted]
            said = _terms(text, found) if held else []
            if not said:
                continue
            # The same hash as the corpus count uses.
            hashes = words(*text_bytes(pa.array([t for t, _, _ in said], pa.string()))).hashes
            order = np.argsort(hashes, kind="stable")
            first = np.flatnonzero(np.append(True, hashes[order][1:] != hashes[order][:-1]))
            ends = pa.array(np.append(first, len(order)).astype(np.int32))
            at = np.array([(s, e) for _, s, e in said], dtype=np.int32)[order]
            places = pa.ListArray.from_arrays(
                ends, pa.StructArray.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1])], ["start", "end"])
            )
            terms = pa.array(signed(hashes[order][first]))
            one = pa.array(np.full(len(first), i))
            # An entity at a time: a document may hold many.
            for h in held:
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(one),
                        part.column("digest").take(one),
                        pa.array(signed(np.full(len(first), h, dtype=np.uint64))),
                        terms,
                        places,
                        pa.array(np.full(len(first), h == held[0])),
                    ],
                    ["doc_id", "digest", "entity", "term", "places", "first"],
                )


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n: documents of the whole corpus that contain each listed term.

    A list of up to `TERMS_SENT` terms, counted first, is sent to the tasks, of which
    there are `TASKS_A_CORE` per core: each ends with a row per term that it has met, so
    that tasks in proportion to the texts would make these rows grow with both. A
    longer list is matched after the count.
    """
    spark = docs.sparkSession
    sent, texts = None, docs.select("text")
    if terms.count() <= TERMS_SENT:
        sent = spark.sparkContext.broadcast(np.sort(terms.toArrow().column("term").to_numpy().view(np.uint64)))
        texts = texts.coalesce(TASKS_A_CORE * spark.sparkContext.defaultParallelism)

    def found_in(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Terms of a block and the number of its texts that have each."""
        found = words(*text_bytes(part.column("text")))
        text = np.repeat(np.arange(part.num_rows), np.diff(found.first))
        hashes = found.hashes
        if sent is not None:
            if not len(sent.value):
                return hashes[:0], text[:0]
            place = np.minimum(np.searchsorted(sent.value, hashes), len(sent.value) - 1)
            hit = sent.value[place] == hashes
            hashes, text = hashes[hit], text[hit]
        order = np.lexsort((text, hashes))
        hashes, text = hashes[order], text[order]
        first = np.ones(len(hashes), dtype=bool)
        first[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        return np.unique(hashes[first], return_counts=True)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0 if sent is None else len(sent.value), dtype=np.int64)
        for part in blocks(batches, "text"):
            term, n = found_in(part)
            if sent is not None:
                total[np.searchsorted(sent.value, term)] += n
            else:
                yield pa.RecordBatch.from_arrays([pa.array(signed(term)), pa.array(n)], ["term", "n"])
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(signed(sent.value[used])), pa.array(total[used])], ["term", "n"])

    counted = texts.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return counted if sent is not None else counted.join(terms, "term", "left_semi")


def entity_terms(found: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, digest, entity, term, places, first: entities of two texts or more with all terms of
    their documents; `first` marks one entity of each document."""
    of_entity = found.select("digest", F.explode("entities").alias("entity")).groupBy("entity")
    shared = of_entity.agg((F.min("digest") != F.max("digest")).alias("varied")).where("varied").select("entity")
    shared = materialize(shared, "shared-entities")
    sent = None
    if shared.count() <= TERMS_SENT:
        sent = docs.sparkSession.sparkContext.broadcast(shared.toArrow().column("entity").to_numpy().view(np.uint64))
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + T._parse_datatype_string(f"digest bigint, entity bigint, term bigint, places array<{_PLACE}>, first boolean").fields
    )
    pairs = docs.mapInArrow(lambda batches: _pair_up(batches, None if sent is None else sent.value), schema)
    return pairs if sent is not None else pairs.join(shared, "entity", "left_semi")


def disclosing_terms(found: DataFrame, pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """entity, term, share: pairs whose PMI reaches `GENERALISE_AT` of the entity's information."""
    n_docs = found.count()
    together = (
        pairs.groupBy("entity", "term")
        .agg(F.count("*").alias("n_both"), (F.min("digest") != F.max("digest")).alias("varied"))
        .where(f"varied and n_both >= {LEAST_TOGETHER}")
    )
    together = materialize(together, "together")
    of_entity = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    # An entity of every document has no information; nor have its terms a share of it.
    together = together.join(of_entity.where(F.col("n_entity") < n_docs), "entity")
    # A share s means n_term <= n_both * (N / n_entity) ** (1 - s). The documents of `pairs` that
    # hold a term are no more than all that do, so most common words need no count at all.
    least = pairs.where("first").groupBy("term").agg(F.count("*").alias("n_least"))
    most = F.col("n_both") * F.pow(F.lit(float(n_docs)) / F.col("n_entity"), F.lit(1 - GENERALISE_AT))
    together = together.join(least, "term", "left").where((F.col("n_least") <= most * (1 + 1e-9)) | F.col("n_least").isNull())
    together = materialize(together, "may-reveal")
    of_term = term_counts(docs, materialize(together.select("term").distinct(), "near-terms"))
    joined = together.join(of_term.withColumnRenamed("n", "n_term"), "term")
    information = F.log2(F.lit(float(n_docs)) / F.col("n_entity"))
    pmi = F.log2(F.col("n_both") * F.lit(float(n_docs)) / (F.col("n_entity") * F.col("n_term")))
    return joined.select("entity", "term", (pmi / information).alias("share")).where(f"share >= {GENERALISE_AT}")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, digest, found (array of kind, start, end) for every row of `docs`.

    Positions are code points, ends exclusive; spans go by start, then by kind
    as in KINDS. Null texts are empty. An entity that occurs in every document
    has no information to reveal, and no terms.
    """
    prepare(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", F.xxhash64("text"))
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + T._parse_datatype_string(f"digest bigint, found array<{_SPAN}>, entities array<bigint>").fields
    )
    found = materialize(texts.mapInArrow(_find, schema), "entities")
    pairs = materialize(entity_terms(found, texts), "entity-terms")
    telling = materialize(disclosing_terms(found, pairs, texts), "disclosing")
    kind = F.when(F.col("share") >= REMOVE_AT, "removed").otherwise("generalised")
    marked = pairs.join(telling, ["entity", "term"]).select("doc_id", "digest", "share", F.explode("places").alias("x"))
    marked = marked.select(
        "doc_id", "digest", "share", F.col("x.start").cast("bigint").alias("start"), F.col("x.end").cast("bigint").alias("end")
    )
    marked = marked.groupBy("doc_id", "digest", "start", "end").agg(F.max("share").alias("share"))
    marked = marked.groupBy(F.col("doc_id").alias("__id"), F.col("digest").alias("__key")).agg(
        F.collect_list(F.struct(kind.alias("kind"), "start", "end")).alias("__more")
    )
    match = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__key"))
    more = F.coalesce("__more", F.array().cast(f"array<{_SPAN}>"))
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(
        F.concat("found", more),
        lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("o"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    ordered = F.transform(
        F.sort_array(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    return found.select("doc_id", "digest", "found").join(marked, match, "left").select(
        "doc_id", "digest", F.when(F.col("__more").isNull(), F.col("found")).otherwise(ordered).alias("found")
    )


def _replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for i, spans in enumerate(batch.column("__found").to_pylist()):
            text, out, done = texts[i], [], 0
            for span in spans or ():
                if span["start"] >= done:
                    shown = "" if span["kind"] == "removed" else f"[{span['kind'].upper()}]"
                    out += [text[done : span["start"]], shown]
                    done = span["end"]
            if out:
                texts[i] = "".join([*out, text[done:]])
        at = batch.schema.get_field_index("text")
        names = [n for n in batch.schema.names if n != "__found"]
        yield batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type)).select(names)


def sanitise(docs: DataFrame) -> DataFrame:
    """`docs` with every span of `text` replaced by its kind, or removed."""
    found = find_personal_data(docs).where("size(found) > 0").dropDuplicates(["doc_id", "digest"])
    found = found.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__key"), F.col("found").alias("__found"))
    match = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
    plain = set_aside(docs)
    found_in = plain.join(found, match, "left").select(*plain.columns, "__found")
    return found_in.mapInArrow(_replace, plain.schema).toDF(*docs.columns)
