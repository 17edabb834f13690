"""Quality rules, language filters and decontamination."""

import re
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from twinledger.llm import decontaminate, language, quality, queries
from twinledger.llm.textblocks import text_bytes

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_counts(text):
    w = WORD.findall(text or "")
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for x in w for c in x),
        len(lines) - len(set(lines)),
        len(covered),
    )


def check_counts(rows, texts):
    for r in rows:
        expected = plain_counts(texts(r))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert r.base_failed == failed and not (failed and r.kept)


def test_quality_counts_of_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op5_quality_rules(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    check_counts(rows, lambda r: texts[r.doc_id])


def test_quality_of_odd_documents(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (None, 0, 0), (10, None, 0)], "doc_id long, quality int, toxic int")
    found = quality.judged(odd, labels)
    rows = found.select("doc_id", "text", "__f.*", F.col("__failed").alias("base_failed"), F.col("__kept").alias("kept")).collect()
    assert len(rows) == len(cases.rows())
    check_counts(rows, lambda r: r.text)
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, None}
    assert quality.keep_good(empty, labels).count() == quality.keep_good(empty, labels.limit(0)).count() == 0


def test_rules_are_native(spark):
    plan = queries.op5_quality_rules(spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_list_separates_what_one_feature_tells(spark):
    """Shouting documents are bad, all others good: one rule, no good one lost."""
    rows, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        text = cases.prose(i, 80)
        rows.append((i, text.upper() if bad else text))
        labels.append((i, 0 if bad else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = quality.judged(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    rules = quality.learn_from(found, spark.createDataFrame(labels, "doc_id long, quality int")).rules
    assert len(rules) == 1 and rules[0][0].feature == "upper_share" and rules[0][0].at_least
    assert {r.doc_id for r in found.where("not __kept").collect()} == {i for i in range(240) if i % 4 == 0}


def test_languages_of_held_out_documents(spark):
    found = queries.op10_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 100
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_filters_hold_every_language_of_a_gram(spark, odd, empty):
    rows = [("aa", "bab bab cac"), ("aa", "bab"), ("bb", "bab dod dod"), ("bb", None), (None, "bab"), ("bb", "bab cac")]
    filters = language.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert filters.names == ["aa", "bb"]
    slots, _ = language._grams(*text_bytes(pa.array(["bab"])))
    masks = filters.masks[0][slots[0]] & filters.masks[0][slots[1] + (1 << language.SLICE_BITS)]
    # The grams of the word and what comes before; those after it need a text that ends so.
    assert (masks[:4] == 3).all()
    docs = spark.createDataFrame([(1, "dod dod"), (2, None), (3, "12 !"), (4, "zzz"), (5, "BAB CAC")], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in language.predict(docs, filters).collect()}
    assert found[1] == "bb" and found[2] == found[3] == "und" and found[4] in ("aa", "bb") and found[5] == "aa"
    assert language.predict(odd, filters).count() == len(cases.rows()) and language.predict(empty, filters).count() == 0
    nothing = language.learn(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}


def test_more_languages_than_bits_in_a_word(spark):
    rows = [(f"l{i:02d}", " ".join(f"{chr(97 + i // 26)}{chr(97 + i % 26)}{x}q" for x in "xyz") * 3) for i in range(70)]
    filters = language.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert filters.masks.shape[0] == 2
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in language.predict(docs, filters).collect()}
    assert sum(found[i] == rows[i][0] for i in found) >= 68


def test_every_planted_item_is_found(spark):
    items = [(i, cases.prose(7000 + i, 14 + i, 3000)) for i in range(40)]
    docs, expected = [], set()
    for i in range(200):
        text = cases.prose(i, 150, 3000).split(" ")
        if i % 4 == 0:
            item = items[i // 5]
            at = (i * 7) % 140
            passage = item[1].upper().split(" ") if i % 8 == 0 else item[1].split(" ")
            text[at:at] = passage
            expected.add((i, item[0]))
        docs.append((i, " ".join(text)))
    found = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected


def test_short_items_are_found_in_a_large_benchmark(spark):
    """Items of 2 to 13 words amid the words of others, planted once each."""
    r = np.random.default_rng(3)
    longer = [(i, cases.prose(7000 + i, 30, 3000)) for i in range(1000)]
    short = [(2000 + i, cases.prose(9000 + i, 2 + i // 10, 3000)) for i in range(120)]
    docs = []
    for i in range(120):
        text = cases.prose(i, 150, 3000).split(" ")
        at = int(r.integers(0, 140))
        text[at:at] = short[i][1].split(" ")
        docs.append((i, " ".join(text)))
    found = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(longer + short, "item_id long, text string")
    ).collect()
    pairs = {(x.doc_id, x.item_id) for x in found}
    assert {(i, short[i][0]) for i in range(120)} <= pairs
    assert len(pairs) <= 130


def test_found_items_equal_exact_search(spark):
    """On the given tables: every document that holds an item whole, and clean ones left alone."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    as_words = lambda t: " " + " ".join(re.findall("[0-9a-z\u0080-￿]+", t.lower())) + " "
    exact = {(d, i) for i, x in items.items() for d, t in docs.items() if as_words(x) in as_words(t)}
    found = {(r.doc_id, r.item_id): r.share for r in queries.op6_decontamination(spark, SF_DIR).collect()}
    assert exact <= set(found)
    assert len(found) <= len(exact) + 3


def test_paraphrases_need_their_answer():
    item = np.arange(20, dtype=np.uint64)
    loose = item.copy()
    loose[[1, 3, 5, 7, 9, 11, 13]] = 99
    assert decontaminate.matches(item, loose) == (13 / 20, True)
    loose[18] = 99
    assert decontaminate.matches(item, loose) == (12 / 20, False)
    assert decontaminate.matches(item, item) == (1.0, True)


def test_decontaminating_odd_documents(spark, odd, empty):
    bench = spark.createDataFrame([(1, cases.prose(1, 120)), (2, None), (3, ""), (4, "!!")], "item_id long, text string")
    left = decontaminate.drop_leaks(odd, bench)
    assert left.columns == odd.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([4, 5, 6, 7, 8, None, None, 9, 10, 11, 12, 12])
    assert decontaminate.leaks(empty, bench).count() == 0
    assert decontaminate.leaks(odd, bench.where("item_id > 1")).count() == 0


def test_benchmark_in_blocks_gives_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, cases.prose(i, 60)) for i in range(12)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, cases.prose(i, 40)) for i in range(6)], "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == whole
    assert whole == {(i, i) for i in range(6)}


def test_equal_benchmark_texts_are_searched_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, cases.prose(i, 60)) for i in range(4)], "doc_id long, text string")
    rows = [(i, cases.prose(0, 40)) for i in range(50)] + [(60, cases.prose(1, 40)), (60, cases.prose(1, 40))]
    read, build = [], decontaminate.Benchmark.of
    monkeypatch.setattr(decontaminate.Benchmark, "of", lambda texts: read.extend(texts) or build(texts))
    found = decontaminate.leaks(docs, spark.createDataFrame(rows, "item_id long, text string")).collect()
    assert Counter((r.doc_id, r.item_id) for r in found) == Counter([(0, i) for i in range(50)] + [(1, 60), (1, 60)])
    assert sorted(read) == sorted({t for _, t in rows})
