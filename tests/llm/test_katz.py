"""The backoff model against dictionaries, and its probabilities against one."""

import math
import re
import zlib
from collections import Counter, defaultdict

import cases
import pytest
from pyspark.sql import functions as F

from twinledger.llm import katz, queries

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), "\n"]


class Plain:
    """Katz backoff by the textbook, one n-gram at a time."""

    def __init__(self, texts, order):
        self.order = order
        self.n = [Counter() for _ in range(order + 1)]
        for text in texts:
            t = tokens(text)
            for k in range(1, order + 1):
                self.n[k].update(tuple(t[i : i + k]) for i in range(len(t) - k + 1))
        self.total = sum(self.n[1].values())
        self.d = [None] + [self.discounts(c) for c in self.n[1:]]
        self.after = defaultdict(list)
        for k in range(1, order + 1):
            for gram in self.n[k]:
                self.after[gram[:-1]].append(gram[-1])
        self.weights, self.spares, self.unknown = {}, {}, None

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        k, d = katz.DISCOUNTED, {}
        top = (k + 1) * n[k + 1] / n[1] if n[1] else 1
        for r in range(1, k + 1):
            d[r] = ((r + 1) * n[r + 1] / (r * n[r]) - top) / (1 - top) if n[r] and top < 1 else 0
            if not 0 < d[r] < 1:
                d[r] = (r - 0.5) / r
        return d

    def count(self, context):
        return self.n[len(context)][context] if context else self.total

    def spare(self, context):
        if context not in self.spares:
            counts = [self.n[len(context) + 1][(*context, w)] for w in self.after[context]]
            self.spares[context] = int(min(counts, default=99) > katz.DISCOUNTED)
        return self.spares[context]

    def direct(self, context, word):
        c = self.n[len(context) + 1][(*context, word)]
        return self.d[len(context) + 1].get(c, 1) * c / (self.count(context) + self.spare(context)) if c else 0

    def p(self, context, word):
        if self.n[len(context) + 1][(*context, word)]:
            return self.direct(context, word)
        if not context:
            if self.unknown is None:
                self.unknown = 1 - math.fsum(self.direct((), w) for w in self.after[()])
            return self.unknown
        if not self.count(context):
            return self.p(context[1:], word)
        if context not in self.weights:
            left = 1 - math.fsum(self.direct(context, w) for w in self.after[context])
            free = 1 - math.fsum(self.p(context[1:], w) for w in self.after[context])
            self.weights[context] = left / free
        return self.weights[context] * self.p(context[1:], word)

    def row(self, text):
        t = tokens(text)
        known = [self.n[1][(w,)] for w in t]
        base = sum(math.log10((c + 1) / (self.total + len(self.n[1]) + 1)) for c in known)
        score = sum(math.log10(self.p(tuple(t[max(0, i - self.order + 1) : i]), w)) for i, w in enumerate(t))
        return len(t), sum(c > 0 for c in known), self.total, pytest.approx(base, rel=1e-9), pytest.approx(score, rel=1e-9, abs=1e-9)


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def test_query_on_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    plain = Plain([d.text for d in docs if not held_out(d.doc_id)], katz.ORDER)
    found = {r.doc_id: tuple(r)[1:] for r in queries.op12_lm_scoring(spark, SF_DIR).collect()}
    assert len(found) == len(docs) and any(held_out(d.doc_id) for d in docs)
    for d in docs:
        assert found[d.doc_id] == (held_out(d.doc_id), *plain.row(d.text))


ROWS = [(i, " ".join(f"w{(i * j * j + j) % (3 + i % 40)}" for j in range(5 + 7 * i % 120))) for i in range(120)]


@pytest.mark.parametrize(("order", "block", "entries"), [(1, 1 << 20, 1 << 20), (2, 300, 1 << 20), (3, 700, 150), (4, 2000, 40)])
def test_any_order_block_and_partition(spark, order, block, entries):
    """Small partitions make contexts too frequent for one."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    model = katz.train_and_score(docs, F.col("doc_id") % 5 != 0, order, block, entries)
    plain = Plain([t for i, t in ROWS if i % 5], order)
    found = {r.doc_id: tuple(r)[2:] for r in model.scores.collect()}
    assert found == {i: plain.row(t) for i, t in ROWS}
    if order > 2:
        partial = model.tables[1].where(F.col("kind") == katz._PARTIAL)
        assert partial.count() > partial.select("context").distinct().count() > 0
    for n in range(1, order + 1):
        assert sorted(r.n for r in model.rows(n).collect()) == sorted(plain.n[n].values())


def test_probabilities_after_any_words_sum_to_one(spark):
    words = sorted({w for _, t in ROWS for w in tokens(t)} - {"\n"})
    plain = Plain([t for i, t in ROWS if i % 5], 3)
    seen = [w for (w,) in plain.n[1] if w != "\n"]
    for context in (("w1", "w2"), ("w2", "unheard"), ("unheard", "w0"), ("w0",), tuple(ROWS[3][1].split(" ")[:2])):
        # One text per word that may follow; the model's score less that of the words before.
        asked = [(1000 + i, " ".join([*context, w])) for i, w in enumerate([*seen, "unheard"])]
        docs = spark.createDataFrame(ROWS + asked, "doc_id long, text string")
        found = katz.train_and_score(docs, (F.col("doc_id") < 1000) & (F.col("doc_id") % 5 != 0), 3).scores
        mine = {r.doc_id - 1000: r.score for r in found.where("doc_id >= 1000").collect()}
        before = sum(math.log10(plain.p(tuple(context[max(0, i - 2) : i]), w)) for i, w in enumerate(context))
        ending = {i: math.log10(plain.p((context[-1], w), "\n")) for i, w in enumerate([*seen, "unheard"])}
        total = sum(10 ** (score - before - ending[i]) for i, score in mine.items())
        assert total + plain.p(context[-2:], "\n") == pytest.approx(1, abs=1e-9)
    assert len(words) >= len(seen)


def test_discounts_without_counts_of_counts():
    assert katz.Discounts.of([0] * 6).factors == [(r - 0.5) / r for r in range(1, 6)]
    good = katz.Discounts.of([100, 40, 20, 12, 8, 5]).factors
    assert all(0 < d < 1 for d in good)


def test_odd_documents(spark, odd, empty):
    rows = katz.train_and_score(odd, F.lit(True)).scores.collect()
    plain = Plain([t for _, t, *_ in cases.rows()], katz.ORDER)
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    wanted = sorted(((i, False, *plain.row(t)) for i, t, *_ in cases.rows()), key=lambda r: (str(r[0]), r[2], round(r[5].expected, 6)))
    assert sorted(map(tuple, rows), key=key) == wanted
    assert katz.train_and_score(empty, F.lit(True)).scores.count() == 0
    unlearned = katz.train_and_score(odd, F.lit(None).cast("boolean")).scores.collect()
    assert {(r.held_out, r.n_known, r.train_tokens, r.score) for r in unlearned} == {(True, 0, 0, 0.0)}
