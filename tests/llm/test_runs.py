"""Periodic runs against all periods tried one by one."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import cases
import numpy as np
import pytest

from twinledger.llm import periodic, queries

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """start, end, period of every run, by start and period."""
    smallest = {}
    for p in range(1, len(words) // periodic.LEAST_PERIODS + 1):
        i = p
        while i < len(words):
            if words[i] != words[i - p]:
                i += 1
                continue
            j = i
            while j < len(words) and words[j] == words[j - p]:
                j += 1
            if j - i + p >= max(periodic.LEAST_WORDS, periodic.LEAST_PERIODS * p):
                smallest.setdefault((i - p, j), p)
            i = j
    return sorted((s, e, p) for (s, e), p in smallest.items())


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = brute(words)
    dropped = {i for s, e, p in runs for i in range(s + p, e)}
    best = max(runs, key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{e - s},{p}\n" for s, e, p in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    top = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def random_words(r):
    n, size, words = r.choice([5, 30, 100, 300]), r.choice([1, 2, 2, 3, 5, 50]), []
    while len(words) < n:
        kind = r.random()
        if kind < 0.4:
            words += [r.randrange(size) for _ in range(r.randrange(1, 30))]
        elif kind < 0.8:
            block = [r.randrange(size) for _ in range(r.randrange(1, 12))]
            words += [block[i % len(block)] for i in range(r.randrange(1, 80))]
        elif words:
            i = r.randrange(len(words))
            words += words[i : i + r.randrange(1, 60)]
    return words


def found(texts):
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    text, start, end, period = periodic.runs_of_block(
        np.array([w for t in texts for w in t], dtype=np.int64), np.repeat(np.arange(len(texts)), sizes)
    )
    return [
        list(zip((start[text == i] - first[i]).tolist(), (end[text == i] - first[i]).tolist(), period[text == i].tolist()))
        for i in range(len(texts))
    ]


@pytest.mark.parametrize("seed", range(8))
def test_runs_of_random_blocks(seed):
    r = random.Random(seed)
    for _ in range(25):
        texts = [random_words(r) if r.random() < 0.9 else [] for _ in range(r.randrange(1, 8))]
        assert found(texts) == [brute(t) for t in texts]


def test_runs_of_structured_words():
    a, b = [0], [0, 1]
    for _ in range(11):
        a, b = b, b + a
    thue_morse = [bin(i).count("1") % 2 for i in range(700)]
    nested = ([7] * 30 + [1, 2] * 20 + [3]) * 5
    prefixes = [x for n in range(1, 25) for x in range(n)]
    for words in (b, thue_morse, nested, prefixes, [4] * 999, [1, 2, 3] * 8, [1, 2, 3] * 7 + [1, 2]):
        assert found([words, [5], words]) == [brute(words), [], brute(words)]


def test_a_rule_is_searched_once_for_all_its_places():
    """A repeated run lies in few rules, however often the text repeats it."""
    r = random.Random(3)
    unit = [r.randrange(1000) for _ in range(40)] + [1, 2] * 20
    words = [x for _ in range(64) for x in (*unit, 2000 + r.randrange(10**6))]
    nodes = periodic.Grammar(np.array(words), np.zeros(len(words), dtype=np.int64)).derivation()
    assert len(np.unique(nodes[0])) < nodes.shape[1] / 3
    assert found([words]) == [brute(words)]


def test_long_texts_of_one_word():
    runs = periodic.runs_of_block(np.zeros(300_000, dtype=np.int64), np.zeros(300_000, dtype=np.int64))
    assert runs[:, 0].tolist() == [0, 0, 300_000, 1] and runs.shape[1] == 1


def test_query_on_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op11_periodic_runs(spark, SF_DIR).collect()
    assert {tuple(r) for r in rows} == {expected(d.doc_id, d.text) for d in docs} and len(rows) == len(docs)
    assert sum(r.n_runs > 0 for r in rows) > len(docs) // 20


def test_odd_documents(spark, odd, empty):
    rows = periodic.find_runs(odd).collect()
    assert len(rows) == len(cases.rows())
    wanted = sorted(
        (str(i), len(WORD.findall(t or "")), [(s, e - s, p) for s, e, p in brute(WORD.findall((t or "")[:60_000]))])
        for i, t, *_ in cases.rows()
    )
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs]) for r in rows) == wanted
    assert {r.collapsed for r in rows if r.doc_id == 10} == {"one two"}
    assert {r.collapsed for r in rows if r.doc_id in (5, 6, 7)} == {""}
    assert periodic.find_runs(empty).count() == 0
    assert queries.with_planted_runs(odd).count() == len(cases.rows())
    assert queries.with_planted_runs(empty).count() == 0
