"""Near-duplicate documents and lines against brute force."""

import re
from collections import Counter, defaultdict
from itertools import combinations

import cases
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from twinledger.llm import linededup, links, neardup
from twinledger.llm.textblocks import text_bytes, unspaced, words


def union(pairs, items):
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(0, 5), max_size=12))
def test_common_words_is_the_longest_common_subsequence(a, b):
    assert linededup.common_words(a, b) == slow_lcs(a, b)
    n = len(a) + len(b)
    exact = 2 * slow_lcs(a, b) / n if n else 1.0
    assert linededup.edit_similarity(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)) == pytest.approx(exact)


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)]])
def test_components(spark, edges):
    found = {r.id: r.root for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == union(edges, {i for e in edges for i in e})


@pytest.mark.parametrize("seed", range(3))
def test_groups_lose_no_link_within_a_bucket(spark, seed):
    """Buckets of changed copies, shared edits among them: groups equal all pairs of each bucket."""
    r = np.random.default_rng(seed)
    items, members, pairs = {}, [], set()
    for bucket in range(4):
        base = r.integers(0, 1 << 40, 60).astype(np.uint64)
        first = len(items)
        edited = [base]
        for _ in range(40):
            # Most start from the base, some from an earlier copy.
            x = edited[r.integers(len(edited))].copy() if r.random() < 0.3 else base.copy()
            x[r.choice(len(x), r.integers(0, 12), replace=False)] = r.integers(1 << 41, 1 << 42, 1)[0] + r.integers(0, 1 << 40)
            x = np.unique(x)
            edited.append(x[: len(x) - r.integers(0, 8)])
        edited += [r.integers(0, 1 << 40, r.integers(30, 70)).astype(np.uint64) for _ in range(5)]
        for x in edited:
            items[len(items)] = np.unique(x)
        ids = range(first, len(items))
        members += [(bucket, i, len(items[i])) for i in ids]
        pairs |= {(a, b) for a, b in combinations(ids, 2) if neardup.alignment_similarity(items[a], items[b]) > 0}
    rows = [(i, bytearray(x.tobytes())) for i, x in items.items()]
    known = spark.createDataFrame(rows, "id long, labels binary")
    found = links.linked_groups(
        spark.createDataFrame(members, "key long, id long, size long"), lambda ids: known.join(ids, "id", "left_semi"), neardup.LINK
    )
    expected = union(pairs, {i for p in pairs for i in p})
    assert {x.id: x.root for x in found.collect()} == expected
    assert len(set(expected.values())) > 4


def varied(seed, text, share):
    r = np.random.default_rng(seed)
    return " ".join(f"z{r.integers(999)}" if r.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def copies(spark):
    rows = []
    for g in range(12):
        base = cases.prose(100 + g, 30 + 25 * g)
        rows += [(g * 10 + k, varied(g * 10 + k, base, 0.006 * k)) for k in range(6)]
    rows += [(900 + i, cases.prose(900 + i, 8 + i)) for i in range(30)]
    rows += [(950, "a b c d e f g h"), (951, "a b c d e f g h i"), (952, "A b, c d e f g h"), (960, "tiny"), (961, "tiny")]
    return rows


def test_classes_equal_brute_force(spark, copies):
    texts = dict(copies)
    labels, first = neardup.labelled_shingles(words(*text_bytes(pa.array(list(texts.values())))))
    of = {i: labels[s:e] for i, s, e in zip(texts, first[:-1], first[1:])}
    near = [(a, b) for a, b in combinations(texts, 2) if neardup.alignment_similarity(of[a], of[b]) > 0]
    jaccard = {
        (a, b): len(set(of[a].tolist()) & set(of[b].tolist())) / len(set(of[a].tolist()) | set(of[b].tolist()))
        for a, b in combinations(texts, 2)
    }
    assert all(jaccard[p] >= 0.8 for p in near) and 30 < len(near)
    assert all(p in set(near) for p, v in jaccard.items() if v >= 0.8)
    found = neardup.near_duplicates(spark.createDataFrame(copies, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in found} == union(near, texts)
    assert {r.doc_id for r in found if r.kept} == set(union(near, texts).values())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), unique=True, max_size=30), st.lists(st.integers(0, 40), unique=True, max_size=30))
def test_alignment_is_an_ordered_jaccard(a, b):
    value = neardup.alignment_similarity(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
    common = slow_lcs(a, b)
    exact = common / max(1, len(a) + len(b) - common)
    assert value == pytest.approx(exact if exact >= 0.8 else 0.0)


def test_odd_documents_keep_one_of_each_class(odd, empty):
    found = neardup.near_duplicates(odd).collect()
    assert len(found) == len(cases.rows())
    classes = defaultdict(set)
    for r in found:
        classes[r.doc_id].add(r.class_id)
    assert classes[1] == classes[2] == classes[3] == {1} and classes[5] == {5} and classes[None] == {None}
    assert classes[6] == {6} and classes[8] == {8} and classes[12] == {12}
    left = neardup.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([1, 4, 5, 6, 7, 8, None, None, 9, 10, 11, 12, 12])
    assert neardup.drop_near_duplicates(empty).count() == 0


WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


def plain_lines(rows):
    """All lines, grouped by equal words or similarity; later occurrences dropped."""
    where = [(i, n, [w.lower() for w in WORD.findall(x)]) for i, t in rows for n, x in enumerate((t or "").split("\n"))]
    where = [(i, n, w) for i, n, w in where if len(w) >= linededup.LEAST_WORDS]
    pairs = [
        (a, b)
        for a, b in combinations(range(len(where)), 2)
        if 2 * slow_lcs(where[a][2], where[b][2]) / (len(where[a][2]) + len(where[b][2])) >= linededup.SIMILARITY
    ]
    return where, pairs


def test_repeated_lines_go_but_for_the_first(spark):
    hot = "this line stands in every one of the documents"
    rows = [(i, f"{cases.prose(i, 12)}\n{hot}\nshort one\n{cases.prose(500 + i // 2, 15)}\n") for i in range(20)]
    rows += [(50, f"{hot}\n{hot.upper()}!\n\n{cases.prose(0, 12)} "), (51, None), (52, ""), (None, hot)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.text, r["__removed"]) for r in linededup.drop_repeated_lines(docs).collect()}
    seen = set()
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        kept = []
        for line in (text or "").split("\n"):
            key = tuple(w.lower() for w in WORD.findall(line))
            if not key or key not in seen:
                kept.append(line)
            seen.add(key)
        expected = None if text is None else "\n".join(kept)
        assert found[i] == (expected, len((text or "").split("\n")) - len(kept)), i


def changed_lines():
    """Lines of 5 to 300 words with copies of which one word in ten is changed, and one is dropped."""
    r = np.random.default_rng(5)
    rows = []
    for i, n in enumerate([5, 6, 9, 10, 11, 14, 20, 21, 30, 40, 60, 100, 160, 300] * 2):
        base = cases.prose(700 + i, n, 4000).split(" ")
        lines = [base]
        for k in range(3):
            x = list(base)
            for at in r.choice(n, n // 10, replace=False):
                x[at] = f"new{i}a{k}b{at}"
            lines.append(x[:at] + x[at + 1 :] if k == 2 and n > 10 else x)
        rows.append((i, "\n".join(" ".join(x) for x in lines)))
    return rows


def removed(rows):
    """How many lines of each document go, by brute force."""
    where, pairs = plain_lines(rows)
    root = union(pairs, range(len(where)))
    gone = Counter(where[k][0] for k in root if root[k] != k)
    return {i: gone[i] for i, _ in rows}, pairs


def test_near_lines_equal_brute_force(spark, monkeypatch):
    """All pairs, although most share no block of their SimHash; with long blocks left untested too."""
    rows = changed_lines()
    shapes = linededup.Lines(pa.array([t for _, t in rows])).simhashes()
    expected, pairs = removed(rows)
    assert sum(not (shapes[a] == shapes[b]).any() for a, b in pairs) > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").cache()
    for tested in (linededup.TESTED, 0):
        monkeypatch.setattr(linededup, "TESTED", tested)
        assert {x.doc_id: x["__removed"] for x in linededup.drop_repeated_lines(docs).collect()} == expected


@pytest.mark.parametrize("seed", range(4))
def test_similar_lines_share_a_block_of_words(seed):
    """Whatever the counts say, each similar pair keeps a common block and passes the size and parity test."""
    r = np.random.default_rng(seed)
    rows = []
    for n in [*range(5, 60), 90, 200, 400]:
        base = r.integers(0, r.choice([8, 60, 5000]), n).tolist()
        for _ in range(4):
            x, left = list(base), n // 10 + 1
            for _ in range(r.integers(0, left + 1)):
                at = int(r.integers(len(x)))
                x[at : at + 1] = [[], [99999 + int(r.integers(9))], [x[at], int(r.integers(9))]][r.integers(3)]
            rows.append(" ".join(f"w{w}" for w in x))
    lines = linededup.Lines(pa.array(rows), linededup.LEAST_WORDS)
    level = r.integers(1, 255, linededup._COUNTERS).astype(np.uint8)
    held = defaultdict(set)
    for line, found in zip(*map(np.ndarray.tolist, lines.word_blocks(level))):
        held[line].add(found)
    size = lines.size.tolist()
    parities = [lines.parities(32).view("<u4"), lines.parities(128).view("<u8")]
    words = [rows[t].split(" ") for t in lines.text.tolist()]
    near = 0
    for a, b in combinations(range(len(size)), 2):
        if 10 * abs(size[a] - size[b]) <= size[a] + size[b] and 20 * slow_lcs_bound(words[a], words[b]) >= 9 * (size[a] + size[b]):
            if 20 * linededup.common_words(words[a], words[b]) >= 9 * (size[a] + size[b]):
                near += 1
                assert held[a] & held[b]
                for cut, parity in zip((255, 1000), parities):
                    sizes = np.minimum([size[a], size[b]], cut)
                    assert linededup._possible(np.zeros(2), parity[[a, b]], sizes).all()
    assert near > 100


def slow_lcs_bound(a, b):
    """At most so many words in common, order aside."""
    return sum((Counter(a) & Counter(b)).values())


def test_blocks_of_unlike_lines_go_no_further(monkeypatch):
    """Lines of other size or parity stay behind, unless their block is too long to be tested."""
    parity, size = np.array([[0], [0], [0xFFFF], [0xFFFE], [0]], dtype=np.uint32), np.array([20, 30, 20, 20, 20])
    name = np.array([1, 1, 1, 1, 2])
    assert linededup._possible(name, parity, size).tolist() == [False, False, True, True, False]
    monkeypatch.setattr(linededup, "TESTED", 2)
    assert linededup._possible(name, parity, size).tolist() == [True, True, True, True, False]


def test_counts_are_summed_over_many_tasks(spark, monkeypatch):
    rows = changed_lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    monkeypatch.setattr(linededup, "_FAN_IN", 2)
    told, _ = linededup.Lines(pa.array([t for _, t in rows]), linededup.LEAST_WORDS).told
    counts = np.bincount(linededup._counter(told), minlength=linededup._COUNTERS)
    level = linededup.word_levels(docs)
    used = counts > 0
    assert (np.abs(level[used] - 8 * np.log2(counts.sum() / counts[used])) <= 0.5).all()


def test_lines_of_every_length(spark):
    """Short repeats go; so do repeats and near copies in scripts without blanks. One character is one word."""
    chinese = "今天天气很好我们去公园散步然后回家吃晚饭"
    other = chinese.replace("公园", "湖边")
    near = chinese.replace("晚", "午")
    rows = [
        (1, f"One two\nAlone\n***\n{chinese}。\nThe four word line"),
        (2, f"one, TWO!\n***\n{chinese}。\none three\nthe four word lines"),
        (3, f"{near}。\nalone\nสวัสดี\nthe four word line"),
        (4, f"สวัสดี\n{other[:8]}\n\n"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in linededup.drop_repeated_lines(docs).collect()}
    assert found == {1: rows[0][1], 2: "***\none three\nthe four word lines", 3: "สวัสดี", 4: f"{other[:8]}\n\n"}
    raw, offsets = text_bytes(pa.array(["今天abc天 x", "é一é", "𠀀𠀁"]))
    cut = words(raw, offsets, unspaced(raw))
    assert [raw[s:e].tobytes().decode() for s, e in zip(cut.starts, cut.ends)] == ["今", "天", "abc", "天", "x", "é", "一", "é", "𠀀", "𠀁"]


def test_blocks_guarantee_three_bits():
    """Any three flipped bits leave one of four blocks whole."""
    assert linededup.BLOCKS == 4
    r = np.random.default_rng(0)
    for _ in range(200):
        bits = r.choice(128, 3, replace=False)
        assert len({b // 32 for b in bits.tolist()}) < linededup.BLOCKS


def test_line_dedup_runs_on_its_own_output(odd):
    once = linededup.drop_repeated_lines(odd)
    again = linededup.drop_repeated_lines(once)
    assert again.columns == once.columns
    assert {(r.doc_id, r.text) for r in again.collect()} == {(r.doc_id, r.text) for r in once.collect()}
    assert {r[0] for r in again.select("__removed").distinct().collect()} == {0}


def test_odd_documents_lose_repeated_lines_only(odd, empty):
    left = linededup.drop_repeated_lines(odd).select(*odd.columns).collect()
    assert len(left) == len(cases.rows())
    by_id = defaultdict(list)
    for r in left:
        by_id[r.doc_id].append(r.text)
    assert by_id[1] == [cases.prose(1, 120)] and by_id[2] == [""] and by_id[5] == [None]
    assert by_id[10] == ["one two\n"]
    assert linededup.drop_repeated_lines(empty).count() == 0
